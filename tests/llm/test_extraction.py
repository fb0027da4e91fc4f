import re
from html import unescape

from pyspark.sql import functions as F

from tidewater.llm import extraction
from tidewater.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def page(body, k=0):
    return (f"<html><head><title>t{k}</title><style>p{{}}</style></head><body>"
            f"<div class='nav-bar'><a href=/>Menu {k}</a></div><div id=cookie-notice>We use "
            f"cookies {k}</div><div class=wrap><div class='post body'>{body}</div>"
            f"<div class=sidebar>Side {k} {'x' * k}</div></div><div class='comments'><p>First! "
            f"{k}</p></div><footer>&copy; {k}</footer></body></html>")


def test_region_of_a_host_without_semantic_elements(spark):
    rows = [(k, f"http://h.example/{k}", page(
        f"<h2>Title {k}</h2><p>Some  <b>text</b>&amp; more {k}<p>second {k * 7}"
        f"<div class=ad>Buy {k}</div><form>mail <input></form><p>Follow us on our page.</p>", k))
        for k in range(9)]
    df = spark.createDataFrame([(*r, "clash") for r in rows],
                               "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in extraction.extract(df).collect()}
    for k in range(9):
        want = f"Title {k}\nSome text& more {k}\nsecond {k * 7}"
        assert got[k].text in (want, want + "\nFollow us on our page.")
        assert got[k].n_chars == len(got[k].text)


def test_template_blocks_inside_the_region_go():
    pages = [f"<body><main><h1>Head {k}</h1><p>{'words ' * 40}{k}</p><p>Ends here.</p></main>"
             for k in range(5)]
    w = extraction.induce(pages)
    assert w["constant"] == ["Ends here."]
    assert extraction.main_text(pages[2], w) == f"Head 2\n{'words ' * 40}2"


def test_alike_pages_keep_their_text():
    pages = [f"<body><article><p>{'same ' * 50}</p><p>also the same</p><p>n {k}</p></article>"
             for k in range(6)]
    w = extraction.induce(pages)
    assert extraction.main_text(pages[0], w) == f"{('same ' * 50).strip()}\nalso the same\nn 0"


def test_odd_rows(spark):
    deep = "<div>" * 5000 + "deep" + "</div>" * 5000
    rows = [(1, None, None), (2, "x", ""), (3, "http://h/", "no markup &lt;b&gt; &eacute;"),
            (4, "http://h/", "<p>a<p>b<br>c<script>var t='</p>';"), (5, "http://h/", deep),
            (6, "http://h/", "<a title='un<p>closed"), (None, "http://h/", "<p>x</p>"),
            (7, "http://h/", "<p>y</p>"), (7, "http://h/", "<p>y</p>"),
            (8, "http://g/", "<article>" + "<p>z</p>" * 20_000 + "</article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = extraction.extract(df).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r.text for r in got}
    assert by[1] == by[2] == ""
    assert by[3] == "no markup <b> é" and by[4] == "a\nb c" and by[5] == "deep"
    assert by[None] == "x" and by[7] == "y" and by[8] == "\n".join("z" * 20_000)
    assert extraction.extract(df.where("false")).collect() == []


def test_simple_tree_matching():
    a = extraction.parse("<ul><li>1</li><li>2</li></ul><p>x</p>")
    b = extraction.parse("<p>w</p><ul><li>2</li></ul><p>x</p>")
    size, pairs = extraction.align(a, b)
    # the root 1, the list 2 and the paragraph with equal text 2
    assert size == 5 and sorted(x.label for x, _ in pairs) == ["#root", "p", "ul"]
    assert [y.kids for x, y in pairs if x.tag == "p"] == [["x"]]


def test_articles_of_the_table(spark):
    src = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = QUERIES["op8_wrapper_extraction"](spark, SF).collect()
    assert len(got) == len(src)
    for r in got:
        art = re.search(r"<article>(.*?)(</article>|$)", src[r.page_id], re.S)[1]
        parts = re.sub(r"</?[a-z][^>]*>", "", re.sub(
            r"</?(p|h1)>", "\0", art.replace("<br>", " "))).split("\0")
        want = "\n".join(x for x in (" ".join(unescape(p).split()) for p in parts) if x)
        assert r.text == want


def test_copies_and_rare_layouts_count_in_the_wrapper(spark):
    def one(k):
        return (f"<body><div class=top>Shop of things</div><div class=wrap><div class=text>"
                f"<p>{'word ' * 20}{k}</p><p>No {k}</p></div></div>"
                f"<div class=low>Made by us</div></body>")

    def two(k):
        return (f"<body><div class=head>Archive</div><div class=leaf><p>{'old ' * 20}{k}</p></div>"
                f"<div class=low>Made by us</div></body>")

    html = [one(0)] * 40 + [one(k) for k in range(1, 30)] + [two(k) for k in range(3)]
    rows = [(i, "http://h.example/x", x) for i, x in enumerate(html)]
    # as many copies of each page, so whichever has the least hash
    rows += [(1000 + i, "http://h.example/x", one(k % 30)) for i, k in enumerate(range(300))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in extraction.extract(df).collect()}
    assert len(got) == len(rows)
    for i, x in enumerate(html):
        want = x.split("<p>")[1:]
        assert got[i] == "\n".join(" ".join(w.split("</p>")[0].split()) for w in want), i


def test_a_block_of_few_pages_is_no_template(spark):
    rows = [(k, "http://h/", f"<body><main><h1>Head {k}</h1><p>{'words ' * 40}{k}</p>"
             + ("<p>Ends here.</p>" if k < 60 else "") + "</main>") for k in range(64)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in extraction.extract(df).collect()}
    assert all(got[k].endswith("Ends here.") == (k < 60) for k in range(64))


def test_names_of_containers_do_not_lose_the_article(spark):
    heads = ["<div class='has-sidebar'>", "<div class='no-comments wide'>", "<form action=/>",
             "<div class='content no-sidebar'>", "<div id=search-results>", "<div class=search>",
             "<div class=modal-open>", "<div class='share-article'>", "<div role=dialog>"]
    rows = []
    for i, head in enumerate(heads):
        for k in range(1 if i % 2 else 5):
            end = "</form>" if "form" in head else "</div>"
            rows.append((10 * i + k, f"http://h{i}/", f"<body><div class=nav>Menu</div>{head}"
                         f"<h2>Title {k}</h2><p>{'text ' * 30}{k}</p><div class=ad>Buy</div>"
                         f"<div class='comment-list'><p>First {k}</p></div>{end}"
                         f"<footer>Foot</footer></body>"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in extraction.extract(df).collect()}
    for i, _, _ in rows:
        assert got[i] == f"Title {i % 10}\n{('text ' * 30).strip()} {i % 10}", heads[i // 10]


def test_long_comments_beside_an_article_still_go():
    p = (f"<body><div class=nav>Menu</div><article><p>short text</p></article>"
         f"<div class=comments><p>{'chat ' * 300}</p></div></body>")
    assert extraction.main_text(p) == "short text"


def test_every_layout_is_aligned_with_a_page_that_differs(spark):
    rows = [(k, f"http://h.example/{k}", f"<div class=a><p>top</p><p>{'text ' * (k + 1)}</p></div>")
            for k in range(5)]
    rows += [(9, "http://h.example/9", "<div class=b><p>other layout</p></div>"),
             (10, "http://alone.example/", "<div class=a><p>x</p></div>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    d = (df.withColumn("host", extraction.host(F.col("url")))
         .withColumn("h", F.xxhash64("host", "html")).withColumn("part", F.lit(0)))
    laid = d.select("host", "h", "part", "html").mapInArrow(
        extraction._laid_out, "host string, h long, part int, layout long, body long, size long")
    got = {(r.host, r.pages, r.alike): (r.html, r.other)
           for r in extraction._compared(d, laid).collect()}
    assert got == {("h.example", 5, True): (rows[4][2], rows[0][2]),
                   ("h.example", 6, False): (rows[5][2], rows[4][2]),
                   ("alone.example", 1, True): (rows[6][2], None)}


def test_a_line_repeated_in_the_text_is_no_template_beyond_its_place():
    pages = [f"<div class=side>{'side ' * 9}{k}</div><div class=body><p>title {k}</p>"
             + "<p>Yes indeed.</p>" * (40 if k == 0 else 1) + "</div>" for k in range(5)]
    units = [{key for _, key in extraction.units(extraction.parse(p), "h")} for p in pages]
    keys = frozenset(set.intersection(*units))
    assert extraction.induce([pages[0], pages[1]], "h", keys, 5, True)["path"] == ["div.body"]
