"""Main text of web pages by wrapper induction.

Pages of a host with the same skeleton (the paths of their containers, outside of articles)
form a layout. Over all different pages - equal ones count once - the blocks of text are
counted by their place: what is on every page of a layout, or of the host, is template; what
varies is content. The wrapper of a layout is the path of the content region - where
descending from the root of one of its pages the varying text stays together - and the
template blocks inside it. For that a page of each layout is aligned with another one of it,
or, where it is alone, with the page of another layout of its host, by simple tree matching
(the largest order-keeping match of equal nodes, found by dynamic programming over the
children of matched nodes), and what is the same on both, and on all other pages of the
layout, is template. Applied to every page of the layout, the wrapper yields the blocks of the
region without menus, notices, adverts, forms, reader comments and the like, which are known
by their elements, roles and class names.

A page on which the region's path is missing, or whose host has one page, is its own
template: its article or main element, else its body.

Blocks: text between the edges of block elements. Character references are decoded, white
space becomes one space, empty blocks go, blocks are joined by line feeds.

Defined cases: a null html is empty and gives an empty text; a null url, or one without a
host, belongs to the empty host; repeated rows are extracted again; a null page_id is kept;
an empty table gives an empty result. Nothing is cut, whatever the length or depth.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import SPREAD, maybe_wanted, part_of, start, wanted_filter
from tidewater.session import materialize

_SURE = 4  # different pages at least before text inside the region counts as template
_DEEP = 60  # levels that alignment descends

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)"
    r"(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs2>[^>]*)>", re.S)
_ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")

# Element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav "
    "ol option p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - frozenset("body html dd dt li option td th tr tbody thead tfoot".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
            "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
FENCE = frozenset("ul ol dl table div article section main body html select".split())
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li pre blockquote dl ul ol table figure".split())
NOT_TEXT = frozenset(
    "aside button canvas dialog footer form frameset head iframe input label menu meter nav "
    "noframes noscript object option progress script select style svg template textarea "
    "title video audio".split())
NOT_TEXT_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation "
    "search toolbar".split())
NOT_TEXT_WORDS = frozenset(
    "ad ads advert advertisement advertising adverts alert banner breadcrumb breadcrumbs "
    "comment comments consent cookie cookies disqus footer gdpr login menu modal nav navbar "
    "navigation newsletter notice notices pager pagination popup promo promoted promotion "
    "recommended related replies respond search share sharing sidebar signup social sponsor "
    "sponsored subscribe toolbar widget".split())
# May stand beside those words in one class or id: "nav-bar", "comments_list".
BESIDE = frozenset("area bar block box buttons container inner item items link links list "
                   "outer section wrap wrapper".split())
ROOTS = frozenset("html body main article".split())


class Node:
    __slots__ = ("attrs", "kept", "kids", "label", "tag")

    def __init__(self, tag: str, raw: str):
        self.tag, self.kids, self.attrs = tag, [], {}
        self.kept = False  # holds the page's text, whatever its names say
        if raw and not raw.isspace():
            for m in _ATTR.finditer(raw):
                self.attrs.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
        words = sorted(set(_WORD.findall(self.attrs.get("class", ""))))
        self.label = ".".join([tag, *words])

    def dropped(self) -> bool:
        """Whether its text is no part of an article."""
        if self.kept:
            return False
        if self.tag in NOT_TEXT:
            return True
        a = self.attrs
        if not a or self.tag in ROOTS:
            return False
        if "hidden" in a or a.get("role", "").lower() in NOT_TEXT_ROLES:
            return True
        if re.search(r"display\s*:\s*none", a.get("style", "")):
            return True
        return any(_named(t) for t in f"{a.get('class', '')} {a.get('id', '')}".split())


def _named(token: str) -> bool:
    """Whether a whole class or id, not a part of it, names what is no text."""
    if token.lower() in NOT_TEXT_WORDS:
        return True
    words = {w.lower() for w in _WORD.findall(token)}
    return bool(words & NOT_TEXT_WORDS) and words <= NOT_TEXT_WORDS | BESIDE


def _keep(root: Node) -> None:
    """Marks what holds most of the page's text, unless an article or main element lies
    elsewhere: such elements go only by what the pages of a host show. Elements that are no
    text by their kind, but for forms, are left out and go."""
    order, work = [], [root]
    while work:
        n = work.pop()
        order.append(n)
        work += [k for k in n.kids if not isinstance(k, str)
                 and (k.tag == "form" or k.tag not in NOT_TEXT)]
    size: dict[int, int] = {}
    texts: dict[int, int] = {}  # article and main elements at or below
    for n in reversed(order):
        size[id(n)] = sum(len(k.strip()) if isinstance(k, str) else size.get(id(k), 0)
                          for k in n.kids)
        texts[id(n)] = (n.tag in ("article", "main")) + sum(
            texts.get(id(k), 0) for k in n.kids if not isinstance(k, str))
    node = root
    while 2 * size[id(node)] > size[id(root)] and texts[id(node)] == texts[id(root)]:
        node.kept = True
        inner = [k for k in node.kids if not isinstance(k, str) and id(k) in size]
        node = max(inner, key=lambda k: size[id(k)], default=None)
        if node is None:
            break


def parse(text: str) -> Node:
    """DOM tree of a page; forgiving, never failing."""
    root = Node("#root", "")
    stack, at, end = [root], 0, len(text)
    while at < end:
        m = _TOKEN.search(text, at)
        if m is None:
            stack[-1].kids.append(text[at:])
            break
        if m.start() > at:
            stack[-1].kids.append(text[at:m.start()])
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        if m["end"] or m["end2"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if stack[i].tag in ("td", "th") and tag not in BLOCK:
                    break
            continue
        if tag in CLOSES_P:
            _close(stack, {"p"})
        if tag in SIBLINGS:
            _close(stack, SIBLINGS[tag])
        node = Node(tag, m["attrs"] or m["attrs2"] or "")
        stack[-1].kids.append(node)
        if tag in RAW:
            close = re.compile(rf"</{tag}\s*>", re.I).search(text, at)
            at = close.end() if close else end
        elif tag not in VOID:
            stack.append(node)
    _keep(root)
    return root


def _close(stack: list[Node], tags: set[str]) -> None:
    """Ends the nearest open element of ``tags``, unless a container is between."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in tags:
            del stack[i:]
            return
        if stack[i].tag in FENCE:
            return


def blocks(node: Node) -> list[str]:
    """The text blocks below a node, in order."""
    out: list[str] = []
    now: list[str] = []

    def flush() -> None:
        t = _SPACE.sub(" ", html.unescape("".join(now))).strip()
        if t:
            out.append(t)
        now.clear()

    work = [iter(node.kids)]
    ends = [False]
    while work:
        kid = next(work[-1], None)
        if kid is None:
            work.pop()
            if ends.pop():
                flush()
        elif isinstance(kid, str):
            now.append(kid)
        elif kid.tag == "br":
            now.append(" ")
        else:
            edge = kid.tag in BLOCK
            if edge:
                flush()
            if kid.dropped():
                continue
            work.append(iter(kid.kids))
            ends.append(edge)
    flush()
    return out


def _elements(node: Node) -> list[Node]:
    return [k for k in node.kids if not isinstance(k, str) and not k.dropped()]


def _own_text(node: Node) -> str:
    return _SPACE.sub(" ", " ".join(k for k in node.kids if isinstance(k, str))).strip()


def align(a: Node, b: Node, depth: int = 0) -> tuple[int, list[tuple[Node, Node]]]:
    """Simple tree matching: size of the largest match of two trees with equal roots, and
    the matched nodes."""
    pairs = [(a, b)]
    if depth >= _DEEP:
        return 1, pairs
    x, y = _elements(a), _elements(b)
    if not x or not y:
        return 1, pairs
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    inner: dict[tuple[int, int], list] = {}
    for i, p in enumerate(x):
        row, above = best[i + 1], best[i]
        for j, q in enumerate(y):
            top = max(row[j], above[j + 1])
            if p.label == q.label:
                if p.tag in LEAVES:  # equal leaves match, better with equal text
                    w, sub = (2 if _own_text(p) == _own_text(q) else 1), [(p, q)]
                else:
                    w, sub = align(p, q, depth + 1)
                if above[j] + w > top:
                    top = above[j] + w
                    inner[i, j] = sub
            row[j + 1] = top
    i, j = len(x), len(y)
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            pairs += inner[i - 1, j - 1]
            i, j = i - 1, j - 1
    return 1 + best[len(x)][len(y)], pairs


def _text(node: Node) -> str:
    return "\n".join(blocks(node))


def _hash(*parts: bytes) -> bytes:
    return hashlib.blake2b(b"\0".join(parts), digest_size=8).digest()


def _long(digest: bytes) -> int:
    return int.from_bytes(digest, "little", signed=True)


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def units(tree: Node, owner: str) -> Iterator[tuple[Node, int]]:
    """The elements with own text and a hash of owner, path and text; leaves are whole."""
    work = [(tree, _bytes(owner), 0)]
    while work:
        n, path, depth = work.pop()
        whole = n.tag in LEAVES or depth >= _DEEP
        text = _text(n) if whole else _own_text(n)
        if text:
            yield n, _long(_hash(path, _bytes(text)))
        if not whole:
            work += [(k, _hash(path, _bytes(k.label)), depth + 1) for k in _elements(n)]


def layout(tree: Node, owner: str) -> int:
    """Hash of owner and the paths of the containers, outside of articles."""
    seen, work = set(), [(tree, b"", 0)]
    while work:
        n, path, depth = work.pop()
        seen.add(path)
        if depth < _DEEP and n.tag not in ("article", "main"):
            work += [(k, _hash(path, _bytes(k.label)), depth + 1) for k in _elements(n)
                     if k.tag in BLOCK and k.tag not in LEAVES]
    return _long(_hash(_bytes(owner), *sorted(seen)))


def induce(pages: list[str], owner: str = "", keys: frozenset[int] = frozenset(),
           n: int = 0, alike: bool = False) -> dict:
    """Wrapper for the first of some pages: the path (labels from the root) of the content
    region and the template blocks inside it. Template is what is the same on all ``pages``,
    and the units ``keys``, which ``n`` different pages are known to share. Where all are
    ``alike`` (of one layout), alignment says which nodes correspond and the units whether all
    pages have them: template is both."""
    trees, seen = [], set()
    for p in pages:
        t = parse(p)
        body = _text(t)
        if body not in seen:
            seen.add(body)
            trees.append(t)
    if len(trees) < 2 and n < 2:
        return {}
    first = trees[0]
    times: dict[int, int] = {}
    for other in trees[1:]:
        for a, b in align(first, other)[1]:
            text = _text(a) if a.tag in LEAVES else _own_text(a)
            if text == (_text(b) if b.tag in LEAVES else _own_text(b)):
                times[id(a)] = times.get(id(a), 0) + 1
    aligned = {a for a, c in times.items() if c == len(trees) - 1}
    shared = {id(a) for a, key in units(first, owner) if key in keys} if keys else set()
    if alike and len(trees) > 1:
        aligned = shared = aligned & shared
    same = aligned | shared
    sure = (aligned if len(trees) >= _SURE else set()) | (shared if n >= _SURE else set())

    mass: dict[int, int] = {}

    def weigh(n: Node, depth: int = 0) -> int:  # varying text at or below a node
        if n.tag in LEAVES or depth >= _DEEP:
            total = 0 if id(n) in same else len(_text(n))
        else:
            total = 0 if id(n) in same else len(_own_text(n))
            total += sum(weigh(k, depth + 1) for k in _elements(n))
        mass[id(n)] = total
        return total

    if not weigh(first):
        return {}
    path, node = [], first
    while node.tag not in ("article", "main"):
        best = max((k for k in _elements(node) if k.tag not in LEAVES and k.tag in BLOCK),
                   key=lambda k: mass.get(id(k), 0), default=None)
        if best is None or mass.get(id(best), 0) < 0.7 * mass[id(node)]:
            break
        path.append(best.label)
        node = best
    constant = []
    work = list(node.kids) if sure else []
    while work:
        k = work.pop()
        if isinstance(k, str) or k.dropped():
            continue
        if k.tag in LEAVES:
            if id(k) in sure:
                constant += blocks(k)
        else:
            work += k.kids
    own = len(_text(node))
    if sum(map(len, constant)) > 0.2 * own:  # pages alike: no template inside the article
        constant = []
    return {"path": path, "constant": constant}


def _regions(tree: Node, path: list[str]) -> list[Node]:
    level = [tree]
    for label in path:
        level = [k for n in level for k in n.kids
                 if not isinstance(k, str) and k.label == label]
    return level


def _likely(tree: Node) -> list[Node]:
    """Without a wrapper: the outermost articles, else main, else everything."""
    for tag in ("article", "main"):
        found, work = [], [tree]
        while work:
            n = work.pop()
            if n.tag == tag:
                found.append(n)
            else:
                work += [k for k in reversed(n.kids)
                         if not isinstance(k, str) and not k.dropped()]
        if found:
            return found
    return [tree]


def main_text(page: str | None, wrapper: dict | None = None) -> str:
    """Main text of one page, by its host's wrapper."""
    tree = parse(page or "")
    found = _regions(tree, wrapper["path"]) if wrapper and wrapper.get("path") else []
    if found and not any(n.tag in ("article", "main") for n in found):
        inside = [m for n in found for m in _likely(n)]
        found = inside if any(m.tag in ("article", "main") for m in inside) else found
    out = [b for n in (found or _likely(tree)) for b in blocks(n)]
    skip = set((wrapper or {}).get("constant", ()))
    return "\n".join(b for b in out if b not in skip) if found else "\n".join(out)


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^/:]*:?//([^/?#]*)", 1))


def _laid_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Layout, hash of the text and size of the text of each page, and its other columns."""
    for b in batches:
        rows = []
        for owner, page in zip(b.column("host").to_pylist(), b.column("html").to_pylist(),
                               strict=True):
            tree = parse(page)
            text = _text(tree)
            rows.append((layout(tree, owner), _long(_hash(_bytes(text))), len(text)))
        cols = list(zip(*rows, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [b.column("host"), b.column("h"), b.column("part"),
             *(pa.array(c, pa.int64()) for c in cols)],
            ["host", "h", "part", "layout", "body", "size"])


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The units of each page."""
    for b in batches:
        rows = []
        for owner, page in zip(b.column("host").to_pylist(), b.column("html").to_pylist(),
                               strict=True):
            tree = parse(page)
            at, body = layout(tree, owner), _long(_hash(_bytes(_text(tree))))
            rows += [(owner, at, body, key) for key in {k for _, k in units(tree, owner)}]
        cols = list(zip(*rows, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.string()), *(pa.array(c, pa.int64()) for c in cols[1:])],
            ["host", "layout", "body", "key"])


def _induced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for r in b.to_pylist():
            pages = [r["html"]] + ([r["other"]] if r["other"] is not None else [])
            out.append(json.dumps(induce(pages, r["host"], frozenset(r["keys"]), r["pages"],
                                         r["alike"])))
        yield pa.RecordBatch.from_arrays([b.column("layout"), pa.array(out, pa.string())],
                                         ["layout", "wrapper"])


def _compared(d: DataFrame, laid: DataFrame) -> DataFrame:
    """What the wrapper of every layout is made of: host, layout, html of a page, html of the
    other page that it is aligned with (null if its host has no other), keys of the units that
    all pages share, how many pages those are, and alike: whether they are of this layout."""
    once = laid.groupBy("host", "layout", "body").agg(
        F.min("h").alias("h"), F.max("size").alias("size"))
    per = materialize(once.groupBy("host", "layout").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.struct("size", "body", "h")).alias("r"),
        F.min(F.struct("size", "body", "h")).alias("s"))
        .select("host", "layout", "n", F.col("r.h").alias("h"), F.col("s.h").alias("h2")),
        "layouts")
    hosts = per.groupBy("host").agg(
        F.sum("n").alias("total"), F.max(F.struct("n", "layout")).alias("most"),
        F.min(F.struct("n", "layout")).alias("least"))
    # The largest page of each layout and, of two different ones or more, the smallest, with which
    # it is aligned; copies of them meet within their tasks first.
    roles = (per.select("host", "layout", "n", "h", F.lit(False).alias("second"))
             .unionByName(per.where("n > 1").select(
                 "host", "layout", "n", F.col("h2").alias("h"), F.lit(True).alias("second"))))
    pages = (maybe_wanted(d.select("host", "h", "html"), wanted_filter(roles, "h"), "h")
             .groupBy("host", "h").agg(F.min("html").alias("html")))
    pages = materialize(pages.join(roles, ["host", "h"])
                        .select("host", "layout", "n", "html", "second"), "layout-pages")
    second = pages.where("second").select("layout", F.col("html").alias("other"))
    pages = pages.where("not second").drop("second")

    # Units that no such page has cannot be on all pages of a layout.
    kind = "host string, layout long, body long, key long"
    some = pages.select("host", "html").mapInArrow(_units, kind).select("key")
    known = wanted_filter(some, "key")
    counts = maybe_wanted(d.select("host", "html").mapInArrow(_units, kind), known, "key")
    counts = counts.distinct().groupBy("host", "layout", "key").agg(
        F.count(F.lit(1)).alias("c"))
    counts = materialize(counts, "units")
    here = (counts.join(per.select("layout", "n"), "layout").where("c = n and n > 1")
            .groupBy("layout").agg(F.collect_set("key").alias("here")))
    all_over = (counts.groupBy("host", "key").agg(F.sum("c").alias("c"))
                .join(hosts.select("host", "total"), "host").where("c = total and total > 1")
                .groupBy("host").agg(F.collect_set("key").alias("over")))

    d = (pages.join(hosts, "host").join(here, "layout", "left")
         .join(all_over, "host", "left"))
    none = F.array().cast("array<long>")
    d = d.withColumn("keys", F.concat(F.coalesce("here", none), F.coalesce("over", none)))
    alone = (F.col("n") == 1) & (F.col("total") > 1)
    many = d.where(~alone).join(second, "layout", "left")
    single = d.where(alone).withColumn("to", F.when(
        F.col("layout") == F.col("most.layout"), F.col("least.layout"))
        .otherwise(F.col("most.layout")))
    single = single.join(pages.select(F.col("layout").alias("to"),
                                      F.col("html").alias("other")), "to")
    names = ["host", "layout", "html", "other", "keys"]
    return (many.select(*names, F.col("n").alias("pages"), F.lit(True).alias("alike"))
            .unionByName(single.select(*names, F.col("total").alias("pages"),
                                       F.lit(False).alias("alike"))))


def _wrappers(d: DataFrame, laid: DataFrame) -> DataFrame:
    """layout and wrapper of every layout. ``laid``: host, h, part, layout, body, size of
    every page."""
    return (_compared(d, laid)
            .mapInArrow(_induced, "layout long, wrapper string"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of ``pages`` (page_id, url,
    html)."""
    start(pages)
    kind = pages.schema["page_id"].dataType.simpleString()
    d = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"),
                     host(F.col("url")).alias("host"))
    d = (d.withColumn("h", F.xxhash64("host", "html"))
         .withColumn("part", part_of(["page_id", "url"], SPREAD)))
    laid = materialize(d.select("host", "h", "part", "html").mapInArrow(
        _laid_out, "host string, h long, part int, layout long, body long, size long"), "laid")
    wrappers = materialize(_wrappers(d, laid), "wrappers")
    # Equal pages have equal layouts.
    back = (laid.select("h", "part", "layout").distinct().join(wrappers, "layout")
            .select("h", "part", "wrapper"))
    both = d.join(back, ["h", "part"]).select("page_id", "url", "html", "wrapper")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict] = {}
        for b in batches:
            out = []
            for page, w in zip(b.column("html").to_pylist(), b.column("wrapper").to_pylist(),
                               strict=True):
                if w not in known:
                    if len(known) > 10_000:
                        known.clear()
                    known[w] = json.loads(w)
                out.append(main_text(page, known[w]))
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(out, pa.string()),
                 pa.array([len(t) for t in out], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return both.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
