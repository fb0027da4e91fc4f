from tidewater.llm import licenses


def scan(spark, rows):
    df = spark.createDataFrame([(*r, "x", 3) for r in rows],
                               "doc_id long, text string, license string, digest int")
    return sorted(licenses.scan(df).collect(), key=lambda r: str(r.doc_id))


def test_whole_texts_and_notices(spark):
    mit = licenses.TEXTS["MIT"]
    rows = [(1, mit), (2, "The MIT License".replace("The ", "") + "\n\nCopyright (c) 2020 A. B.\n\n"
                       + mit.lower().replace("license", "licence").replace(",", " ,")),
            (3, mit + " except on Mondays"), (4, "text\nReleased under the MIT Licence.\nmore"),
            (5, "LICENSED UNDER CC BY-NC 4.0!\nlicensed under the Apache License, version 2.0"),
            (6, None), (7, ""), (8, "© 2021 Someone\nAll rights reserved."), (9, "plain text"),
            (9, "plain text"), (None, "Released under the MIT License."),
            (10, "word " * 50_000), (11, licenses._BSD.format(""))]
    got = scan(spark, rows)
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    assert by[1].license_id == by[2].license_id == "MIT"
    assert by[3].license_id is None and by[3].notices is None
    assert (by[4].license_id, by[4].notices, by[4].n_notices) == (None, "MIT", 1)
    assert (by[5].notices, by[5].n_notices) == ("Apache-2.0 CC-BY-NC-4.0", 2)
    assert all(by[i].text_digest is None and by[i].n_words == 0 for i in (6, 7, 8))
    assert by[None].license_id == by[None].notices == "MIT"
    assert by[10].n_words == 50_000 and by[10].license_id is None
    assert by[11].license_id == "BSD-2-Clause"


def test_own_texts_and_empty(spark):
    df = spark.createDataFrame([(1, "My  Terms"), (2, "my terms, apply")],
                               "doc_id long, text string")
    got = {r.doc_id: r.license_id for r in licenses.scan(df, [("own", "my terms")]).collect()}
    assert got == {1: "own", 2: None}
    assert licenses.scan(df.where("false")).collect() == []


def test_known_texts_name_one_licence_each():
    seen = {}
    for i, t in licenses.known():
        assert seen.setdefault(" ".join(t.lower().split()), i) == i


def test_headings_and_whole_long_licences(spark):
    mit = licenses.TEXTS["MIT"]
    rows = [(f"{k}", f"{h}\n\nCopyright (c) 2020 A. B.\n\n{licenses.TEXTS[k]}", k) for h, k in
            [("The MIT License (MIT)", "MIT"), ("The MIT License", "MIT"),
             ("The 3-Clause BSD License", "BSD-3-Clause"), ("ISC License (ISC)", "ISC"),
             ("Boost Software License - Version 1.0 - August 17th, 2003", "BSL-1.0"),
             ("The Unlicense", "Unlicense")]]
    for f in licenses.LONG.glob("*.txt"):
        text = f.read_text()
        rows += [(f.stem, text, f.stem), (f.stem, text.upper(), f.stem),
                 (f.stem, text.replace("http://", "https://"), f.stem),
                 (f.stem, text[:len(text) // 2], None)]
    ids = {f.stem for f in licenses.LONG.glob("*.txt")} | set(licenses.TEXTS)
    assert {"Apache-2.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0",
            "BSL-1.0", "Unlicense"} < ids
    apache = (licenses.LONG / "Apache-2.0.txt").read_text()
    rows += [("a", apache[:apache.index("APPENDIX")], "Apache-2.0"),
             ("b", apache.replace("[yyyy] [name of copyright owner]", "2020 A. B."), "Apache-2.0"),
             ("c", f"The MIT License (MIT)\n{mit} But not on Mondays.", None)]
    df = spark.createDataFrame([(i, *r[1:]) for i, r in enumerate(rows)],
                               "doc_id long, text string, want string")
    got = {r.doc_id: r.license_id for r in licenses.scan(df).collect()}
    for i, r in enumerate(rows):
        assert got[i] == r[2], (i, r[0])
