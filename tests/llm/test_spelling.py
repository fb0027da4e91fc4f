import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from tidewater.llm import spelling

SF = "/root/testdata/sf0.001"


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(rows):
    n = Counter()
    for doc_id, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    n = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}
    by = {}
    for w in n:  # words are near only if they share what one deletion leaves
        for v in {w} | {w[:k] + w[k + 1:] for k in range(len(w))}:
            by.setdefault(v, set()).add(w)
    nears = {w: set() for w in n}
    for group in by.values():
        for a, b in itertools.combinations(group, 2):
            if near(a, b):
                nears[a].add(b)
                nears[b].add(a)
    form = {}
    for w in n:
        best = min(nears[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, n[w], len(nears[w]), form[w], n.get(form[w]), root))
    return out


def got(df):
    return {(r.word, r.n, r.n_near, r.form, r.form_n, r.root)
            for r in spelling.group(df).collect()}


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert got(docs) == want
    assert any(w[3] for w in want) and any(w[2] > 1 for w in want)


@pytest.mark.parametrize("crowded", [1, 3, 1000])
def test_near_words_of_crowded_keys(spark, crowded):
    rng = random.Random(crowded)
    words = {"commonpart" + "".join(rng.choice("abé") for _ in range(rng.randrange(0, 5)))
             for _ in range(150)}
    words |= {"".join(rng.choice("abÿ") for _ in range(rng.randrange(2, 7))) + "thesamerest"
              for _ in range(150)}
    words |= {"".join(rng.choice("xy") for _ in range(rng.randrange(7, 10))) for _ in range(150)}
    df = spark.createDataFrame([(w,) for w in words], "word string")
    pairs = [frozenset(r) for r in spelling.near_words(df, crowded=crowded).collect()]
    want = {frozenset(p) for p in itertools.combinations(words, 2) if near(*p)}
    assert len(pairs) == len(set(pairs)) and set(pairs) == want


def test_chains_ties_and_odd_rows(spark):
    rows = [(1, "lettering " * 200), (2, "letterinG " * 3 + "lettéring " * 3), (None, None), (4, ""),
            (5, "letterrings " * 2 + "letterings " * 20 + "short short"), (5, "letterings " * 2),
            (None, "letterind " * 2), (7, "abcdefgx abcdefgx abcdefgy abcdefgy " + "abcdefg " * 2),
            (8, "ab" * 600 + " x " + "ab" * 600)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, word string")
    have = got(df)
    assert have == brute(rows)
    assert ("letterrings", 2, 1, "letterings", 22, "letterings") in have or any(
        w[3] is not None for w in have)


def test_roots_over_several_steps(spark):
    words = spark.createDataFrame(
        [("aaaaaaa", 1), ("aaaaaab", 10), ("aaaaabb", 100), ("aaaabbb", 1000),
         ("zzzzzzz", 5)], "word string, n long")
    out = {r.word: (r.n_near, r.form, r.root)
           for r in spelling.forms(words, spelling.near_words(words)).collect()}
    assert out["aaaaaaa"] == (1, "aaaaaab", "aaaabbb") and out["aaaabbb"] == (1, None, "aaaabbb")
    assert out["zzzzzzz"] == (0, None, "zzzzzzz")


def test_empty(spark):
    assert got(spark.createDataFrame([], "doc_id long, text string")) == set()
