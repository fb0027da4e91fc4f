import random
import re

import numpy as np
import pytest

from tidewater.llm import jaccard_join
from tidewater.llm.graph import components
from tidewater.llm.shingles import shingle_set, word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sets(text, k=5):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(w) < k:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def brute(rows):
    s = [sets(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(s[i] & s[j])
            if both and 100 * both >= 80 * len(s[i] | s[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted(((d, len(s[i]), least.get(find(i))) for i, (d, _) in enumerate(rows)),
                  key=str)


def corpus(seed, n=120):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgÉé") for _ in range(rng.randint(1, 6)))
    text = lambda m: [word() for _ in range(m)]
    base = [text(rng.randint(5, 150)) for _ in range(12)]
    shared = text(60)
    rows = [(900, None), (901, ""), (902, " \t\n"), (903, "Two words"), (904, "two  WORDS"),
            (905, "A b c d e"), (906, "a b c d e f")]
    for i in range(n):
        w = list(rng.choice(base)) if rng.random() < 0.7 else text(80) + shared
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = word()
        rows.append((i, " ".join(w)))
    return [*rows, rows[20], (None, rows[21][1]), (None, "alone in the table with no id")]


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame([(*r, 7, "x") for r in rows],
                               "doc_id long, text string, gid int, n string").repartition(5)
    got = [(r.doc_id, r.n_shingles, r.component_id)
           for r in jaccard_join.classes(df).collect()]
    assert sorted(got, key=str) == brute(rows)


def test_chain_of_near_copies_and_a_crowd(spark):
    """A chain in which only neighbours link, and many copies of one text."""
    w = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(30):
        rows.append((i, " ".join(w)))
        w[5 * i:5 * i + 3] = [f"c{i}x{k}" for k in range(3)]
    crowd = " ".join(f"v{i}" for i in range(60))
    rows += [(100 + i, crowd + (f" end{i}" if i % 3 else "")) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = [(r.doc_id, r.n_shingles, r.component_id)
           for r in jaccard_join.classes(df).collect()]
    assert sorted(got, key=str) == brute(rows)


def test_crowd_of_near_copies_makes_few_pairs(spark, monkeypatch):
    """A crowd whose members share most shingles, but link with some others only, meets in few
    lists first; what is left is little. Counts of the wanted come in one job."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(160):
        w = list(base)
        for at in rng.sample(range(0, 120, 8), 5):
            w[at] = f"x{i}y{at}"
        rows.append((i, " ".join(w)))
    met = []
    pairs = jaccard_join._center_pairs

    def counted(lists, threshold, nearest=None):
        met.append((nearest, lists.count(), lists.select("center").distinct().count()))
        return pairs(lists, threshold, nearest)

    monkeypatch.setattr(jaccard_join, "_center_pairs", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = [(r.doc_id, r.n_shingles, r.component_id)
           for r in jaccard_join.classes(df).collect()]
    assert sorted(got, key=str) == brute(rows)
    nearest, entries, centers = met[0]
    assert nearest and centers > 20 and entries <= jaccard_join._LISTS * centers


def test_every_shingle_hot(spark, monkeypatch):
    """All shingles on the spread path give the same links."""
    monkeypatch.setattr(jaccard_join, "_levels",
                        lambda sets: np.ones(jaccard_join.SLOTS, np.uint8))
    rows = corpus(7, 60)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = [(r.doc_id, r.n_shingles, r.component_id)
           for r in jaccard_join.classes(df).collect()]
    assert sorted(got, key=str) == brute(rows)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard_join.classes(df).collect() == []


def test_words_of_long_texts(monkeypatch):
    from tidewater.llm import shingles
    text = ("some Words\tand é\n" * 300 + "x" * 5000 + " end").encode()
    whole = word_hashes(text)
    monkeypatch.setattr(shingles, "_PIECE", 64)
    assert (word_hashes(text) == whole).all()
    assert len(shingle_set("A b  c\nd")) == 1
    assert (shingle_set("A b c d e") == shingle_set("a B c\vd e")).all()


def test_components(spark):
    edges = [(1, 2), (2, 3), (10, 9), (9, 8), (5, 5), (20, 21), (21, 22), (22, 20)]
    edges += [(1000, 1000 + i) for i in range(300)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in components(df).collect()}
    want = {1: 1, 2: 1, 3: 1, 8: 8, 9: 8, 10: 8, 20: 20, 21: 20, 22: 20}
    want |= {1000 + i: 1000 for i in range(300)}
    assert got == want
