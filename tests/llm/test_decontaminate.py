import random
import re
from collections import Counter

import numpy as np

from tidewater.llm import decontaminate
from tidewater.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def words(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def shingles(w):
    k = min(5, len(w))
    return Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else Counter()


def brute(docs, items):
    """(doc, item) where some window as long as the item reaches 0.8."""
    out = set()
    for d, t in docs:
        w = words(t)
        for i, x in items:
            q = words(x)
            want = shingles(q)
            n = min(len(q), len(w))
            if not want or not n or (len(q) < 5) != (n < 5) and n < 5 or n < min(5, len(q)):
                continue
            for at in range(len(w) - n + 1):
                have = shingles(w[at:at + n])
                low = sum((have & want).values())
                if low and 100 * low >= 80 * sum((have | want).values()):
                    out.add((d, i))
                    break
    return out


def corpus():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 6)))
    text = lambda n: [word() for _ in range(n)]
    items = [(i, " ".join(text(rng.randint(6, 50)))) for i in range(25)]
    items += [(30, None), (31, ""), (32, "two words"), (33, items[0][1]), (None, items[1][1])]
    docs = [(900, None), (901, ""), (902, "!!! ..."), (903, "so Two, WORDS here"),
            (None, items[2][1])]
    for i in range(120):
        w = text(rng.randint(0, 60))
        x = items[rng.randrange(25)][1].split()
        for _ in range(rng.randint(0, 3)):
            x[rng.randrange(len(x))] = word()
        if rng.random() < 0.3:
            del x[: len(x) // 4]
        docs.append((i, ", ".join([" ".join(w), " ".join(x).upper(), " ".join(text(9))])))
    return [*docs, docs[10]], items


def test_against_brute_force(spark):
    docs, items = corpus()
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, item_id int")
    b = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, doc_id string")
    want = brute(docs, items)
    assert len(want) > 30
    for block in (10_000, 7):  # one pass or several
        got = decontaminate.find(d, b, block_items=block).collect()
        assert {(r.doc_id, r.item_id) for r in got} == want
        assert all(r.similarity >= 0.8 and r.distance <= decontaminate.RADIUS for r in got)
    left = decontaminate.clean(d, b)
    assert left.columns == d.columns
    bad = {x for x, _ in want}
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted(
        (x for x, _ in docs if x not in bad), key=str)


def test_exact_passages_of_the_table_are_found(spark):
    docs = [(r.doc_id, " ".join(words(r.text)))
            for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, " ".join(words(r.text)))
             for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = {(d, i) for d, t in docs for i, x in items if x in t}
    got = {(r.doc_id, r.item_id)
           for r in QUERIES["op10_simhash_decontamination"](spark, SF).collect()}
    assert want and want <= got


def test_multi_index_finds_all_within_the_radius():
    rng = np.random.default_rng(2)
    texts = [" ".join(rng.choice(list("abcdefgh"), 12)) for _ in range(40)]
    items = decontaminate.Items(list(range(40)), texts, 5, 24)
    n = next(iter(items.by_size))
    prints = items.prints[rng.integers(0, 40, 200)].copy()
    flips = rng.random((200, 64)) < rng.uniform(0, 0.6, (200, 1))
    prints ^= np.packbits(flips, axis=1)
    got = set(items.search(prints, n))
    for w, p in enumerate(prints):
        for j, q in enumerate(items.prints):
            far = sum(bin(int(x)).count("1") for x in p ^ q)
            assert ((w, j) in got) == (far <= 24)


def test_empty(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    one = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    assert decontaminate.find(d, b).collect() == []
    assert decontaminate.find(one, b.where("false")).collect() == []
    assert decontaminate.clean(one, b.where("false")).count() == 1
    assert decontaminate.find(one, b).count() == 1
