import random
import re

import numpy as np
import pytest
import xxhash

from tidewater.llm import simhash_join

SF = "/root/testdata/sf0.01"


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(
        c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    s = [" ".join(w[i:i + 4]) for i in range(max(len(w) - 3, 1))] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def brute(rows):
    fp = [fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    distinct = {}
    for i, x in enumerate(fp):
        root[find(i)] = find(distinct.setdefault(x, i))
    each = np.asarray(list(distinct), np.uint64)
    for x in each:
        for y in each[np.bitwise_count(each ^ x) <= 4]:
            root[find(distinct[int(x)])] = find(distinct[int(y)])
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return sorted(((d, f"{fp[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(rows)),
                  key=str)


def got(df, **more):
    return sorted(((r.doc_id, r.fingerprint, r.component_id)
                   for r in simhash_join.classes(df, **more).collect()), key=str)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert got(docs) == want
    assert any(d != c for d, _, c in want)


def test_odd_rows(spark):
    base = [f"w{k}" for k in range(200)]
    rows = [(7, None), (3, ""), (9, " \t\n"), (None, "one"), (4, "ONE"), (5, "one two three"),
            (6, "É É É É É"), (8, "é é é é é"), (10, "x\xa0y z"), (11, " ".join(base)),
            (2, " ".join([*base[:100], "other", *base[101:]])), (2, " ".join(base)),
            (12, "long" * 50_000 + " b c d e"), (None, "alone without an id")]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows],
                               "doc_id long, text string, fp string, cell int")
    assert got(df) == brute(rows)


def planted(n, seed, radius):
    """Fingerprints in chains and crowds around some centres, and random ones."""
    rng = random.Random(seed)
    out = {0, (1 << 64) - 1}
    while len(out) < n:
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 40])):
            out.add(x)
            y = x
            for b in rng.sample(range(64), rng.randrange(1, radius)):
                y ^= 1 << b
            out.add(y)
            if rng.random() < 0.2:
                x = y
    return sorted(out)


def roots(fp, edges):
    root = {x: x for x in fp}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        root[find(a)] = find(b)
    return {x: find(x) for x in fp}


def classes_of(r):
    out = {}
    for x, y in r.items():
        out.setdefault(y, set()).add(x)
    return sorted(map(sorted, out.values()))


@pytest.mark.parametrize("cell", [2, 30, 8192])
def test_links_reach_all_within_the_radius(spark, cell):
    fp = planted(1500, cell, 9)
    signed = np.asarray(fp, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    pairs = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash_join.links(df, cell).collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in pairs)
    want = [(a, b) for i, a in enumerate(fp) for b in fp[i + 1:] if (a ^ b).bit_count() <= 4]
    assert classes_of(roots(fp, pairs)) == classes_of(roots(fp, want))


def test_cells_meet_for_every_pair_within_the_radius():
    rng = random.Random(1)
    for _ in range(2000):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), rng.randrange(0, 5)):
            y ^= 1 << b
        key, own = simhash_join.cells(np.asarray([x, y], np.uint64))
        assert set(key[own == 0].tolist()) & set(key[own == 1].tolist())


def test_forest_of_a_crowd_is_small():
    fp = np.asarray([1 << k for k in range(64)] + [0], np.uint64)
    a, _ = simhash_join._forest(np.sort(fp))
    assert len(a) == 64


def test_empty(spark):
    assert got(spark.createDataFrame([], "doc_id long, text string")) == []
