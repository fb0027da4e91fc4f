import zlib

import numpy as np

from tidewater.llm import sharding


def check(rows, got, shards):
    want = sorted(((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))
                   for d, t in rows), key=str)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=str) == want
    slots = {}
    for r in got:
        assert 0 <= r.shard < shards
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_balance_with_a_hot_text(spark):
    rng = np.random.default_rng(1)
    rows = [(i, "hot " * 100 if i % 3 == 0 else f"doc {i} " * int(rng.integers(1, 80)))
            for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = sharding.assign(df, 16).collect()
    check(rows, got, 16)
    size = np.zeros(16)
    for r in got:
        size[r.shard] += r["size"]
    assert size.max() / size.mean() < 1.01 and size.min() / size.mean() > 0.99


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "é"), (3, "é"), (None, "x"), (4, "long " * 100_000)]
    df = spark.createDataFrame([(*r, 2, "k") for r in rows],
                               "doc_id long, text string, size int, key string")
    check(rows, sharding.assign(df, 4).collect(), 4)
    assert sharding.assign(df.where("false"), 4).collect() == []


def test_highest_dot_product():
    # the second item goes where more is left in its dimension
    items = np.array([[6.0, 1.0], [5.0, 1.0], [1.0, 4.0], [0.5, 4.0]])
    out = sharding.dot_product_packing(items, 2, (1.0, 1.0))
    assert out[0] != out[1] and out[2] != out[3]


def test_equal_texts_stay_together(spark):
    rng = np.random.default_rng(2)
    texts = [f"text {i} " * int(rng.integers(1, 60)) for i in range(400)]
    rows = [(i, texts[int(rng.integers(0, 400))]) for i in range(20_000)]
    rows += [(20_000 + i, f"alone {i} " * int(rng.integers(1, 30))) for i in range(20_000)]
    rows += [(40_000 + i, "huge " * 40) for i in range(15_000)]  # larger than a shard
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = sharding.assign(df, 16).collect()
    check(rows, got, 16)
    of, size = {}, np.zeros(16)
    for r in got:
        of.setdefault(r.text_crc32, set()).add(r.shard)
        size[r.shard] += r["size"]
    assert [k for k, s in of.items() if len(s) > 1] == [zlib.crc32(("huge " * 40).encode())]
    assert np.ptp(size) < 0.01 * size.mean()


def test_groups_are_split_only_where_bytes_would_not_be_level():
    # six groups of 0.9 shards each, four shards: whole they cannot be level
    names = [f"{g}:" for g in range(6) for _ in range(15)]
    items = np.tile([[60.0, 1.0, 1.0]], (len(names), 1))
    where = sharding.plan(names, items, 4)
    size = np.bincount(where, items[:, 0], minlength=4)
    assert np.ptp(size) <= 120
    # four groups that fill a shard each stay whole
    names = [f"{g}:" for g in range(4) for _ in range(16)]
    where = sharding.plan(names, np.tile([[60.0, 1.0, 1.0]], (64, 1)), 4)
    assert all(len(set(where[16 * g:16 * g + 16])) == 1 for g in range(4))
    assert len(sharding.plan([], np.zeros((0, 3)), 4)) == 0
