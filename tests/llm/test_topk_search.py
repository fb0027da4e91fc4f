import math

import numpy as np
import pytest

from tidewater.llm import topk_search


def brute(rows, queries, k=5):
    def use(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    vec = [(i, [math.floor(256 * np.float64(np.float32(x))) for x in v])
           for i, v in rows if i is not None and use(v)]
    out = []
    for q in sorted(queries):
        own = min(v for i, v in vec if i == q)
        best = sorted((-sum(a * b for a, b in zip(own, v, strict=False)), i)
                      for i, v in vec if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return out


@pytest.mark.parametrize(("block", "dims"), [(2048, 8), (16, 24)])
def test_against_brute_force(spark, monkeypatch, block, dims):
    monkeypatch.setattr(topk_search, "BLOCK_ROWS", block)
    monkeypatch.setattr(topk_search, "QUERY_ROWS", 7)
    rng = np.random.default_rng(block)
    rows = [(i, rng.normal(size=dims).astype(np.float32).tolist()) for i in range(400)]
    rows += [(500 + i, rows[7][1]) for i in range(60)]  # ties
    rows += [(600, None), (602, [math.nan] * dims), (604, [1.0, None]), (606, [math.inf] * 2),
             (608, []), (610, [1.0] * (dims // 2)), (None, [1.0] * dims), (550, rows[7][1])]
    df = spark.createDataFrame([(*r, 1) for r in rows],
                               "vec_id long, embedding array<float>, score int").repartition(5)
    asked = [i for i in {r[0] for r in rows} if i is not None and i % 50 == 0 and i != 600]
    got = topk_search.search(df, df.where("vec_id % 50 = 0")).collect()
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got)
    assert got == brute(rows, asked)


def test_large_components_stay_exact(spark):
    rows = [(0, [1e5, 3.0]), (1, [1e5, 2.0]), (2, [1e5, 2.004]), (3, [-1e5, 9.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk_search.search(df, df.where("vec_id = 0"), 2).collect()
    assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [
        (i, s) for _, _, i, s in brute(rows, [0], 2)]


def test_few_rows_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert topk_search.search(df, df.where("vec_id = 0")).count() == 1
    none = df.where("false")
    assert topk_search.search(none, none).collect() == []
    assert topk_search.search(df, none).collect() == []


@pytest.mark.parametrize("rows", [
    [(0, [256.0]), (1, [1e6]), (2, [9e5]), (3, [-1e6])],
    [(0, [2.0 ** 20, 1.0]), (1, [2.0 ** 21, 3.0]), (2, [2.0 ** 21, 2.0]), (3, [-2.0 ** 21, 0.0])],
    # products beyond 64 bits that cancel out
    [(0, [2.0 ** 40, 2.0 ** 40, 1.0]), (1, [2.0 ** 40, -2.0 ** 40, 5.0]),
     (2, [-2.0 ** 40, 2.0 ** 40, 7.0]), (3, [0.0, 0.0, 6.0])]])
def test_components_of_any_size(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk_search.search(df, df.where("vec_id = 0"), 3).collect()
    whole = [(i, [int(256 * x) for x in v]) for i, v in rows]
    want = sorted((-sum(a * b for a, b in zip(whole[0][1], v, strict=True)), i)
                  for i, v in whole[1:])
    assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [
        (i, -s) for s, i in want]


def test_scores_beyond_64_bits_are_held_there(spark):
    rows = [(0, [2.0 ** 60]), (1, [2.0 ** 60]), (2, [1e308]), (3, [-2.0 ** 60]), (4, [0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk_search.search(df, df.where("vec_id = 0")).orderBy("rank").collect()
    top = (1 << 63) - 1
    assert [(r.vec_id, r.score) for r in got] == [(1, top), (2, top), (4, 0), (3, -top - 1)]
