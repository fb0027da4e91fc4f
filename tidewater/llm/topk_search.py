"""Exact top-k search of vectors by inner product, with MaxScore.

A vector component is a posting of its dimension: (row, floor(scale * x)). Rows lie in
blocks of BLOCK_ROWS that keep their postings by dimension with the least and greatest value
of each. For a query every dimension of a block then has bounds of what it can add to a
score. With the threshold at hand (the k-th best score so far) the dimensions are split: the
essential ones are the fewest, widest bounds first, without which no row of the block can
reach the threshold. Essential postings are traversed for all rows; rows whose partial score
and the other bounds still reach the threshold are probed in the other dimensions, widest
first, and dropped as soon as they fall short. Results are exact, ties included.

Blocks are dealt to shards of at most SHARD_ROWS rows that a task holds while the blocks of
queries pass by; each shard gives k rows a query, and the shards are merged.

Defined cases: vectors that are null or hold null or non-finite components take no part, nor
do rows with a null vec_id; missing trailing components count as 0; components and scores are
exact up to 63 bits and held there beyond; a repeated query id is one query (the least vector); the rows of a query's own id
are no candidates; repeated candidates are each returned; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import start
from tidewater.session import materialize

BLOCK_ROWS = 2048
QUERY_ROWS = 512
SHARD_ROWS = 1 << 16
_MOST = float((1 << 63) - 1024)  # the largest double that a long holds
_LEAST, _GREATEST = -(1 << 63), (1 << 63) - 1
_STEP = 8  # dimensions probed between two looks at the threshold


def _usable(vec: Column) -> Column:
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x)
                    & (F.abs(x) != F.lit(float("inf"))))
    return vec.isNotNull() & fine


def _blocks(rows: DataFrame, most: int) -> DataFrame:
    """Blocks of at most ``most`` rows: n, dims, ids (int64), data (int32, int64 where a value
    needs it, by dimension)."""

    def pack(ids: np.ndarray, mats: list[np.ndarray]) -> pa.RecordBatch:
        dims = max((m.shape[1] for m in mats), default=0)
        full = np.concatenate([np.pad(m, ((0, 0), (0, dims - m.shape[1]))) for m in mats])
        kind = "<i4" if np.abs(full).max(initial=0) < 1 << 31 else "<i8"
        full = np.ascontiguousarray(full.T.clip(-_MOST, _MOST).astype(kind))
        return pa.RecordBatch.from_arrays(
            [pa.array([len(ids)], pa.int32()), pa.array([dims], pa.int32()),
             pa.array([ids.astype("<i8").tobytes()], pa.binary()),
             pa.array([full.tobytes()], pa.binary())],
            ["n", "dims", "ids", "data"])

    def matrix(col: pa.ListArray) -> np.ndarray:
        size = np.diff(col.offsets.to_numpy())
        flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        out = np.zeros((len(size), int(size.max(initial=0))))
        out[np.arange(out.shape[1])[None, :] < size[:, None]] = flat
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, mats, held = [], [], 0
        for b in batches:
            own = b.column("vec_id").to_numpy(zero_copy_only=False)
            mat = matrix(b.column("vec"))
            for lo in range(0, len(own), most):
                ids.append(own[lo:lo + most])
                mats.append(mat[lo:lo + most])
                held += len(ids[-1])
                if held >= most:
                    yield pack(np.concatenate(ids), mats)
                    ids, mats, held = [], [], 0
        if held:
            yield pack(np.concatenate(ids), mats)

    return rows.select("vec_id", "vec").mapInArrow(
        run, "n int, dims int, ids binary, data binary")


def _postings(ids: np.ndarray, data: bytes, dims: int) -> np.ndarray:
    wide = len(data) == 8 * dims * len(ids)
    return np.frombuffer(data, "<i8" if wide else "<i4").reshape(dims, len(ids))


class Block:
    """Postings of some rows, by dimension, with their bounds."""

    def __init__(self, ids: bytes, data: bytes, dims: int):
        self.ids = np.frombuffer(ids, "<i8")
        self.post = _postings(self.ids, data, dims)
        if self.post.dtype.itemsize == 4:
            self.post = self.post.astype(np.float64)
        self.low = self.post.min(axis=1) if dims else np.zeros(0)
        self.high = self.post.max(axis=1) if dims else np.zeros(0)
        self.top = float(np.abs(self.post).max(initial=0))

    def search(self, q: np.ndarray, own: int, k: int, best: list[tuple[int, int]]):
        """``best``: up to k (-score, id) in order; the same with this block's rows."""
        q = q[:len(self.post)]
        largest = self.top * float(np.abs(q).max(initial=0)) * max(len(q), 1)
        # Doubles, longs or whole numbers of any size: what holds every sum.
        kind = np.float64 if largest < 2.0 ** 53 else np.int64 if largest < 2.0 ** 62 else object

        def exact(values: np.ndarray) -> np.ndarray:  # doubles hold whole numbers here
            return values.astype(np.int64).astype(object) if kind is object \
                else values.astype(kind)
        q, post = exact(q), self.post[:len(q)]
        post = post if post.dtype == kind else exact(post)
        a, b = q * exact(self.low[:len(q)]), q * exact(self.high[:len(q)])
        least, most = np.minimum(a, b), np.maximum(a, b)
        threshold = -best[-1][0] if len(best) == k else None
        if threshold == _LEAST:  # worse scores are held to it
            threshold = None
        if threshold is not None and most.sum() < threshold:
            return best
        order = np.argsort(least - most, kind="stable")  # widest bounds first
        rest = np.concatenate([np.cumsum(most[order][::-1])[::-1], np.zeros(1, kind)])
        if threshold is None:
            essential = len(order)
        else:
            short = np.concatenate([np.zeros(1, kind), np.cumsum(least[order])]) + rest
            essential = int(np.argmax(short < threshold)) if (short < threshold).any() \
                else len(order)
        first = order[:essential]
        rows = np.arange(len(self.ids))
        score = q[first] @ post[first] if essential else np.zeros(len(rows), q.dtype)
        at = essential
        while at < len(order):
            keep = score + rest[at] >= threshold
            rows, score = rows[keep], score[keep]
            if not len(rows):
                return best
            dims = order[at:at + _STEP]
            score = score + q[dims] @ post[np.ix_(dims, rows)]
            at += _STEP
        ids = self.ids[rows]
        keep = ids != own
        if threshold is not None:
            keep &= score >= threshold
        ids, score = ids[keep], score[keep].clip(_LEAST, _GREATEST).astype(np.int64)
        if len(ids) > 4 * k:  # all at least as good as the k-th score
            cut = np.partition(score, len(score) - k)[-k]
            ids, score = ids[score >= cut], score[score >= cut]
        pick = np.lexsort((ids, ~score))[:k]  # ~ has no overflow
        return sorted([*best, *((-int(score[i]), int(ids[i])) for i in pick)])[:k]


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256,
           column: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the ``k`` best rows of ``vectors`` for
    each row of ``queries`` (both: vec_id and ``column``); ties to the smaller vec_id."""
    spark = start(vectors)

    def prepared(df: DataFrame) -> DataFrame:
        vec = F.transform(column, lambda x: F.floor(
            F.lit(float(scale)) * x.cast("double")).cast("double"))
        return (df.where(F.col("vec_id").isNotNull() & _usable(F.col(column)))
                .select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec")))

    data = materialize(_blocks(prepared(vectors), BLOCK_ROWS), "vector-blocks")
    asked = prepared(queries).groupBy("vec_id").agg(F.min("vec").alias("vec"))
    asked = materialize(_blocks(asked, QUERY_ROWS), "query-blocks")
    total = data.agg(F.sum("n")).first()[0] or 0
    shards = max(2 * spark.sparkContext.defaultParallelism, -(-total // SHARD_ROWS))
    cols = ["shard", "kind", "n", "dims", "ids", "data"]
    rows = (data.withColumn("shard", F.pmod(F.xxhash64("ids"), F.lit(shards)))
            .withColumn("kind", F.lit(0)).select(cols)
            .unionByName(asked.withColumn("shard", F.explode(F.sequence(
                F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
                .withColumn("kind", F.lit(1)).select(cols)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, blocks = None, []
        for b in batches:
            for r in b.to_pylist():
                if r["shard"] != shard:
                    shard, blocks = r["shard"], []
                if r["kind"] == 0:
                    blocks.append(Block(r["ids"], r["data"], r["dims"]))
                    continue
                ids = np.frombuffer(r["ids"], "<i8")
                mat = _postings(ids, r["data"], r["dims"]).T
                out = []
                for own, q in zip(ids.tolist(), mat, strict=True):
                    best: list[tuple[int, int]] = []
                    for block in blocks:
                        best = block.search(q, own, k, best)
                    out += [(own, vec, -score) for score, vec in best]
                if out:
                    c = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, pa.int64()) for x in c], ["query_id", "vec_id", "score"])

    found = (rows.repartition(shards, "shard").sortWithinPartitions("shard", "kind")
             .mapInArrow(run, "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
