"""Join operators of the hand-run samples.

``interval_join`` turns the time bound into an extra equi-key (a time bucket) so that a
key with many rows compares each left row only with right rows in the one or two
buckets that can match, never with every row of the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.sequence import first_per_group


def interval_join(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
                  lower_ms: int, upper_ms: int, how: str = "inner") -> DataFrame:
    """Rows of ``right`` with the same ``key`` and ``right_ts`` in
    ``[left_ts + lower_ms, left_ts + upper_ms]`` (both ends inclusive) - J12; ``how`` is inner,
    left, right or full.

    One side falls in exactly one bucket of width ``upper_ms - lower_ms``, each row of the
    other is expanded to the (at most two) buckets that its bound overlaps, so every pair is
    found once and the comparison work per key is bounded by the rows near in time. An outer
    join expands the side that it does not keep, so a kept row is unmatched at most once; the
    full join adds the unmatched right rows to the left join. Column names of the two sides
    must differ except for ``key``, which holds the kept row's value.
    """
    width = max(upper_ms - lower_ms, 1)
    r = right.withColumnRenamed(key, "_tw_rk")
    near = F.col(right_ts).between(F.col(left_ts) + F.lit(lower_ms),
                                   F.col(left_ts) + F.lit(upper_ms))
    cond = ((F.col(key) == F.col("_tw_rk")) & (F.col("_tw_b") == F.col("_tw_rb")) & near)
    names = [key, *[c for c in left.columns if c != key], *[c for c in right.columns if c != key]]

    def one(df: DataFrame, ts: str, bucket: str) -> DataFrame:
        return df.withColumn(bucket, F.floor(F.col(ts) / width))

    def all_of(df: DataFrame, ts: str, lo: int, hi: int, bucket: str) -> DataFrame:
        first = F.floor((F.col(ts) + F.lit(lo)) / width)
        last = F.floor((F.col(ts) + F.lit(hi)) / width)
        return df.withColumn(bucket, F.explode(F.sequence(first, last)))

    if how in ("left", "full"):
        kept = one(left, left_ts, "_tw_b").join(
            all_of(r, right_ts, -upper_ms, -lower_ms, "_tw_rb"), cond, "left").select(*names)
        if how == "left":
            return kept
    out = all_of(left, left_ts, lower_ms, upper_ms, "_tw_b").withColumn("_tw_l", F.lit(1)).join(
        one(r, right_ts, "_tw_rb"), cond, "inner" if how == "inner" else "right")
    value = F.col(key) if how == "inner" else F.coalesce(F.col(key), F.col("_tw_rk"))
    if how == "full":
        out = out.where(F.col("_tw_l").isNull())
    out = out.withColumn(key, value).select(*names)
    return kept.unionByName(out) if how == "full" else out


def equi_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
              how: str = "inner") -> DataFrame:
    """Regular join on one key (J13): inner, left, right or full."""
    return left.join(right, left[left_key] == right[right_key], how)


def latest_left_join(left: DataFrame, right: DataFrame, key: str,
                     left_order: Sequence[str], right_order: Sequence[str],
                     right_key: str | None = None) -> DataFrame:
    """Latest row per key on each side, then a left join."""
    rk = right_key or key
    lt = first_per_group(left, [key], left_order, last=True)
    rt = first_per_group(right, [rk], right_order, last=True)
    return lt.join(rt, lt[key] == rt[rk], "left")
