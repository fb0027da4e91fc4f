"""Order-dependent per-key helpers that stay parallel when one key is hot.

Many stateful operators of the warehouse only need, for each row of a key, the next or
the previous row of the same key in event order, or the first/last row of a (key, day)
group. A plain ``Window.partitionBy(key)`` sends every row of a key to one task, which
breaks when a single key holds a large share of all rows. These helpers:

* take first/last rows of a group with ``min_by``/``max_by`` aggregations, which Spark
  pre-aggregates on the map side before the shuffle;
* find neighbours with a window over ``(key, time bucket)`` and patch the rows at bucket
  edges from a bucket-level table (one row per non-empty bucket of a key), so the
  largest window partition is bounded by one key's rows in one bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_B = "_tw_bucket"
_HAS = "_tw_has"


def _order_struct(order_cols: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order_cols])


def _null_safe_join(left: DataFrame, right: DataFrame, cols: Sequence[str],
                    how: str) -> DataFrame:
    r = right
    renamed = {c: f"_tw_r_{c}" for c in cols}
    for c, n in renamed.items():
        r = r.withColumnRenamed(c, n)
    cond = [left[c].eqNullSafe(r[renamed[c]]) for c in cols]
    return left.join(r, cond, how).drop(*renamed.values())


def first_per_group(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                    last: bool = False) -> DataFrame:
    """First (or last) row of every group in ``order_cols`` order, all columns kept.

    An aggregation (``min_by``/``max_by`` of the whole row), so it is partially
    aggregated before the shuffle and a hot group costs no single-task sort.
    """
    cols = df.columns
    pick = F.max_by if last else F.min_by
    # Group columns come from the grouping, so the result is known to be partitioned by
    # them and a later grouping on the same key needs no exchange.
    named = [g for g in group_cols if isinstance(g, str) and g in cols]
    packed = [c for c in cols if c not in named]
    if not packed:
        return df.select(*cols).distinct()
    rows = (df.groupBy(*group_cols)
            .agg(pick(F.struct(*[F.col(c) for c in packed]), _order_struct(order_cols))
                 .alias("_tw_row")))
    return rows.select(*[F.col(c) if c in named else F.col("_tw_row").getField(c).alias(c)
                         for c in cols])


def join_per_group(df: DataFrame, small: DataFrame, keys: Sequence[str],
                   spread_by: Sequence[str], parts: int = 64) -> DataFrame:
    """Left join of one ``small`` row per key to ``df``, spread over ``parts`` per key: the
    small row goes to each (key, part) that occurs, so a hot key fills no task."""
    part = F.pmod(F.xxhash64(*spread_by), F.lit(parts))
    rows = df.withColumn("_tw_part", part)
    there = rows.select(*keys, "_tw_part").distinct().join(small, list(keys))
    return (_null_safe_join(rows, there, [*keys, "_tw_part"], "left").drop("_tw_part"))


def _neighbour(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
               fields: Sequence[str], bucket: Column, prefix: str, forward: bool) -> DataFrame:
    shift = F.lead if forward else F.lag
    in_w = Window.partitionBy(*keys, _B).orderBy(*order_cols)
    # An explicit exchange: rows that come partitioned by the key alone would satisfy the
    # window as they are and leave a hot key in one task.
    rows = df.withColumn(_B, bucket).repartition(*keys, _B)
    for f in fields:
        rows = rows.withColumn(f"_tw_in_{f}", shift(F.col(f)).over(in_w))
    rows = rows.withColumn(_HAS, shift(F.lit(True)).over(in_w))

    # One row per non-empty (key, bucket): its first (forward) or last (backward) row.
    pick = F.min_by if forward else F.max_by
    edge = (rows.groupBy(*keys, _B)
            .agg(pick(F.struct(*[F.col(f) for f in fields]), _order_struct(order_cols))
                 .alias("_tw_edge")))
    bw = Window.partitionBy(*keys).orderBy(_B)
    edge = edge.select(*keys, _B, shift("_tw_edge").over(bw).alias("_tw_nb"))

    out = _null_safe_join(rows, edge, [*keys, _B], "left")
    has = F.coalesce(F.col(_HAS), F.lit(False))
    for f in fields:
        out = out.withColumn(f"{prefix}{f}",
                             F.when(has, F.col(f"_tw_in_{f}")).otherwise(F.col(f"_tw_nb.{f}")))
    out = out.withColumn(f"{prefix}exists", has | F.col("_tw_nb").isNotNull())
    return out.drop(*[f"_tw_in_{f}" for f in fields], _HAS, "_tw_nb", _B)


def with_next(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
              fields: Sequence[str], bucket: Column, prefix: str = "next_") -> DataFrame:
    """Add ``{prefix}{field}`` from the following row of the same key, plus
    ``{prefix}exists``. ``bucket`` must be non-decreasing in ``order_cols`` within a key
    (e.g. ``floor(ts / bucket_ms)``)."""
    return _neighbour(df, keys, order_cols, fields, bucket, prefix, True)


def with_prev(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
              fields: Sequence[str], bucket: Column, prefix: str = "prev_") -> DataFrame:
    """Like ``with_next`` for the preceding row."""
    return _neighbour(df, keys, order_cols, fields, bucket, prefix, False)


def time_bucket(ms_col, bucket_ms: int) -> Column:
    c = F.col(ms_col) if isinstance(ms_col, str) else ms_col
    return F.floor(c / F.lit(bucket_ms)).cast("long")
