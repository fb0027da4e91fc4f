"""Per-key dedupe operators.

All are aggregations or bucketed neighbour lookups (see ``functions/sequence.py``):
no operator sorts all rows of a key inside one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.sequence import first_per_group, time_bucket, with_prev


def latest_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """``row_number() over (partition by keys order by order desc) = 1`` (W1) as a
    ``max_by`` aggregation."""
    return first_per_group(df, keys, order_cols, last=True)


def settle_latest(df: DataFrame, key: str, ts_ms: str, delay_ms: int = 2_000,
                  order_cols: Sequence[str] | None = None,
                  firsts: DataFrame | None = None) -> DataFrame:
    """One row per key (T1): the latest row among those arriving within ``delay_ms`` of
    the key's first row (event-time form of the reference's processing-time timer;
    later rows never emit). A per-key minimum (partial aggregation) is joined back,
    then a ``max_by`` aggregation picks the row.

    ``firsts`` (key, first ts) may be given when a narrower upstream table has the same
    first times (e.g. the raw line stream under a wide join), so the wide input is not
    computed twice."""
    order_cols = list(order_cols or [ts_ms])
    if firsts is None:
        first = df.groupBy(key).agg(F.min(ts_ms).alias("_tw_first"))
    else:
        first = firsts.toDF(key, "_tw_first")
    within = (df.join(first, key)
              .where(F.col(ts_ms) <= F.col("_tw_first") + F.lit(delay_ms))
              .drop("_tw_first"))
    return first_per_group(within, [key], order_cols, last=True)


def first_per_key_gap(df: DataFrame, key: str, ts_ms: str, gap_ms: int = 5_000,
                      order_cols: Sequence[str] | None = None,
                      bucket_ms: int = 3_600_000) -> DataFrame:
    """Rows that start a new burst of their key (T1b): the first row, and every row
    coming ``gap_ms`` or more after the previous row of the same key (the reference's
    state TTL is refreshed by every read)."""
    order_cols = list(order_cols or [ts_ms])
    nb = with_prev(df, [key], order_cols, [ts_ms], time_bucket(ts_ms, bucket_ms))
    keep = ~F.col("prev_exists") | ((F.col(ts_ms) - F.col(f"prev_{ts_ms}")) >= gap_ms)
    return nb.where(keep).drop(f"prev_{ts_ms}", "prev_exists")


def latest_by_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
                  payload: str | None = None) -> DataFrame:
    """Current table of an upsert log (S8/S9): the latest record per key; a key whose
    latest record has a null ``payload`` is deleted."""
    latest = latest_per_key(df, keys, order_cols)
    return latest if payload is None else latest.where(F.col(payload).isNotNull())
