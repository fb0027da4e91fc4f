"""Visitor state machines of the click log as batch plans.

Each reference operator keeps a per-key value state; because event order within a key
fixes the state, the batch forms are "first row of (key, day)" aggregations and
neighbour lookups, all built to stay parallel under a hot key (see
``functions/sequence.py``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.sequence import first_per_group, time_bucket, with_next
from tidewater.functions.time import ms_to_date, whole_days_between
from tidewater.operators.logs import home_or_detail, login_rows, session_starts

ORDER = ["ts", "offset"]
# Rows of one device inside one bucket share a window partition; buckets are patched
# at their edges, so the result does not depend on this value.
NEIGHBOUR_BUCKET_MS = 3_600_000


def daily_unique_visitor(page: DataFrame) -> DataFrame:
    """First session start of every (device, day)."""
    starts = session_starts(page).withColumn("_dt", ms_to_date("ts"))
    return first_per_group(starts, [F.col("common.mid"), "_dt"], ORDER).drop("_dt")


def user_jump(page: DataFrame, within_ms: int = 10_000,
              bucket_ms: int = NEIGHBOUR_BUCKET_MS) -> DataFrame:
    """Bounced session starts.

    A session start is a jump when the next page row of the same device is another
    session start less than ``within_ms`` later (pattern match), or when no page row
    follows within ``within_ms`` (timeout; a gap of exactly ``within_ms`` times out).
    """
    nb = with_next(page.withColumn("_mid", F.col("common.mid"))
                   .withColumn("_lp", F.col("page.last_page_id")),
                   ["_mid"], ORDER, ["ts", "_lp"], time_bucket("ts", bucket_ms))
    blocked = (F.col("next_exists") & ((F.col("next_ts") - F.col("ts")) < within_ms)
               & F.col("next__lp").isNotNull())
    return (nb.where(F.col("_lp").isNull() & ~blocked)
            .drop("_mid", "_lp", "next_ts", "next__lp", "next_exists"))


def page_daily_unique(page: DataFrame) -> DataFrame:
    """First home and first detail page of every (device, day) (T3): rows with
    ``home_uv_ct`` / ``good_detail_uv_ct`` flags."""
    rows = home_or_detail(page).withColumn("_dt", ms_to_date("ts")).withColumn(
        "_pid", F.col("page.page_id"))
    firsts = first_per_group(rows, [F.col("common.mid"), "_pid", "_dt"], ORDER)
    return (firsts
            .withColumn("home_uv_ct", (F.col("_pid") == "home").cast("long"))
            .withColumn("good_detail_uv_ct", (F.col("_pid") == "good_detail").cast("long"))
            .drop("_dt", "_pid"))


def login_unique_and_back(page: DataFrame, back_days: int = 8) -> DataFrame:
    """First login of every (user, day) with ``uu_ct`` = 1 and ``back_ct`` = 1 when the
    previous login day of the user is ``back_days`` or more whole days earlier (T4)."""
    rows = login_rows(page).withColumn("dt", ms_to_date("ts"))
    firsts = first_per_group(rows, [F.col("common.uid"), "dt"], ORDER)
    # One row per user-day remains: a key's partition is bounded by days, not events.
    w = Window.partitionBy(F.col("common.uid")).orderBy("dt")
    prev = F.lag("dt").over(w)
    return (firsts.withColumn("uu_ct", F.lit(1).cast("long"))
            .withColumn("back_ct", F.when(prev.isNotNull()
                                          & (whole_days_between(F.col("dt"), prev) >= back_days),
                                          F.lit(1)).otherwise(F.lit(0)).cast("long")))
