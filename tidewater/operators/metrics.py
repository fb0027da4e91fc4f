"""Ten-second metric tables.

Every metric is a tumbling event-time window aggregation grouped by the window and its
keys; Spark aggregates partially before the shuffle, so the reference's one-task global
windows become ordinary parallel aggregations. Money is summed as decimal(16,2) and
turned into double at the end, so the result does not depend on summation order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.sequence import time_bucket, with_next
from tidewater.functions.text import tokenize
from tidewater.functions.time import ms_to_ts, s_to_ts, tumble, window_text
from tidewater.operators.logs import search_keywords
from tidewater.operators.visitors import (NEIGHBOUR_BUCKET_MS, ORDER,
                                          daily_unique_visitor)

WINDOW = "10 seconds"
MONEY = "decimal(16,2)"


def money_sum(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.sum(col.try_cast(MONEY)), F.lit(0).cast(MONEY)).cast("double")


def windowed(df: DataFrame, event_time: Column, keys: Sequence, aggs: Sequence[Column],
             length: str = WINDOW) -> DataFrame:
    """groupBy(tumbling window, *keys).agg(*aggs) with stt/edt text first."""
    g = df.groupBy(tumble(event_time, length).alias("win"), *keys).agg(*aggs)
    return g.select(*window_text("win"), *[c for c in g.columns if c != "win"])


def channel_metrics(page: DataFrame, length: str = WINDOW, jump_within_ms: int = 10_000,
                    bucket_ms: int = NEIGHBOUR_BUCKET_MS) -> DataFrame:
    """Visitors, sessions, page views, duration and bounces per window and
    (vc, ch, ar, is_new) (A1, U1, U2).

    The reference unions three topics (pages, unique visitors, jumps). Here page
    measures and the jump flag come from one neighbour pass over the page log, unique
    visitors from one (device, day) aggregation, then one union feeds one aggregation.
    """
    nb = with_next(page.withColumn("_mid", F.col("common.mid"))
                   .withColumn("_lp", F.col("page.last_page_id")),
                   ["_mid"], ORDER, ["ts", "_lp"], time_bucket("ts", bucket_ms))
    start = F.col("_lp").isNull()
    blocked = (F.col("next_exists") & ((F.col("next_ts") - F.col("ts")) < jump_within_ms)
               & F.col("next__lp").isNotNull())
    zero = F.lit(0).cast("long")
    page_part = nb.select(
        "ts", "common", zero.alias("uv"), start.cast("long").alias("sv"),
        F.lit(1).cast("long").alias("pv"), F.col("page.during_time").alias("dur"),
        (start & ~blocked).cast("long").alias("uj"))
    uv_part = daily_unique_visitor(page).select(
        "ts", "common", F.lit(1).cast("long").alias("uv"), zero.alias("sv"), zero.alias("pv"),
        zero.alias("dur"), zero.alias("uj"))
    rows = page_part.unionByName(uv_part)
    return windowed(
        rows, ms_to_ts("ts"),
        [F.col("common.vc").alias("vc"), F.col("common.ch").alias("ch"),
         F.col("common.ar").alias("ar"), F.col("common.is_new").alias("is_new")],
        [F.sum("uv").alias("uv_ct"), F.sum("sv").alias("sv_ct"), F.sum("pv").alias("pv_ct"),
         F.coalesce(F.sum("dur"), zero).alias("dur_sum"), F.sum("uj").alias("uj_ct")],
        length)


def page_uv_metrics(uv_rows: DataFrame, length: str = WINDOW) -> DataFrame:
    """Home / detail unique visitors per window (A2); input from ``page_daily_unique``."""
    return windowed(uv_rows, ms_to_ts("ts"), [],
                    [F.sum("home_uv_ct").alias("home_uv_ct"),
                     F.sum("good_detail_uv_ct").alias("good_detail_uv_ct")], length)


def login_metrics(login_rows: DataFrame, length: str = WINDOW) -> DataFrame:
    """Unique and back-flow users per window (A3); input from ``login_unique_and_back``."""
    return windowed(login_rows, ms_to_ts("ts"), [],
                    [F.sum("back_ct").alias("back_ct"), F.sum("uu_ct").alias("uu_ct")], length)


def keyword_metrics(page: DataFrame, length: str = WINDOW) -> DataFrame:
    """Search keyword counts per window (A4, J15, X2): every word of the whole searched
    text counts once per occurrence; window by the page time truncated to seconds."""
    rows = (search_keywords(page)
            .select(F.floor(F.col("ts") / 1000).alias("_s"),
                    F.explode(tokenize(F.col("page.item"))).alias("keyword")))
    out = windowed(rows, s_to_ts("_s"), ["keyword"],
                   [F.count(F.lit(1)).alias("keyword_count")], length)
    return out.select("stt", "edt", F.lit("search").alias("source"), "keyword",
                      "keyword_count")


def register_metrics(registers: DataFrame, length: str = WINDOW) -> DataFrame:
    """Registrations per window (A5); event time = change-log ts (seconds)."""
    return windowed(registers, s_to_ts("ts"), [],
                    [F.count(F.lit(1)).alias("register_ct")], length)


# ------------------------------------------------------------------ trade metrics

def cart_user_metrics(cart_uu: DataFrame, length: str = WINDOW) -> DataFrame:
    """Daily-unique cart users per window (A6); input from ``cart_daily_unique``."""
    from tidewater.functions.time import text_to_ts
    return windowed(cart_uu, text_to_ts("event_time"), [],
                    [F.count(F.lit(1)).alias("cart_add_uu_ct")], length)


def order_metrics(flagged: DataFrame, length: str = WINDOW) -> DataFrame:
    """Unique / new ordering users and order amounts per window (A7). Amounts are the
    order-level amounts of each line (Q5 kept), nulls as 0 (Q9)."""
    from tidewater.functions.time import text_to_ts
    return windowed(flagged, text_to_ts("order_create_time"), [], [
        F.sum("order_unique").alias("order_unique_user_count"),
        F.sum("order_new").alias("order_new_user_count"),
        money_sum("activity_reduce_amount").alias("order_activity_reduce_amount"),
        money_sum("coupon_reduce_amount").alias("order_coupon_reduce_amount"),
        money_sum("original_total_amount").alias("order_original_total_amount")], length)


def payment_metrics(pay_uu: DataFrame, length: str = WINDOW) -> DataFrame:
    """Unique / new paying users per window (A8); input from ``pay_unique_and_new``."""
    from tidewater.functions.time import text_to_ts
    return windowed(pay_uu, text_to_ts("callback_time"), [], [
        F.sum("payment_suc_unique_user_count").alias("payment_suc_unique_user_count"),
        F.sum("payment_suc_new_user_count").alias("payment_suc_new_user_count")], length)


def province_order_metrics(lines: DataFrame, provinces: DataFrame,
                           length: str = WINDOW) -> DataFrame:
    """Distinct orders and line amount per window and province (A9), names joined after
    the aggregation (J8) so the join sees one row per (window, province)."""
    from tidewater.functions.time import text_to_ts
    agg = windowed(lines, text_to_ts("order_create_time"), ["province_id"], [
        F.count_distinct("order_id").alias("order_count"),
        money_sum("split_total_amount").alias("order_amount")], length)
    names = provinces.select(F.col("id").alias("_pid"), F.col("name").alias("province_name"))
    out = agg.join(names, agg["province_id"] == names["_pid"], "left")
    return out.select("stt", "edt", "province_id", "province_name", "order_count",
                      "order_amount")


PRODUCT_COLS = ["trademark_id", "trademark_name", "category1_id", "category1_name",
                "category2_id", "category2_name", "category3_id", "category3_name"]


def _product_select(prod: DataFrame, with_spu: bool) -> DataFrame:
    cols = [F.col("sku_id").alias("_sku"), F.col("tm_id").alias("trademark_id"),
            F.col("tm_name").alias("trademark_name"), "category1_id", "category1_name",
            "category2_id", "category2_name", "category3_id", "category3_name"]
    if with_spu:
        cols += ["spu_id", "spu_name"]
    return prod.select(*cols)


def spu_order_metrics(lines: DataFrame, prod: DataFrame, length: str = WINDOW) -> DataFrame:
    """Order lines and amount per window, user, SPU, trademark and categories (A10).

    Aggregate by (window, user, sku) first, join the product dimension on that much
    smaller table, then roll up to the SPU keys (enrich after aggregate)."""
    from tidewater.functions.time import text_to_ts
    pre = (lines.groupBy(tumble(text_to_ts("order_create_time"), length).alias("win"),
                         "user_id", "sku_id")
           .agg(F.count(F.lit(1)).alias("_n"),
                F.sum(F.col("split_total_amount").cast(MONEY)).alias("_amt")))
    p = _product_select(prod, True)
    j = pre.join(p, pre["sku_id"] == p["_sku"], "left")
    keys = ["user_id", "spu_id", "spu_name", *PRODUCT_COLS]
    g = j.groupBy("win", *keys).agg(
        F.sum("_n").alias("order_count"),
        F.coalesce(F.sum("_amt"), F.lit(0).cast(MONEY)).cast("double").alias("order_amount"))
    return g.select(*window_text("win"), *keys, "order_count", "order_amount")


def refund_metrics(refunds: DataFrame, prod: DataFrame, length: str = WINDOW) -> DataFrame:
    """Refunds per window, user, trademark and categories (A11; keyed by user, Q6 fixed),
    aggregated by (window, user, sku) before the product join."""
    from tidewater.functions.time import text_to_ts
    pre = (refunds.groupBy(tumble(text_to_ts("create_time"), length).alias("win"),
                           "user_id", "sku_id")
           .agg(F.count(F.lit(1)).alias("_n")))
    p = _product_select(prod, False)
    j = pre.join(p, pre["sku_id"] == p["_sku"], "left")
    keys = ["user_id", *PRODUCT_COLS]
    g = j.groupBy("win", *keys).agg(F.sum("_n").alias("refund_count"))
    return g.select(*window_text("win"), *keys, "refund_count")
