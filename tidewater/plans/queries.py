"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the whole
driver tables. Column names match the DuckDB oracle in ``oracle.py``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater import schemas
from tidewater.operators import logs, metrics, visitors
from tidewater.sources import driver_tables as dt

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- shared inputs

def fixed_log(spark: SparkSession, sf: str) -> DataFrame:
    return logs.fix_new_flag(dt.click_log(spark, sf))


def page_log(spark: SparkSession, sf: str) -> DataFrame:
    return logs.fan_out_log(fixed_log(spark, sf))["page"]


def _mid_ts() -> list:
    return [F.col("offset"), F.col("common.mid").alias("mid"), F.col("ts")]


# ---------------------------------------------------------------- logs

@register("split_dirty")
def q_split_dirty(spark, sf):
    # One parse, both sides tagged in the same pass.
    p = logs.parse_json(dt.raw_click_log(spark, sf), schemas.CLICK_LOG)
    dirty = F.col("is_dirty")
    return p.select(
        F.when(dirty, F.lit("dirty")).otherwise(F.lit("clean")).alias("kind"), "offset",
        F.when(~dirty, F.col("_rec.common.mid")).alias("mid"),
        F.when(~dirty, F.col("_rec.ts")).alias("ts"),
        F.when(dirty, F.col("value")).alias("raw"))


@register("fan_out_page")
def q_fan_out_page(spark, sf):
    clean, _ = logs.split_dirty(dt.raw_click_log(spark, sf))
    page = logs.fan_out_log(logs.fix_new_flag(clean))["page"]
    return page.select(
        "offset", "ts", "common.mid", "common.uid", "common.is_new", "common.vc",
        "common.ch", "common.ar", "page.page_id", "page.last_page_id", "page.during_time",
        F.col("err.error_code").alias("error_code"))


@register("fan_out_start")
def q_fan_out_start(spark, sf):
    start = logs.fan_out_log(fixed_log(spark, sf))["start"]
    return start.select("offset", "ts", "common.mid", "common.is_new", "start.entry",
                        "start.loading_time", "start.open_ad_id",
                        F.col("err.error_code").alias("error_code"))


@register("fan_out_error")
def q_fan_out_error(spark, sf):
    err = logs.fan_out_log(fixed_log(spark, sf))["error"]
    return err.select("offset", "ts", "common.mid", "err.error_code", "err.msg")


@register("explode_displays")
def q_explode_displays(spark, sf):
    d = logs.fan_out_log(fixed_log(spark, sf))["display"]
    return d.select(F.col("common.mid").alias("mid"), "page_id", "ts", "display_type",
                    "item", "item_type", "order", "pos_id")


@register("explode_actions")
def q_explode_actions(spark, sf):
    a = logs.fan_out_log(fixed_log(spark, sf))["action"]
    return a.select(F.col("common.mid").alias("mid"), "page_id", "ts", "action_id", "item",
                    "item_type")


@register("fix_new_flag")
def q_fix_new_flag(spark, sf):
    raw = dt.click_log(spark, sf).select("offset", F.col("common.is_new").alias("is_new_raw"))
    fixed = fixed_log(spark, sf).select(*_mid_ts(), F.col("common.is_new").alias("is_new"))
    return fixed.join(raw, "offset")


# ---------------------------------------------------------------- visitors

@register("session_starts")
def q_session_starts(spark, sf):
    return logs.session_starts(page_log(spark, sf)).select(
        *_mid_ts(), F.col("page.page_id").alias("page_id"))


@register("daily_unique_visitor")
def q_daily_unique_visitor(spark, sf):
    return visitors.daily_unique_visitor(page_log(spark, sf)).select(
        *_mid_ts(), F.col("common.is_new").alias("is_new"))


@register("user_jump")
def q_user_jump(spark, sf):
    return visitors.user_jump(page_log(spark, sf)).select(*_mid_ts())


@register("user_jump_10m")
def q_user_jump_10m(spark, sf):
    return visitors.user_jump(page_log(spark, sf), within_ms=600_000).select(*_mid_ts())


@register("page_daily_unique")
def q_page_daily_unique(spark, sf):
    return visitors.page_daily_unique(page_log(spark, sf)).select(
        *_mid_ts(), "home_uv_ct", "good_detail_uv_ct")


@register("login_unique_and_back")
def q_login_unique_and_back(spark, sf):
    return visitors.login_unique_and_back(page_log(spark, sf)).select(
        "offset", F.col("common.uid").alias("uid"), "ts", "dt", "uu_ct", "back_ct")


# ---------------------------------------------------------------- traffic metrics

@register("channel_metrics")
def q_channel_metrics(spark, sf):
    return metrics.channel_metrics(page_log(spark, sf))


@register("channel_metrics_1h")
def q_channel_metrics_1h(spark, sf):
    return metrics.channel_metrics(page_log(spark, sf), length="1 hour")


@register("page_uv_metrics")
def q_page_uv_metrics(spark, sf):
    return metrics.page_uv_metrics(visitors.page_daily_unique(page_log(spark, sf)))


@register("login_metrics")
def q_login_metrics(spark, sf):
    return metrics.login_metrics(visitors.login_unique_and_back(page_log(spark, sf)))


def search_page_log(spark, sf):
    return dt.attach_search_items(page_log(spark, sf), spark, sf)


@register("keyword_metrics")
def q_keyword_metrics(spark, sf):
    return metrics.keyword_metrics(search_page_log(spark, sf))


@register("tokenize")
def q_tokenize(spark, sf):
    from tidewater.functions.text import lateral_split
    rows = logs.search_keywords(search_page_log(spark, sf)).select(
        "offset", F.col("page.item").alias("item"))
    return lateral_split(rows, "item", "word").groupBy("offset", "word").agg(
        F.count(F.lit(1)).alias("n"))


@register("segment_names")
def q_segment_names(spark, sf):
    """Names of parts without their spaces, split again by the list of all their words."""
    from tidewater.functions.segment import segmenter, word_list
    from tidewater.functions.text import tokenize
    parts = dt.table(spark, sf, "part")
    words = word_list(parts.select(F.explode(tokenize("p_name")).alias("w")), "w")
    cut = segmenter(spark, words, unspaced="a-z")
    return parts.select(
        "p_partkey", F.array_join(cut(F.translate("p_name", " ", "")), " ").alias("words"))


# ================================================================ change log
from tidewater.operators import cdc, dedupe, dims, trade  # noqa: E402


def clog(spark, sf):
    return dt.change_log(spark, sf)


@register("change_rows")
def q_change_rows(spark, sf):
    return cdc.change_rows(clog(spark, sf), "order_detail", ("insert",),
                           ["id", "order_id", "sku_id", "sku_num", "source_type",
                            "create_time"], database=dt.DATABASE)


@register("cart_add")
def q_cart_add(spark, sf):
    return cdc.cart_add(clog(spark, sf)).select(
        "id", "user_id", "sku_id", "sku_num", "create_time", "operate_time", "source_type",
        "ts", "sku_name", "is_checked", "is_ordered", "order_time")


@register("favor_add")
def q_favor_add(spark, sf):
    return cdc.favor_add(clog(spark, sf))


@register("coupon_get")
def q_coupon_get(spark, sf):
    return cdc.coupon_get(clog(spark, sf))


@register("coupon_order")
def q_coupon_order(spark, sf):
    return cdc.coupon_order(clog(spark, sf))


@register("coupon_pay")
def q_coupon_pay(spark, sf):
    return cdc.coupon_pay(clog(spark, sf))


@register("user_register")
def q_user_register(spark, sf):
    return cdc.user_register(clog(spark, sf))


@register("payment_success_rows")
def q_payment_success_rows(spark, sf):
    return cdc.payment_success_rows(clog(spark, sf))


@register("refund_order_rows")
def q_refund_order_rows(spark, sf):
    return cdc.refund_order_rows(clog(spark, sf))


def wide(spark, sf):
    return trade.order_wide(clog(spark, sf), dt.dictionary(spark))


# The change tables that the order wide fact is made of.
ORDER_TABLES = ["order_detail", "order_info", "order_detail_activity", "order_detail_coupon"]

WIDE_COLS = ["order_detail_id", "order_id", "user_id", "province_id", "sku_id", "sku_num",
             "order_price", "split_original_amount", "split_total_amount",
             "split_activity_amount", "split_coupon_amount", "activity_id", "activity_rule_id",
             "coupon_id", "coupon_use_id", "source_type", "source_type_name",
             "order_create_time", "order_status", "type", "total_amount",
             "original_total_amount", "activity_reduce_amount", "coupon_reduce_amount",
             "operate_time", "change_ts"]


@register("order_wide")
def q_order_wide(spark, sf):
    return wide(spark, sf).select(*WIDE_COLS, F.col("old").getItem("order_status")
                                  .alias("old_order_status"))


# Order lines that are joined at once where there are many, about, and the most passes (each reads
# the tables again).
PASS_LINES = 1_000_000
MOST_PASSES = 4


@register("order_fact_typed")
def q_order_fact_typed(spark, sf):
    """The order wide fact written as a JSON topic and read back with its types."""
    from tidewater.session import free_shuffles
    from tidewater.sources import topics
    folder = f"{_scratch(spark)}/topics/order-fact-{_uid()}"
    # Orders are dealt to passes, so that the disks hold the shuffle of one pass beside the topic.
    log = clog(spark, sf)
    passes = max(1, min(MOST_PASSES, -(-trade.order_lines(log).count() // PASS_LINES)))

    def dealt(table: str, order_id: str, i: int):
        of = F.pmod(F.xxhash64(F.col("data").getItem(order_id)), F.lit(passes))
        return (F.col("table") != table) | (of == i)

    for i in range(passes):
        mine = log if passes == 1 else log.where(dealt("order_detail", "order_id", i)
                                                 & dealt("order_info", "id", i))
        topics.write_topic(trade.order_fact(trade.order_wide(mine, dt.dictionary(spark))), folder)
        free_shuffles(spark)
    rows = topics.read_fact_topic(spark, folder, schemas.ORDER_FACT, schemas.ORDER_FACT_TYPES)

    def plain(name: str, kind: str):
        c = F.col(name)
        if kind.startswith("timestamp"):
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(name)
        return (c if kind == "int" else c.cast("string")).alias(name)
    kinds = {f.name: schemas.ORDER_FACT_TYPES.get(f.name, f.dataType.simpleString())
             for f in schemas.ORDER_FACT.fields}
    return rows.select(
        *[plain(c, k) for c, k in kinds.items() if c != "old"],
        F.col("old").getItem("order_status").alias("old_order_status"), "bad_record",
        F.col("bad_values").getItem("feight_fee").alias("bad_feight_fee"),
        F.coalesce(F.size("bad_values"), F.lit(0)).alias("n_bad"))


@register("order_add")
def q_order_add(spark, sf):
    return trade.order_add(wide(spark, sf)).select(*WIDE_COLS)


@register("order_cancel")
def q_order_cancel(spark, sf):
    return trade.order_cancel(wide(spark, sf)).select(*WIDE_COLS)


# Full tie-break for duplicated order lines (same line id and time).
LINE_ORDER = ["detail_ts", "sku_id", "source_id", "order_price", "sku_num",
              "split_activity_amount", "split_coupon_amount", "activity_id", "coupon_id"]


# What metrics read of settled lines.
PROVINCE_COLS = ["order_id", "province_id", "order_create_time", "split_total_amount"]
SPU_COLS = ["user_id", "order_create_time", "split_total_amount"]
ORDER_COLS = ["user_id", "order_create_time", "activity_reduce_amount", "coupon_reduce_amount",
              "original_total_amount"]


def settled_lines(spark, sf, delay_ms: int = 2_000, cols=()):
    """Settled lines: their id, ``LINE_ORDER`` and ``cols``. A settled row travels as one value,
    of which no column can be pruned later, so those that nobody reads are left out before."""
    names = list(dict.fromkeys(["order_detail_id", *LINE_ORDER, *cols]))
    # What follows goes by line, so the line id comes last in the joins too.
    placed = trade.order_add(trade.order_wide(clog(spark, sf), dt.dictionary(spark),
                                              orders_first=True))
    lines = (placed.select(*names)
             .withColumn("_ts_ms", F.col("detail_ts") * 1000))
    # A line's first order-wide row is its first change record (a line belongs to one
    # order), so first times come from the narrow line stream, not the wide join.
    firsts = (trade.order_lines(clog(spark, sf)).groupBy("order_detail_id")
              .agg(F.min(F.col("detail_ts") * 1000)))
    return dedupe.settle_latest(lines, "order_detail_id", "_ts_ms", delay_ms,
                                ["_ts_ms", *LINE_ORDER[1:]], firsts=firsts).drop("_ts_ms")


@register("payment_detail")
def q_payment_detail(spark, sf):
    log = clog(spark, sf)
    lines = trade.order_add(trade.order_wide(log, dt.dictionary(spark)))
    return trade.payment_detail(cdc.payment_success_rows(log), lines, dt.dictionary(spark))


@register("refund_wide")
def q_refund_wide(spark, sf):
    log = clog(spark, sf)
    return trade.refund_wide(cdc.refund_rows(log), cdc.refund_order_rows(log),
                             dt.dictionary(spark))


@register("comment_wide")
def q_comment_wide(spark, sf):
    return trade.comment_wide(cdc.comment_rows(clog(spark, sf)), dt.dictionary(spark))


@register("cart_wide")
def q_cart_wide(spark, sf):
    return trade.cart_wide(cdc.cart_add(clog(spark, sf)), dt.dictionary(spark)).select(
        "id", "user_id", "sku_id", "sku_num", "source_type", "source_type_name", "ts",
        "sku_name", "is_checked", "is_ordered", "order_time")


@register("lookup_join")
def q_lookup_join(spark, sf):
    od = cdc.change_rows(clog(spark, sf), "order_detail", ("insert",),
                         ["id", "source_type"], keep=("ts",))
    return dims.lookup_join(od, dt.dictionary(spark), "source_type", "dic_code",
                            ["dic_name"], how="left")


def product(spark, sf):
    def build():
        t = dt.product_tables(spark, sf)
        return dims.product_dim(t["sku_info"], t["spu_info"], t["base_trademark"],
                                t["base_category3"], t["base_category2"],
                                t["base_category1"])
    return build()


@register("enrich_product")
def q_enrich_product(spark, sf):
    lines = settled_lines(spark, sf, cols=["split_total_amount"]).select(
        "order_detail_id", "sku_id", "split_total_amount")
    return dims.lookup_join(lines, product(spark, sf), "sku_id", "sku_id",
                            ["spu_id", "spu_name", "tm_id", "tm_name", "category3_id",
                             "category3_name", "category2_id", "category2_name",
                             "category1_id", "category1_name"])


# ---------------------------------------------------------------- dedupe

@register("latest_per_key")
def q_latest_per_key(spark, sf):
    od = trade.order_lines(clog(spark, sf)).select("order_detail_id", *LINE_ORDER[:7])
    return dedupe.latest_per_key(od, ["order_detail_id"], LINE_ORDER[:7]).select(
        "order_detail_id", "detail_ts", "sku_id", "order_price", "sku_num")


@register("settle_latest")
def q_settle_latest(spark, sf):
    return settled_lines(spark, sf, 30 * 86_400_000, ["split_total_amount"]).select(
        "order_detail_id", "detail_ts", "sku_id", "split_total_amount", "activity_id",
        "coupon_id")


@register("first_per_key_gap")
def q_first_per_key_gap(spark, sf):
    od = trade.order_lines(clog(spark, sf)).withColumn("_ts_ms", F.col("detail_ts") * 1000)
    return dedupe.first_per_key_gap(od, "order_detail_id", "_ts_ms", 30 * 86_400_000,
                                    ["_ts_ms", *LINE_ORDER[1:7]]).select(
        "order_detail_id", "detail_ts", "sku_id", "order_price")


@register("latest_by_key")
def q_latest_by_key(spark, sf):
    carts = clog(spark, sf).where(F.col("table") == "cart_info").select(
        F.col("data").getItem("id").alias("id"), "ts", "type", "data",
        F.col("data").getItem("sku_num").alias("sku_num"),
        F.col("data").getItem("sku_id").alias("sku_id"))
    cur = dedupe.latest_by_key(carts, ["id"], ["ts", "type", "sku_num", "sku_id"],
                               payload="data")
    return cur.select("id", "ts", "type", "sku_num")


# ---------------------------------------------------------------- trade metrics

@register("register_metrics")
def q_register_metrics(spark, sf):
    return metrics.register_metrics(cdc.user_register(clog(spark, sf)))


@register("cart_user_metrics")
def q_cart_user_metrics(spark, sf):
    return metrics.cart_user_metrics(trade.cart_daily_unique(cdc.cart_add(clog(spark, sf))))


@register("order_metrics")
def q_order_metrics(spark, sf):
    return metrics.order_metrics(
        trade.order_unique_and_new(settled_lines(spark, sf, cols=ORDER_COLS)))


@register("payment_metrics")
def q_payment_metrics(spark, sf):
    log = clog(spark, sf)
    lines = trade.order_add(trade.order_wide(log, dt.dictionary(spark)))
    # The payment facts feed a neighbour lookup (two branches): written once as a layer
    # table instead of evaluating the wide join twice.
    from tidewater.session import materialize
    pays = materialize(trade.payment_detail(cdc.payment_success_rows(log), lines,
                                            dt.dictionary(spark)), "payment_detail")
    pays = dedupe.first_per_key_gap(pays.withColumn("_ts_ms", F.col("ts") * 1000),
                                    "order_detail_id", "_ts_ms", 5_000).drop("_ts_ms")
    return metrics.payment_metrics(trade.pay_unique_and_new(pays))


@register("province_order_metrics")
def q_province_order_metrics(spark, sf):
    return metrics.province_order_metrics(settled_lines(spark, sf, cols=PROVINCE_COLS),
                                          dt.province_table(spark, sf))


@register("spu_order_metrics")
def q_spu_order_metrics(spark, sf):
    return metrics.spu_order_metrics(settled_lines(spark, sf, cols=SPU_COLS), product(spark, sf))


@register("refund_metrics")
def q_refund_metrics(spark, sf):
    refunds = cdc.refund_rows(clog(spark, sf)).withColumn("_ts_ms", F.col("ts") * 1000)
    refunds = dedupe.first_per_key_gap(refunds, "id", "_ts_ms", 5_000,
                                       ["_ts_ms", "sku_id", "refund_amount", "refund_num"])
    return metrics.refund_metrics(refunds, product(spark, sf))


# Day-long windows, in which sums and distinct counts have many rows.
DAILY = {
    "login_metrics": lambda spark, sf: metrics.login_metrics(
        visitors.login_unique_and_back(page_log(spark, sf)), "1 day"),
    "page_uv_metrics": lambda spark, sf: metrics.page_uv_metrics(
        visitors.page_daily_unique(page_log(spark, sf)), "1 day"),
    "register_metrics": lambda spark, sf: metrics.register_metrics(
        cdc.user_register(clog(spark, sf)), "1 day"),
    "cart_user_metrics": lambda spark, sf: metrics.cart_user_metrics(
        trade.cart_daily_unique(cdc.cart_add(clog(spark, sf))), "1 day"),
    "order_metrics": lambda spark, sf: metrics.order_metrics(
        trade.order_unique_and_new(settled_lines(spark, sf, cols=ORDER_COLS)), "1 day"),
    "province_order_metrics": lambda spark, sf: metrics.province_order_metrics(
        settled_lines(spark, sf, cols=PROVINCE_COLS), dt.province_table(spark, sf), "1 day"),
    "spu_order_metrics": lambda spark, sf: metrics.spu_order_metrics(
        settled_lines(spark, sf, cols=SPU_COLS), product(spark, sf), "1 day"),
}
for _name, _build in DAILY.items():
    register(f"{_name}_1d")(_build)


# ================================================================ joins of the samples
from tidewater.operators import joins, reports  # noqa: E402


def _event_side(spark, sf, etype: str, p: str):
    ev = dt.table(spark, sf, "events").where(F.col("event_type") == etype)
    return ev.select(F.col("user_id"), F.col("event_id").alias(f"{p}_id"),
                     F.expr("unix_micros(cast(ts as timestamp)) div 1000").alias(f"{p}_ts"))


def _interval(spark, sf, bound_ms: int, how: str = "inner"):
    left = _event_side(spark, sf, "view", "l")
    right = _event_side(spark, sf, "purchase", "r")
    return joins.interval_join(left, right, "user_id", "l_ts", "r_ts", -bound_ms, bound_ms, how)


@register("interval_join")
def q_interval_join(spark, sf):
    return _interval(spark, sf, 5_000)


@register("interval_join_10m")
def q_interval_join_10m(spark, sf):
    return _interval(spark, sf, 600_000)


for _how in ("left", "right", "full"):
    register(f"interval_join_10m_{_how}")(
        lambda spark, sf, _h=_how: _interval(spark, sf, 600_000, _h))


def _equi_sides(spark, sf):
    # Orders refer to customers by twice their key here: odd customers have no order, and
    # orders of the upper half no customer, so every kind of join differs.
    c = dt.table(spark, sf, "customer").select("c_custkey", "c_name")
    o = dt.table(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_custkey") * 2).alias("customer_ref"))
    return c, o


def _equi(spark, sf, how: str):
    return joins.equi_join(*_equi_sides(spark, sf), "c_custkey", "customer_ref", how)


for _how in ("inner", "left", "right", "full"):
    register(f"equi_join_{_how}")(lambda spark, sf, _h=_how: _equi(spark, sf, _h))


def _latest_sides(spark, sf):
    li = dt.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship_day"))
    # Orders by one and a half of their key: some lines find none.
    o = dt.table(spark, sf, "orders").select(
        F.expr("o_orderkey + o_orderkey div 2").alias("order_ref"), "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_day"))
    return li, o


@register("latest_left_join")
def q_latest_left_join(spark, sf):
    out = joins.latest_left_join(
        *_latest_sides(spark, sf), "l_orderkey",
        ["ship_day", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"],
        ["order_day"], right_key="order_ref")
    return out.select("l_orderkey", "l_linenumber", "ship_day", "o_orderstatus")


# ================================================================ change log as text
@register("change_log_json")
def q_change_log_json(spark, sf):
    """Cancelled orders from the change log's JSON text."""
    from tidewater.session import shared_path
    log = clog(spark, sf)
    raw = log.select(F.to_json(F.struct(*log.columns), {"ignoreNullFields": "false"})
                     .alias("value"))
    # Several joins read the log, so it is parsed once, and what they read of it is kept as a
    # table by the changed table. Few changes are cancellations, so lines meet those first.
    parsed = cdc.read_change_log(raw)
    path = shared_path(spark, "change_log")
    (parsed.where(F.col("table").isin(*ORDER_TABLES)).write.partitionBy("table")
     .option("compression", "zstd").parquet(path))
    parsed = spark.read.schema(parsed.schema).parquet(path).select(*parsed.columns)
    out = trade.order_cancel(trade.order_wide(parsed, dt.dictionary(spark), orders_first=True))
    return out.select(*q_order_cancel(spark, sf).columns)


# ================================================================ dims
@register("apply_rules")
def q_apply_rules(spark, sf):
    tagged = dims.apply_rules(clog(spark, sf), dt.rules(spark))
    return tagged.select("sink_table", "table", "type", "ts",
                         F.col("data").getItem("id").alias("id"))


@register("prune_columns")
def q_prune_columns(spark, sf):
    pruned = dims.prune_columns(dims.apply_rules(clog(spark, sf), dt.rules(spark)))
    return (pruned.select("sink_table", F.col("data").getItem("id").alias("pk"), "ts", "type",
                          F.explode("data").alias("column", "value"))
            .where(F.col("value").isNotNull()))


@register("maintain_dims")
def q_maintain_dims(spark, sf):
    return dims.dim_long(dims.maintain_dims(clog(spark, sf), dt.rules(spark)))


# ================================================================ reports
GMV_DAY = 19970315
UV_DAY = 20240115


def province_metrics_table(spark, sf):
    return metrics.province_order_metrics(settled_lines(spark, sf, cols=PROVINCE_COLS),
                                          dt.province_table(spark, sf))


@register("gmv_report")
def q_gmv_report(spark, sf):
    return reports.gmv_report(province_metrics_table(spark, sf), GMV_DAY)


@register("uv_by_channel_report")
def q_uv_by_channel_report(spark, sf):
    return reports.uv_by_channel_report(metrics.channel_metrics(page_log(spark, sf)), UV_DAY)


@register("count_by_key")
def q_count_by_key(spark, sf):
    carts = clog(spark, sf).where(F.col("table") == "cart_info").select(
        F.col("data").getItem("id").alias("id"), "ts", "type", "data",
        F.col("data").getItem("user_id").alias("user_id"))
    cur = dedupe.latest_by_key(carts, ["id"], ["ts", "type", "user_id"], payload="data")
    return reports.count_by_key(cur.select("user_id"), "user_id")


@register("chart_json")
def q_chart_json(spark, sf):
    return reports.chart_json(q_uv_by_channel_report(spark, sf))


# ================================================================ streaming forms
# The oracles restrict the batch results to what the last watermark lets through.

# Search pages that arrive together, about: each may have the words of a whole document.
SEARCH_ROWS = 200_000


def _stream_input(spark, sf, name):
    from tidewater.streaming import jobs
    folder = jobs.land_page_log(spark, page_log(spark, sf), name)
    return jobs.read_topic_stream(spark, folder)


@register("stream_unique_visitor")
def q_stream_unique_visitor(spark, sf):
    from tidewater.streaming import jobs
    s = _stream_input(spark, sf, "uv")
    return jobs.run_to_table(spark, jobs.unique_visitor_stream(s), "unique_visitor").select(
        "offset", "mid", "ts", "is_new")


@register("stream_user_jump")
def q_stream_user_jump(spark, sf):
    from tidewater.streaming import jobs
    s = _stream_input(spark, sf, "uj")
    return jobs.run_to_table(spark, jobs.user_jump_stream(s), "user_jump").select(
        "offset", "mid", "ts")


@register("stream_channel_metrics")
def q_stream_channel_metrics(spark, sf):
    from tidewater.streaming import jobs
    pages = jobs.land_page_log(spark, page_log(spark, sf), "cm")
    topics = []
    for name, job in (("cm_uv", jobs.unique_visitor_stream), ("cm_uj", jobs.user_jump_stream)):
        jobs.prepare(spark)
        topics.append(jobs.run_to_folder(job(jobs.read_topic_stream(spark, pages)),
                                         f"{_scratch(spark)}/streams/{name}-{_uid()}"))
    return jobs.run_to_table(spark, jobs.channel_metrics_stream(spark, pages, *topics),
                             "channel_metrics")


@register("stream_keyword_metrics")
def q_stream_keyword_metrics(spark, sf):
    from tidewater.streaming import jobs
    pages = search_page_log(spark, sf)
    rows = pages.select(
        "ts", "offset", F.col("page.last_page_id").alias("last_page_id"),
        F.col("page.item").alias("item"), F.col("page.item_type").alias("item_type"))
    base = f"{_scratch(spark)}/search-{_uid()}"
    times = page_log(spark, sf).where(F.col("page.last_page_id") == "search").select("ts")
    staged = jobs.stage_arrivals(rows, F.col("ts"), jobs.time_cuts(times, SEARCH_ROWS), base)
    return jobs.run_arrivals(spark, jobs.keyword_metrics_stream(spark, f"{base}/topic"), staged,
                             base)


@register("stream_fix_new_flag")
def q_stream_fix_new_flag(spark, sf):
    from tidewater.streaming import jobs
    from tidewater.streaming.processors import FLAT_COLS
    log = dt.click_log(spark, sf)  # all clean records, start records included
    folder = jobs.land_topic(jobs.flat_page(log).select(*FLAT_COLS),
                             f"{_scratch(spark)}/topics/clicks-{_uid()}")
    s = jobs.read_topic_stream(spark, folder)
    return jobs.run_to_table(spark, jobs.new_flag_stream(s), "fix_new_flag").select(
        "offset", "mid", "ts", "is_new")


def _fan_out(spark, sf, output: str):
    """One output of the routing job over the raw click log, flags repaired on the way."""
    from tidewater.streaming import jobs
    base = f"{_scratch(spark)}/fanout-{_uid()}"
    jobs.land_topic(dt.raw_click_log(spark, sf), f"{base}/raw")
    raw = spark.readStream.schema("value string, offset long").parquet(f"{base}/raw")
    jobs.fan_out(raw, f"{base}/out")
    return spark.read.parquet(f"{base}/out/{output}")


@register("stream_fan_out_page")
def q_stream_fan_out_page(spark, sf):
    return _fan_out(spark, sf, "page").select(
        "offset", "ts", "common.mid", "common.uid", "common.is_new", "common.vc",
        "common.ch", "common.ar", "page.page_id", "page.last_page_id", "page.during_time",
        F.col("err.error_code").alias("error_code"))


@register("stream_fan_out_start")
def q_stream_fan_out_start(spark, sf):
    return _fan_out(spark, sf, "start").select(
        "offset", "ts", "common.mid", "common.is_new", "start.entry", "start.loading_time",
        "start.open_ad_id", F.col("err.error_code").alias("error_code"))


@register("stream_login_unique_and_back")
def q_stream_login_unique_and_back(spark, sf):
    from tidewater.streaming import jobs
    rows = logs.login_rows(page_log(spark, sf)).select(
        F.col("common.uid").alias("uid"), "ts", "offset",
        F.timestamp_millis("ts").alias("event_time"))
    folder = jobs.land_topic(rows, f"{_scratch(spark)}/topics/logins-{_uid()}")
    s = (spark.readStream.schema("uid string, ts long, offset long, event_time timestamp")
         .parquet(folder).withWatermark("event_time", "2 seconds"))
    return jobs.run_to_table(spark, jobs.login_stream(s), "login").select(
        "offset", "uid", "ts", "dt", "uu_ct", "back_ct")


@register("stream_first_per_key_gap")
def q_stream_first_per_key_gap(spark, sf):
    from tidewater.streaming import jobs
    cols = "order_detail_id string, ts long, sku_id string, source_id string, " \
           "order_price string, sku_num string, split_activity_amount string, " \
           "split_coupon_amount string, detail_ts long, event_time timestamp"
    od = trade.order_lines(clog(spark, sf)).select(
        "order_detail_id", (F.col("detail_ts") * 1000).alias("ts"), *LINE_ORDER[1:7],
        "detail_ts", F.timestamp_seconds("detail_ts").alias("event_time"))
    folder = jobs.land_topic(od, f"{_scratch(spark)}/topics/lines-{_uid()}")
    s = spark.readStream.schema(cols).parquet(folder).withWatermark("event_time", "2 seconds")
    out = jobs.gap_stream(s, "order_detail_id", 30 * 86_400_000, ["ts", *LINE_ORDER[1:7]], cols)
    return jobs.run_to_table(spark, out, "first_per_key_gap").select(
        "order_detail_id", "detail_ts", "sku_id", "order_price")


@register("stream_order_wide")
def q_stream_order_wide(spark, sf):
    from tidewater.streaming import jobs
    from tidewater.streaming import trade as st
    tables = ORDER_TABLES
    log = clog(spark, sf).where(F.col("table").isin(*tables))
    root = st.new_topics(spark, tables, "orders")
    wide_rows = st.order_wide_stream({t: st.topic(spark, root, t) for t in tables},
                                     dt.dictionary(spark)).select(*WIDE_COLS, "old_order_status")
    out = f"{_scratch(spark)}/streams/order_wide-{_uid()}"
    # The changes arrive in order of time, and the stream goes on after each arrival: what it
    # holds is an arrival and the retention, not the whole log.
    jobs.prepare(spark)
    for part in st.arrivals(log):
        st.append_changes(part, root)
        jobs.run_to_folder(wide_rows, out)
    return spark.read.schema(wide_rows.schema).parquet(f"{out}/out")


@register("stream_settle_latest")
def q_stream_settle_latest(spark, sf):
    from tidewater.streaming import jobs
    from tidewater.streaming import trade as st
    cols = ("order_detail_id string, ts long, sku_id string, source_id string, "
            "order_price string, sku_num string, split_activity_amount string, "
            "split_coupon_amount string, detail_ts long, event_time timestamp")
    od = trade.order_lines(clog(spark, sf)).select(
        "order_detail_id", (F.col("detail_ts") * 1000).alias("ts"), *LINE_ORDER[1:7],
        "detail_ts", F.timestamp_seconds("detail_ts").alias("event_time"))
    folder = jobs.land_topic(od, f"{_scratch(spark)}/topics/settle-{_uid()}")
    s = spark.readStream.schema(cols).parquet(folder).withWatermark("event_time", "2 seconds")
    out = st.settle_stream(s, "order_detail_id", 30 * 86_400_000, ["ts", *LINE_ORDER[1:7]], cols)
    return jobs.run_to_table(spark, out, "settle").select(
        "order_detail_id", "detail_ts", "sku_id", "order_price", "sku_num")


@register("stream_province_order_metrics")
def q_stream_province_order_metrics(spark, sf):
    return _province_stream(spark, sf, "10 seconds")


@register("stream_province_order_metrics_1d")
def q_stream_province_order_metrics_1d(spark, sf):
    return _province_stream(spark, sf, "1 day")


def _province_stream(spark, sf, length):
    from tidewater.streaming import jobs
    from tidewater.streaming import trade as st
    lines = settled_lines(spark, sf, cols=PROVINCE_COLS).select(
        "order_id", "province_id", "split_total_amount",
        F.timestamp_seconds("detail_ts").alias("event_time"))
    base = f"{_scratch(spark)}/settled-{_uid()}"
    times = trade.order_lines(clog(spark, sf)).select(F.col("detail_ts").alias("ts"))
    staged = jobs.stage_arrivals(lines, F.unix_seconds("event_time"),
                                 jobs.time_cuts(times, jobs.ARRIVAL_ROWS), base)
    s = (spark.readStream.schema(lines.schema).parquet(f"{base}/topic")
         .withWatermark("event_time", "2 seconds"))
    return jobs.run_arrivals(
        spark, st.province_order_stream(s, dt.province_table(spark, sf), length), staged, base)


@register("stream_interval_join")
def q_stream_interval_join(spark, sf):
    """Views with the purchases of the user within ten minutes, views without one as well."""
    from tidewater.streaming import jobs
    from tidewater.streaming import trade as st
    sides = []
    for etype, p in (("view", "l"), ("purchase", "r")):
        rows = _event_side(spark, sf, etype, p).withColumn(
            f"{p}_time", F.timestamp_millis(f"{p}_ts"))
        folder = jobs.land_topic(rows, f"{_scratch(spark)}/topics/{etype}-{_uid()}")
        sides.append(spark.readStream.schema(rows.schema).parquet(folder)
                     .withWatermark(f"{p}_time", "0 seconds"))
    out = st.interval_join_stream(*sides, "user_id", "l_time", "r_time", "-10 minutes",
                                  "10 minutes", "left")
    return jobs.run_to_table(spark, out.drop("l_time", "r_time"), "interval")


@register("stream_maintain_dims")
def q_stream_maintain_dims(spark, sf):
    from tidewater.streaming import dims as sd
    base = f"{_scratch(spark)}/dims-{_uid()}"
    # Four micro-batches of many files: changes of a key meet across them, and each is read
    # and parsed by many tasks.
    dt.dim_topic(spark, sf).repartition(48, "offset").write.parquet(f"{base}/changes")
    dt.rule_topic(spark).write.parquet(f"{base}/rules")
    changes = (spark.readStream.schema("value string, offset long")
               .option("maxFilesPerTrigger", 12).parquet(f"{base}/changes"))
    sd.maintain(changes, lambda s: dims.read_rules(s.read.parquet(f"{base}/rules")),
                f"{base}/table", every=2)
    return dims.dim_long(sd.read_dims(spark, f"{base}/table"))


def _changelog(spark, sides, how: str, latest: bool = False):
    """Operations of the join of two tables that arrive in three micro-batches, replayed."""
    from tidewater.streaming import changelog, jobs
    folder = f"{_scratch(spark)}/topics/changelog-{_uid()}"
    # Rows stay in the tasks that read them; each task writes three files.
    (sides[0].unionByName(sides[1]).withColumn("_part", F.pmod(F.xxhash64("row"), F.lit(3)))
     .write.partitionBy("_part").option("compression", "zstd").parquet(folder))
    files = len(spark.read.parquet(folder).inputFiles())
    s = (spark.readStream.schema(changelog.IN)
         .option("maxFilesPerTrigger", max(1, -(-files // 3))).parquet(folder)
         .select("side", "k", "ord", "row"))
    return changelog.replay(jobs.run_to_table(
        spark, changelog.join_stream(s, how, latest), "changelog"))


def _changelog_equi(spark, sf, how: str):
    from tidewater.streaming import changelog
    c, o = _equi_sides(spark, sf)
    out = _changelog(spark, (changelog.side(c, "l", "c_custkey"),
                             changelog.side(o, "r", "customer_ref")), how)
    return changelog.rows(out, "c_custkey long, c_name string",
                          "o_orderkey long, customer_ref long")


for _how in ("inner", "left", "right", "full"):
    register(f"stream_changelog_{_how}")(lambda spark, sf, _h=_how: _changelog_equi(spark, sf, _h))


@register("stream_changelog_latest")
def q_stream_changelog_latest(spark, sf):
    """The latest line of an order and the state of the order it refers to, as changes come."""
    from tidewater.streaming import changelog
    li, o = _latest_sides(spark, sf)
    # The order of W1: ship day, then line, part, supplier and price; as one text it is compared
    # as such, so the numbers are padded.
    li = li.select(F.concat_ws("|", "ship_day", *[
        F.lpad(F.col(c).cast("decimal(18,2)").cast("string"), 20, "0") for c in
        ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")]).alias("_at"),
        "l_orderkey", "l_linenumber", "ship_day")
    out = _changelog(spark, (changelog.side(li, "l", "l_orderkey"),
                             changelog.side(o, "r", "order_ref")), "left", latest=True)
    return changelog.rows(out, "l_orderkey long, l_linenumber int, ship_day string",
                          "o_orderstatus string")


def _scratch(spark):
    from tidewater.session import ensure_checkpoint_dir
    return ensure_checkpoint_dir(spark)


def _uid():
    import uuid
    return uuid.uuid4().hex[:8]
