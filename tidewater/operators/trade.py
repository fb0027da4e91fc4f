"""Trade facts built by joining change streams with each other and with the code
dictionary (J1-J5, P13, P14, T5-T7).

The planner broadcasts the dictionary by its measured size. Joins between
change streams are left to the planner (sort-merge at scale, AQE converts a small side
to broadcast at run time from measured sizes and splits skewed partitions).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater import schemas
from tidewater.functions.sequence import first_per_group
from tidewater.functions.time import first_token, text_to_ts
from tidewater.operators.cdc import change_rows, old_value_present

DETAIL_FIELDS = ["id", "order_id", "sku_id", "sku_name", "order_price", "sku_num",
                 "create_time", "source_type", "source_id", "split_total_amount",
                 "split_activity_amount", "split_coupon_amount"]
ORDER_FIELDS = ["id", "consignee", "consignee_tel", "total_amount", "order_status", "user_id",
                "payment_way", "out_trade_no", "trade_body", "operate_time", "expire_time",
                "process_status", "tracking_no", "parent_order_id", "province_id",
                "activity_reduce_amount", "coupon_reduce_amount", "original_total_amount",
                "feight_fee", "feight_fee_reduce"]


def order_lines(log: DataFrame) -> DataFrame:
    """order_detail inserts with ``split_original_amount`` = price x number, decimal
    text with scale 4 (F5)."""
    od = change_rows(log, "order_detail", ("insert",), DETAIL_FIELDS, keep=("ts",))
    orig = (F.col("order_price").try_cast("decimal(16,2)")
            * F.col("sku_num").try_cast("decimal(16,2)")).cast("string")
    return (od.withColumnRenamed("id", "order_detail_id")
            .withColumnRenamed("create_time", "order_create_time")
            .withColumnRenamed("ts", "detail_ts")
            .withColumn("split_original_amount", orig))


def order_wide(log: DataFrame, dic: DataFrame, orders_first: bool = False) -> DataFrame:
    """Order wide fact (J1): order lines x order changes (insert and update, inner),
    activity and coupon lines (left, by line id), source-type name (inner lookup).

    Line-keyed joins run first so the line stream is shuffled by line id once, then
    joined to the order changes; the dictionary lookup comes last. With ``orders_first`` the
    result stays partitioned by line id, for callers that go on by line and read few columns
    of few changes: lines then move once an order id and once a line id.
    """
    od = order_lines(log)
    oa = change_rows(log, "order_detail_activity", ("insert",),
                     ["order_detail_id", "activity_id", "activity_rule_id", "create_time"],
                     keep=()).withColumnRenamed("create_time", "activity_create_time")
    oc = change_rows(log, "order_detail_coupon", ("insert",),
                     ["order_detail_id", "coupon_id", "coupon_use_id", "create_time"],
                     keep=()).withColumnRenamed("create_time", "coupon_create_time")
    oi = (change_rows(log, "order_info", ("insert", "update"), ORDER_FIELDS,
                      keep=("type", "old", "ts"))
          .withColumnRenamed("id", "_oid").withColumnRenamed("ts", "change_ts"))
    names = dic.select(F.col("dic_code"), F.col("dic_name").alias("source_type_name"))
    lines = od.join(names, od["source_type"] == names["dic_code"], "inner").drop("dic_code")

    def with_orders(df: DataFrame) -> DataFrame:
        return df.join(oi, df["order_id"] == oi["_oid"], "inner").drop("_oid")

    def with_extras(df: DataFrame) -> DataFrame:
        return df.join(oa, "order_detail_id", "left").join(oc, "order_detail_id", "left")

    if not orders_first:
        return with_orders(with_extras(lines))
    wide = with_extras(with_orders(lines))
    first = [*lines.columns, *oa.columns[1:], *oc.columns[1:]]
    return wide.select(*first, *[c for c in wide.columns if c not in first])


def order_fact(wide: DataFrame) -> DataFrame:
    """The order wide fact as its topic holds it (S6): the columns of
    ``schemas.ORDER_FACT`` in order. ``pt`` is the time of the line, ``ts`` that of the
    later of the line and its order's change."""
    named = {"dic_name": F.col("source_type_name"),
             "pt": F.timestamp_seconds("detail_ts"),
             "ts": F.timestamp_seconds(F.greatest("detail_ts", "change_ts"))}
    return wide.select(*[named.get(f.name, F.col(f.name)).alias(f.name)
                         for f in schemas.ORDER_FACT.fields])


def order_add(wide: DataFrame) -> DataFrame:
    """Order placed: wide rows from the order insert."""
    return wide.where(F.col("type") == "insert")


def order_cancel(wide: DataFrame) -> DataFrame:
    """Order cancelled: update to 1003 whose old status value is not null."""
    return wide.where((F.col("type") == "update") & (F.col("order_status") == "1003")
                      & old_value_present("order_status"))


def payment_detail(payments: DataFrame, lines: DataFrame, dic: DataFrame) -> DataFrame:
    """Paid order lines (J2): payments x order lines (inner, on order id) x payment-type
    name (inner lookup)."""
    names = dic.select(F.col("dic_code"),
                                   F.col("dic_name").alias("payment_type_name"))
    pay = payments.join(names, payments["payment_type"] == names["dic_code"], "inner")
    ln = lines.select("order_detail_id", F.col("order_id").alias("_oid"), "user_id", "sku_id",
                      "province_id", "activity_id", "activity_rule_id", "coupon_id",
                      "source_id", "source_type", "sku_num", "split_original_amount",
                      "split_activity_amount", "split_coupon_amount",
                      F.col("split_total_amount").alias("split_payment_amount"))
    out = pay.drop("user_id").join(ln, pay["order_id"] == ln["_oid"], "inner")
    return out.select(
        "order_detail_id", "order_id", "user_id", "sku_id", "province_id", "activity_id",
        "activity_rule_id", "coupon_id", F.col("payment_type").alias("payment_type_code"),
        "payment_type_name", "callback_time", "source_id", "source_type", "sku_num",
        "split_original_amount", "split_activity_amount", "split_coupon_amount",
        "split_payment_amount", "ts")


def refund_wide(refunds: DataFrame, refund_orders: DataFrame, dic: DataFrame) -> DataFrame:
    """Refunds (J3): refund rows, left join the refunded-order changes (province), left
    lookups of the refund type and reason names (the dictionary used twice)."""
    rt = dic.select(F.col("dic_code").alias("_rt"),
                                F.col("dic_name").alias("refund_type_name"))
    rr = dic.select(F.col("dic_code").alias("_rr"),
                                F.col("dic_name").alias("refund_reason_type_name"))
    ro = refund_orders.select(F.col("id").alias("_oid"), "province_id")
    out = (refunds.join(ro, refunds["order_id"] == ro["_oid"], "left")
           .join(rt, refunds["refund_type"] == rt["_rt"], "left")
           .join(rr, refunds["refund_reason_type"] == rr["_rr"], "left"))
    return out.select(
        "id", "user_id", "order_id", "sku_id", "province_id",
        F.date_format(text_to_ts("create_time"), "yyyy-MM-dd").alias("date_id"),
        "create_time", "refund_type", "refund_type_name", "refund_reason_type",
        "refund_reason_type_name", "refund_reason_txt", "refund_num", "refund_amount", "ts")


def comment_wide(comments: DataFrame, dic: DataFrame) -> DataFrame:
    """Comments with the appraise name (J4, left lookup)."""
    names = dic.select(F.col("dic_code"), F.col("dic_name").alias("appraise_name"))
    out = comments.join(names, comments["appraise"] == names["dic_code"], "left")
    return out.select("id", "user_id", "sku_id", "order_id",
                      F.date_format(text_to_ts("create_time"), "yyyy-MM-dd").alias("date_id"),
                      "create_time", "appraise", "appraise_name", "ts")


def cart_wide(carts: DataFrame, dic: DataFrame) -> DataFrame:
    """Cart additions with the source-type name (J5, inner lookup)."""
    names = dic.select(F.col("dic_code"),
                                   F.col("dic_name").alias("source_type_name"))
    return carts.join(names, carts["source_type"] == names["dic_code"], "inner").drop("dic_code")


# ------------------------------------------------------------------ user state machines

def daily_first(df: DataFrame, user: str, day_col, order_cols) -> DataFrame:
    """First row of every (user, day) - the batch form of a "last active day" state."""
    return first_per_group(df.withColumn("_tw_day", day_col), [user, "_tw_day"], order_cols)


def cart_daily_unique(carts: DataFrame) -> DataFrame:
    """First cart addition of every (user, day) (T5); the day is taken from
    operate_time, else create_time (F16)."""
    t = F.coalesce(F.col("operate_time"), F.col("create_time"))
    rows = carts.withColumn("event_time", t)
    return daily_first(rows, "user_id", first_token(t), ["event_time", "id"]).drop("_tw_day")


def order_unique_and_new(lines: DataFrame) -> DataFrame:
    """Per order line (T6): ``unique`` = 1 on the user's first line of a day, ``new`` = 1
    on the user's first line ever; every line is kept with its amounts.

    First-of-day rows come from a (user, day) aggregation; "first ever" is a window
    over that user-day table, bounded by days per user, then joined back by line id.
    """
    order = ["order_create_time", "order_detail_id"]
    days = daily_first(lines.select("user_id", "order_detail_id", "order_create_time"),
                       "user_id", first_token(F.col("order_create_time")), order)
    w = Window.partitionBy("user_id").orderBy("_tw_day")
    flags = days.select(
        F.col("order_detail_id").alias("_fid"), F.lit(1).cast("long").alias("order_unique"),
        (F.row_number().over(w) == 1).cast("long").alias("order_new"))
    out = lines.join(flags, lines["order_detail_id"] == flags["_fid"], "left").drop("_fid")
    return (out.withColumn("order_unique", F.coalesce("order_unique", F.lit(0).cast("long")))
            .withColumn("order_new", F.coalesce("order_new", F.lit(0).cast("long"))))


def pay_unique_and_new(pays: DataFrame) -> DataFrame:
    """First payment of every (user, day), flagged ``new`` when it is the user's first
    payment day (T7); other payments emit nothing."""
    t = F.col("callback_time")
    days = daily_first(pays, "user_id", first_token(t), ["callback_time", "order_detail_id"])
    w = Window.partitionBy("user_id").orderBy("_tw_day")
    return (days.withColumn("payment_suc_unique_user_count", F.lit(1).cast("long"))
            .withColumn("payment_suc_new_user_count",
                        (F.row_number().over(w) == 1).cast("long"))
            .drop("_tw_day"))
