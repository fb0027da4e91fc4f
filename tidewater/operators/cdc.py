"""Change-log filters (P7-P16): rows of one table and change type, projected from the
``data`` map. ``old``-map tests keep the reference's two flavours: value-not-null
(``old_value_present``) and key presence (``old_has_key``); they differ when the old
value was null."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater import schemas
from tidewater.functions.text import parse_once
from tidewater.functions.time import text_to_date


def d(key: str) -> Column:
    """``data[key]``; null when absent (F2)."""
    return F.col("data").getItem(key)


def old_value_present(key: str) -> Column:
    return F.col("old").getItem(key).isNotNull()


def old_has_key(key: str) -> Column:
    """Key presence in ``old`` (F3), true even when the old value is null."""
    return F.coalesce(F.map_contains_key(F.col("old"), F.lit(key)), F.lit(False))


def as_int(c: Column) -> Column:
    """Text -> int; bad text gives null instead of failing the job."""
    return c.try_cast("int")


def read_change_log(raw: DataFrame, value: str = "value") -> DataFrame:
    """Change-log records from JSON text (S3): the envelope's columns and all others of
    ``raw`` but the text. Tombstones and text that is no record are left out; a key with a
    null value stays a key."""
    rows = parse_once(raw, value, schemas.CHANGE_LOG, "_c")
    return rows.where(F.col("_c.table").isNotNull()).select(
        "_c.*", *[c for c in raw.columns if c != value])


def change_rows(log: DataFrame, table: str, types: Sequence[str] | None = ("insert",),
                fields: Sequence[str] = (), database: str | None = None,
                keep: Sequence[str] = ("type", "ts")) -> DataFrame:
    """Rows of ``table`` with a change type in ``types``; ``data`` keys as columns."""
    cond = F.col("table") == table
    if database is not None:
        cond = cond & (F.col("database") == database)
    if types:
        cond = cond & F.col("type").isin(*types)
    return log.where(cond).select(*[d(f).alias(f) for f in fields], *keep)


def cart_add(log: DataFrame) -> DataFrame:
    """Cart additions (P8): inserts, or updates raising ``sku_num``; quantity is the new
    number, or the increase for updates."""
    new, old = as_int(d("sku_num")), as_int(F.col("old").getItem("sku_num"))
    cond = (F.col("table") == "cart_info") & (
        (F.col("type") == "insert")
        | ((F.col("type") == "update") & old_value_present("sku_num") & (new > old)))
    return log.where(cond).select(
        d("id").alias("id"), d("user_id").alias("user_id"), d("sku_id").alias("sku_id"),
        d("cart_price").alias("cart_price"),
        F.when(F.col("type") == "insert", new).otherwise(new - old).alias("sku_num"),
        *[d(c).alias(c) for c in ("sku_name", "is_checked", "create_time", "operate_time",
                                  "is_ordered", "order_time", "source_type", "source_id")],
        "ts")


def favor_add(log: DataFrame) -> DataFrame:
    """Favourites added (P9): inserts, or updates turning is_cancel '1' -> '0'.
    The table filter applies to both branches (the reference's and/or precedence slip,
    Q1, is fixed)."""
    cond = (F.col("table") == "favor_info") & (
        (F.col("type") == "insert")
        | ((F.col("type") == "update") & (F.col("old").getItem("is_cancel") == "1")
           & (d("is_cancel") == "0")))
    return log.where(cond).select(
        d("id").alias("id"), d("user_id").alias("user_id"), d("sku_id").alias("sku_id"),
        text_to_date(d("create_time")).alias("date_id"), d("create_time").alias("create_time"),
        "ts")


def coupon_get(log: DataFrame) -> DataFrame:
    """Coupons received: coupon_use inserts with their day (P10)."""
    return log.where((F.col("table") == "coupon_use") & (F.col("type") == "insert")).select(
        d("id").alias("id"), d("coupon_id").alias("coupon_id"), d("user_id").alias("user_id"),
        text_to_date(d("get_time")).alias("date_id"), d("get_time").alias("get_time"), "ts")


def _coupon_step(log: DataFrame, key: str, out: str) -> DataFrame:
    cond = ((F.col("table") == "coupon_use") & (F.col("type") == "update") & old_has_key(key))
    return log.where(cond).select(
        d("id").alias("id"), d("coupon_id").alias("coupon_id"), d("user_id").alias("user_id"),
        d("order_id").alias("order_id"), text_to_date(d(key)).alias("date_id"),
        d(key).alias(out), "ts")


def coupon_order(log: DataFrame) -> DataFrame:
    """Coupons used in an order: updates whose old image has the key using_time."""
    return _coupon_step(log, "using_time", "order_time")


def coupon_pay(log: DataFrame) -> DataFrame:
    """Coupons paid: updates whose old image has the key used_time."""
    return _coupon_step(log, "used_time", "payment_time")


def user_register(log: DataFrame) -> DataFrame:
    """Registrations: user_info inserts."""
    return log.where((F.col("table") == "user_info") & (F.col("type") == "insert")).select(
        d("id").alias("user_id"), text_to_date(d("create_time")).alias("date_id"),
        d("create_time").alias("create_time"), "ts")


def payment_success_rows(log: DataFrame) -> DataFrame:
    """payment_info updates to 1602 whose old status value is not null."""
    cond = ((F.col("table") == "payment_info") & (F.col("type") == "update")
            & (d("payment_status") == "1602") & old_value_present("payment_status"))
    return log.where(cond).select(
        d("user_id").alias("user_id"), d("order_id").alias("order_id"),
        d("payment_type").alias("payment_type"), d("callback_time").alias("callback_time"),
        "ts")


def refund_order_rows(log: DataFrame) -> DataFrame:
    """order_info updates to 1005 whose old image has the key order_status."""
    cond = ((F.col("table") == "order_info") & (F.col("type") == "update")
            & (d("order_status") == "1005") & old_has_key("order_status"))
    return log.where(cond).select(
        d("id").alias("id"), d("province_id").alias("province_id"),
        d("operate_time").alias("operate_time"), "ts")


def refund_rows(log: DataFrame) -> DataFrame:
    """order_refund_info inserts."""
    return change_rows(log, "order_refund_info", ("insert",),
                       ["id", "user_id", "order_id", "sku_id", "refund_type", "refund_num",
                        "refund_amount", "refund_reason_type", "refund_reason_txt",
                        "create_time"], keep=("ts",))


def comment_rows(log: DataFrame) -> DataFrame:
    """comment_info inserts."""
    return change_rows(log, "comment_info", ("insert",),
                       ["id", "user_id", "sku_id", "order_id", "create_time", "appraise"],
                       keep=("ts",))


__all__ = ["change_rows", "cart_add", "favor_add", "coupon_get", "coupon_order",
           "coupon_pay", "user_register", "payment_success_rows", "refund_order_rows",
           "refund_rows", "comment_rows", "old_has_key", "old_value_present", "d"]
