"""Declared schemas of every record the warehouse reads or writes.

Columns are always addressed by name, never by position.
"""

from pyspark.sql import types as T

S = T.StringType()
L = T.LongType()

COMMON = T.StructType([
    T.StructField("mid", S), T.StructField("uid", S), T.StructField("is_new", S),
    T.StructField("vc", S), T.StructField("ch", S), T.StructField("ar", S),
])

PAGE = T.StructType([
    T.StructField("page_id", S), T.StructField("last_page_id", S),
    T.StructField("item", S), T.StructField("item_type", S),
    T.StructField("during_time", L),
])

START = T.StructType([
    T.StructField("entry", S), T.StructField("loading_time", L),
    T.StructField("open_ad_id", S),
])

ERR = T.StructType([T.StructField("error_code", L), T.StructField("msg", S)])

DISPLAY = T.StructType([
    T.StructField("display_type", S), T.StructField("item", S),
    T.StructField("item_type", S), T.StructField("order", L), T.StructField("pos_id", L),
])

ACTION = T.StructType([
    T.StructField("action_id", S), T.StructField("item", S),
    T.StructField("item_type", S), T.StructField("ts", L),
])

# Click-log record (one JSON object per line in the log topic); ts is epoch milliseconds.
CLICK_LOG = T.StructType([
    T.StructField("common", COMMON),
    T.StructField("page", PAGE),
    T.StructField("start", START),
    T.StructField("err", ERR),
    T.StructField("displays", T.ArrayType(DISPLAY)),
    T.StructField("actions", T.ArrayType(ACTION)),
    T.StructField("ts", L),
])

STR_MAP = T.MapType(S, S)

# Change-log envelope of the business database topic; ts is epoch seconds. Key presence
# inside ``old`` is meaningful (a key with a null value differs from a missing key).
CHANGE_LOG = T.StructType([
    T.StructField("database", S), T.StructField("table", S), T.StructField("type", S),
    T.StructField("ts", L), T.StructField("data", STR_MAP), T.StructField("old", STR_MAP),
])

# Configuration rows for dimension routing.
RULES = T.StructType([
    T.StructField("source_table", S), T.StructField("sink_table", S),
    T.StructField("sink_columns", S), T.StructField("sink_pk", S),
    T.StructField("sink_extend", S),
])

# Rule change record {before, after, op}; ``after`` is the rule, null when deleted.
RULE_CHANGE = T.StructType([
    T.StructField("before", RULES), T.StructField("after", RULES), T.StructField("op", S),
])

DICTIONARY = T.StructType([
    T.StructField("dic_code", S), T.StructField("dic_name", S),
    T.StructField("parent_code", S),
])


# Order wide fact as its topic holds it: text, but for two times and the old values.
ORDER_FACT = T.StructType([T.StructField(n, S) for n in (
    "order_detail_id order_id sku_id sku_name order_price sku_num order_create_time "
    "source_type source_id split_original_amount split_total_amount split_activity_amount "
    "split_coupon_amount").split()] + [T.StructField("pt", T.TimestampType())] + [
    T.StructField(n, S) for n in (
        "consignee consignee_tel total_amount order_status user_id payment_way out_trade_no "
        "trade_body operate_time expire_time process_status tracking_no parent_order_id "
        "province_id activity_reduce_amount coupon_reduce_amount original_total_amount "
        "feight_fee feight_fee_reduce type").split()] + [T.StructField("old", STR_MAP)] + [
    T.StructField(n, S) for n in (
        "activity_id activity_rule_id activity_create_time coupon_id coupon_use_id "
        "coupon_create_time dic_name").split()] + [T.StructField("ts", T.TimestampType())])

# What the text columns of the order wide fact stand for.
ORDER_FACT_TYPES = {
    **{n: "decimal(16,2)" for n in (
        "order_price split_total_amount split_activity_amount split_coupon_amount total_amount "
        "activity_reduce_amount coupon_reduce_amount original_total_amount feight_fee "
        "feight_fee_reduce").split()},
    "split_original_amount": "decimal(33,4)", "sku_num": "int",
    **{n: "timestamp" for n in (
        "order_create_time operate_time expire_time activity_create_time "
        "coupon_create_time").split()},
}
