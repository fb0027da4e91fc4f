"""Adapters from the driver's parquet tables to the warehouse's inputs.

No driver table is a click log or a change log, so these functions derive them with plain
column expressions (no driver-side data, no row caps). Every recipe below is mirrored by
the DuckDB oracle in ``tidewater/plans/oracle.py``; change both together.

Fixed recipe values (click log, from ``events``; ``k`` is the ``props.k`` value 0..99):

* mid = uid = user id as text; uid is null when k % 5 = 0
* page by event type: view -> home, click -> good_detail, purchase -> payment,
  signup -> login, error -> search
* last page: null when k < 40, 'search' when k >= 90, else 'home'
* is_new = '1' when k % 3 = 0; vc = 'v' || k % 3; ch = 'ch' || k % 4; ar = k % 7
* during_time = floor(value * 10)
* start record (no page) when k % 10 = 7; err object when event type is error and k is even
* displays: k % 3 items on home/good_detail pages; one 'favor_add' action on good_detail
  pages when k is odd (its own ts is 500 ms before the page ts)
* dirty raw records: k = 13 truncated JSON, k = 14 blank, k = 15 on view events a JSON array
* the record offset in the topic is the event id
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater import schemas

# Page of each event type.
PAGE_OF_EVENT = {
    "view": "home",
    "click": "good_detail",
    "purchase": "payment",
    "signup": "login",
    "error": "search",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _k() -> Column:
    return F.get_json_object(F.col("props"), "$.k").cast("int")


def _epoch_ms(ts: str) -> Column:
    # Driver timestamps are naive UTC wall clock.
    return F.expr(f"unix_micros(cast({ts} as timestamp)) div 1000")


def _epoch_s(ts: str) -> Column:
    return F.expr(f"unix_micros(cast({ts} as timestamp)) div 1000000")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id"), _epoch_ms("ts").alias("ts_ms"), F.col("user_id"),
        F.col("event_type"), F.col("value"), _k().alias("k"))


def _is_dirty() -> Column:
    k = F.col("k")
    return (k == 13) | (k == 14) | ((k == 15) & (F.col("event_type") == "view"))


def _click_struct_cols() -> list[Column]:
    k = F.col("k")
    mid = F.col("user_id").cast("string")
    page_map = F.create_map(*[x for kv in PAGE_OF_EVENT.items() for x in map(F.lit, kv)])
    page_id = page_map[F.col("event_type")]
    is_start = (k % 10) == 7
    common = F.struct(
        mid.alias("mid"),
        F.when(k % 5 == 0, F.lit(None).cast("string")).otherwise(mid).alias("uid"),
        F.when(k % 3 == 0, F.lit("1")).otherwise(F.lit("0")).alias("is_new"),
        F.concat(F.lit("v"), (k % 3).cast("string")).alias("vc"),
        F.concat(F.lit("ch"), (k % 4).cast("string")).alias("ch"),
        (k % 7).cast("string").alias("ar"),
    )
    last_page = (F.when(k < 40, F.lit(None).cast("string"))
                 .when(k >= 90, F.lit("search")).otherwise(F.lit("home")))
    page = F.when(~is_start, F.struct(
        page_id.alias("page_id"), last_page.alias("last_page_id"),
        F.lit(None).cast("string").alias("item"), F.lit(None).cast("string").alias("item_type"),
        F.floor(F.col("value") * 10).cast("long").alias("during_time")))
    start = F.when(is_start, F.struct(
        F.when(k % 2 == 0, F.lit("icon")).otherwise(F.lit("notice")).alias("entry"),
        (k * 100).cast("long").alias("loading_time"),
        (k % 4).cast("string").alias("open_ad_id")))
    err = F.when((F.col("event_type") == "error") & (k % 2 == 0), F.struct(
        (k + 1000).cast("long").alias("error_code"),
        F.concat(F.lit("error "), k.cast("string")).alias("msg")))
    n_disp = k % 3
    displays = F.when(
        ~is_start & page_id.isin("home", "good_detail") & (n_disp > 0),
        F.transform(F.array_repeat(F.lit(0), n_disp), lambda _x, i: F.struct(
            F.when(i == 0, F.lit("promotion")).otherwise(F.lit("query")).alias("display_type"),
            (F.col("event_id") * 10 + i).cast("string").alias("item"),
            F.lit("sku_id").alias("item_type"),
            (i + 1).cast("long").alias("order"),
            ((k + i) % 5).cast("long").alias("pos_id"))))
    actions = F.when(
        ~is_start & (page_id == "good_detail") & (k % 2 == 1),
        F.array(F.struct(
            F.lit("favor_add").alias("action_id"),
            F.col("event_id").cast("string").alias("item"),
            F.lit("sku_id").alias("item_type"),
            (F.col("ts_ms") - 500).alias("ts"))))
    return [common.alias("common"), page.alias("page"), start.alias("start"),
            err.alias("err"), displays.alias("displays"), actions.alias("actions"),
            F.col("ts_ms").alias("ts")]


def click_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed click-log records (clean rows only) plus the topic ``offset``."""
    def build():
        ev = _events(spark, sf_dir).where(~_is_dirty())
        return ev.select(*_click_struct_cols(), F.col("event_id").alias("offset"))
    return build()


def raw_click_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click-log topic as text records ``(value, offset)``, dirty records included."""
    ev = _events(spark, sf_dir)
    rec = F.to_json(F.struct(*_click_struct_cols()))
    k = F.col("k")
    value = (F.when(k == 13, F.concat(F.lit('{"common":{"mid":"'), F.col("user_id").cast("string")))
             .when(k == 14, F.lit(""))
             .when((k == 15) & (F.col("event_type") == "view"),
                   F.concat(F.lit("["), F.col("event_id").cast("string"), F.lit("]")))
             .otherwise(rec))
    return ev.select(value.alias("value"), F.col("event_id").alias("offset"))


def attach_search_items(page_rows: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Give search-result pages their searched text: the whole text of document
    ``offset % number_of_documents`` (page.item), item_type 'keyword'."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    total = docs.agg(F.count(F.lit(1)).alias("_docs"))  # one row
    searched = page_rows.where(F.col("page.last_page_id") == "search").join(total, F.lit(True))
    joined = searched.join(docs, (F.col("offset") % F.col("_docs")) == F.col("doc_id"),
                           "left").drop("_docs")
    return joined.withColumn(
        "page", F.col("page").withField("item", F.col("text"))
                             .withField("item_type", F.when(F.col("text").isNotNull(),
                                                            F.lit("keyword")))
    ).drop("doc_id", "text")


# ============================================================================ change log
#
# Fixed recipe values (change log). Times: order ts = o_orderdate + o_orderkey % 86400 s;
# order line ts = l_shipdate + l_orderkey % 86400 s; line id = l_orderkey * 100 + line no.
#
# * order_info insert (status 1001) for every order: user = o_custkey, province =
#   o_custkey % 25, activity reduce = o_orderkey % 7, coupon reduce = o_orderkey % 5,
#   original total = total + both (absent when o_orderkey % 11 = 0); consignee by o_custkey,
#   payment way '110' || (1 + o_orderkey % 3), expires after 900 s, tracking number when
#   o_orderkey % 3 = 0, parent o_orderkey - 1 when % 10 = 0, freight % 13 ('n/a' when % 17 = 0)
#   less % 3
# * 'F' orders: update to 1003 one hour later; old = {order_status: '1001'}, or
#   {order_status: null} when o_orderkey % 5 = 0
# * 'P' orders: update to 1005 two hours later; old = {order_status: '1004'}, or
#   {order_status: null} when o_orderkey % 4 = 0, or {operate_time: null} when % 4 = 1
# * 'F' orders: payment_info update to 1602 thirty minutes later; payment type by
#   priority 1-URGENT 1101, 2-HIGH 1102, 3-MEDIUM 1103, else 1104; old =
#   {payment_status: '1601'}, or {payment_status: null} when o_orderkey % 5 = 0
# * order_detail insert per line: sku = l_partkey, price = l_extendedprice, sku_num =
#   l_quantity, source type '240' || (1 + line no % 5), activity amount = round(discount
#   * 100), coupon amount = round(tax * 100), total = price - both
# * order_detail_activity when l_discount >= 0.05; order_detail_coupon when l_tax >= 0.05
# * cart_info per line (user = l_suppkey): 'N' insert; 'A' update one minute later with
#   old sku_num = quantity - l_orderkey % 3; 'R' update with old = {is_checked: '0'};
#   is_checked = line no % 2, is_ordered = l_orderkey % 2 (order time 30 s later)
# * order_refund_info insert per 'R' line: user = l_suppkey, type 1501 + line no % 2,
#   reason 1301 + l_orderkey % 4
# * user_info insert per customer at 2024-01-01 + (c_custkey * 7919) % 30 days
# * events: purchase -> coupon_use, click -> favor_info, view -> comment_info; insert when
#   k is even, else update; coupon updates: k % 3 = 0 old {using_time: null}, 1 old
#   {used_time: null}, 2 old {coupon_status: '1401'}; favor updates: k % 3 = 0 is_cancel
#   1 -> 0, 1 is_cancel 0 -> 1, 2 old {create_time}; comment appraise '120' || (1 + k % 5)

DATABASE = "shop"

# The code dictionary (one code of each family is left out on purpose).
DICTIONARY_ROWS = [
    ("2401", "user search", "24"),
    ("2402", "promotion", "24"),
    ("2403", "recommendation", "24"),
    ("2404", "activity", "24"),
    ("1101", "alipay", "11"),
    ("1102", "wechat", "11"),
    ("1103", "union pay", "11"),
    ("1501", "refund money only", "15"),
    ("1502", "return goods and money", "15"),
    ("1301", "quality problem", "13"),
    ("1302", "not as described", "13"),
    ("1303", "no longer needed", "13"),
    ("1201", "good", "12"),
    ("1202", "medium", "12"),
    ("1203", "bad", "12"),
    ("1204", "automatic", "12"),
]


def _fixed(spark: SparkSession, rows: list[tuple], schema) -> DataFrame:
    """Rows of a fixed list as a local relation. Its size is known to the planner; a list given
    to ``createDataFrame`` has none, so a join with it would shuffle the other side."""
    cols = zip(*rows, strict=True)
    return spark.createDataFrame(
        pa.table({f.name: pa.array(c, pa.string()) for f, c in zip(schema, cols, strict=True)}),
        schema)


def dictionary(spark: SparkSession) -> DataFrame:
    """The ``base_dic`` lookup table (fixed codes)."""
    return _fixed(spark, DICTIONARY_ROWS, schemas.DICTIONARY)


def _txt(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _dec(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(16,2)")


def _fmt_s(sec: Column) -> Column:
    return F.date_format(F.timestamp_seconds(sec), "yyyy-MM-dd HH:mm:ss")


def _map(**kv: Column) -> Column:
    """A data map; columns without a value are present with a null value, as in the
    JSON change records (reading ``data[k]`` gives null either way)."""
    return F.create_map(*[x for k, v in kv.items() for x in (F.lit(k), _txt(v))])


def _old(**kv) -> Column:
    """An old-values map: keys always present, values may be null."""
    return F.create_map(*[x for k, v in kv.items()
                          for x in (F.lit(k), F.lit(None).cast("string") if v is None
                                    else _txt(v if isinstance(v, Column) else F.lit(v)))])


def _envelope(df: DataFrame, table_name: str, type_: Column | str, ts: Column, data: Column,
              old: Column | None = None) -> DataFrame:
    return df.select(
        F.lit(DATABASE).alias("database"), F.lit(table_name).alias("table"),
        (F.lit(type_) if isinstance(type_, str) else type_).alias("type"),
        ts.cast("long").alias("ts"), data.alias("data"),
        (old if old is not None else F.lit(None).cast(schemas.STR_MAP)).alias("old"))


def _order_parts(spark, sf_dir) -> list[DataFrame]:
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    ots = _epoch_s("o_orderdate") + key % 86400
    act, cou = _dec(key % 7), _dec(key % 5)
    total = _dec("o_totalprice")
    base = dict(id=key, user_id=F.col("o_custkey"), province_id=F.col("o_custkey") % 25,
                total_amount=total, activity_reduce_amount=act, coupon_reduce_amount=cou,
                original_total_amount=F.when(key % 11 != 0, total + act + cou),
                create_time=_fmt_s(ots),
                consignee=F.concat(F.lit("customer "), F.col("o_custkey").cast("string")),
                consignee_tel=F.concat(F.lit("1"), F.lpad(F.col("o_custkey").cast("string"),
                                                          10, "0")),
                payment_way=F.concat(F.lit("110"), (key % 3 + 1).cast("string")),
                out_trade_no=F.concat(F.lit("T"), key.cast("string")),
                trade_body=F.concat(F.col("o_orderpriority"), F.lit(" order")),
                expire_time=_fmt_s(ots + 900), process_status=F.col("o_orderstatus"),
                tracking_no=F.when(key % 3 == 0, F.concat(F.lit("N"), key.cast("string"))),
                parent_order_id=F.when(key % 10 == 0, key - 1),
                feight_fee=F.when(key % 17 == 0, "n/a").otherwise(_dec(key % 13).cast("string")),
                feight_fee_reduce=_dec(key % 3))
    ins = _envelope(o, "order_info", "insert", ots, _map(**base, order_status=F.lit("1001")))
    f = o.where(F.col("o_orderstatus") == "F")
    cancel = _envelope(
        f, "order_info", "update", ots + 3600,
        _map(**base, order_status=F.lit("1003"), operate_time=_fmt_s(ots + 3600)),
        F.when(key % 5 == 0, _old(order_status=None)).otherwise(_old(order_status="1001")))
    p = o.where(F.col("o_orderstatus") == "P")
    refund = _envelope(
        p, "order_info", "update", ots + 7200,
        _map(**base, order_status=F.lit("1005"), operate_time=_fmt_s(ots + 7200)),
        F.when(key % 4 == 0, _old(order_status=None))
        .when(key % 4 == 1, _old(operate_time=None))
        .otherwise(_old(order_status="1004")))
    prio = F.col("o_orderpriority")
    ptype = (F.when(prio == "1-URGENT", "1101").when(prio == "2-HIGH", "1102")
             .when(prio == "3-MEDIUM", "1103").otherwise("1104"))
    pay = _envelope(
        f, "payment_info", "update", ots + 1800,
        _map(id=key, user_id=F.col("o_custkey"), order_id=key, payment_type=ptype,
             payment_status=F.lit("1602"), total_amount=total,
             callback_time=_fmt_s(ots + 1800)),
        F.when(key % 5 == 0, _old(payment_status=None)).otherwise(_old(payment_status="1601")))
    return [ins, cancel, refund, pay]


def _line_parts(spark, sf_dir) -> list[DataFrame]:
    li = table(spark, sf_dir, "lineitem")
    okey = F.col("l_orderkey")
    lts = _epoch_s("l_shipdate") + okey % 86400
    detail_id = okey * 100 + F.col("l_linenumber")
    price = _dec("l_extendedprice")
    act = _dec(F.floor(F.col("l_discount") * 100 + 0.5))
    cou = _dec(F.floor(F.col("l_tax") * 100 + 0.5))
    qty = F.col("l_quantity").cast("int")
    source_type = F.concat(F.lit("240"), (F.col("l_linenumber") % 5 + 1).cast("string"))
    detail = _envelope(li, "order_detail", "insert", lts, _map(
        id=detail_id, order_id=okey, sku_id=F.col("l_partkey"),
        sku_name=F.concat(F.lit("sku "), F.col("l_partkey").cast("string")),
        order_price=price, sku_num=qty, create_time=_fmt_s(lts), source_type=source_type,
        source_id=F.col("l_suppkey"), split_total_amount=price - act - cou,
        split_activity_amount=act, split_coupon_amount=cou))
    a = li.where(F.col("l_discount") >= 0.05)
    activity = _envelope(a, "order_detail_activity", "insert", lts, _map(
        id=detail_id, order_id=okey, order_detail_id=detail_id,
        activity_id=F.floor(F.col("l_discount") * 100 + 0.5),
        activity_rule_id=F.concat(F.floor(F.col("l_discount") * 100 + 0.5).cast("string"),
                                  F.lit("-1")),
        sku_id=F.col("l_partkey"), create_time=_fmt_s(lts)))
    c = li.where(F.col("l_tax") >= 0.05)
    coupon = _envelope(c, "order_detail_coupon", "insert", lts, _map(
        id=detail_id, order_id=okey, order_detail_id=detail_id,
        coupon_id=F.floor(F.col("l_tax") * 100 + 0.5), coupon_use_id=detail_id,
        sku_id=F.col("l_partkey"), create_time=_fmt_s(lts)))
    flag = F.col("l_returnflag")
    cart_data = dict(id=detail_id, user_id=F.col("l_suppkey"), sku_id=F.col("l_partkey"),
                     cart_price=price, sku_num=qty, create_time=_fmt_s(lts),
                     source_type=source_type, source_id=F.col("l_suppkey"),
                     sku_name=F.concat(F.lit("sku "), F.col("l_partkey").cast("string")),
                     is_checked=F.col("l_linenumber") % 2, is_ordered=okey % 2,
                     order_time=F.when(okey % 2 == 1, _fmt_s(lts + 30)))
    cart_ins = _envelope(li.where(flag == "N"), "cart_info", "insert", lts, _map(**cart_data))
    cart_upd = _envelope(
        li.where(flag.isin("A", "R")), "cart_info", "update", lts + 60,
        _map(**cart_data, operate_time=_fmt_s(lts + 60)),
        F.when(flag == "A", _old(sku_num=(qty - okey % 3).cast("string")))
        .otherwise(_old(is_checked="0")))
    r = li.where(flag == "R")
    refund = _envelope(r, "order_refund_info", "insert", lts, _map(
        id=detail_id, user_id=F.col("l_suppkey"), order_id=okey, sku_id=F.col("l_partkey"),
        refund_type=F.concat(F.lit("150"), (F.col("l_linenumber") % 2 + 1).cast("string")),
        refund_num=qty, refund_amount=price,
        refund_reason_type=F.concat(F.lit("130"), (okey % 4 + 1).cast("string")),
        refund_reason_txt=F.lit("reason"), create_time=_fmt_s(lts)))
    return [detail, activity, coupon, cart_ins, cart_upd, refund]


def _user_parts(spark, sf_dir) -> list[DataFrame]:
    c = table(spark, sf_dir, "customer")
    ts = F.lit(1704067200) + (F.col("c_custkey") * 7919) % 2592000
    return [_envelope(c, "user_info", "insert", ts,
                      _map(id=F.col("c_custkey"), create_time=_fmt_s(ts)))]


def _event_parts(spark, sf_dir) -> list[DataFrame]:
    ev = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", _epoch_s("ts").alias("ts_s"), _k().alias("k"))
    k, ts = F.col("k"), F.col("ts_s")
    typ = F.when(k % 2 == 0, F.lit("insert")).otherwise(F.lit("update"))
    upd = k % 2 == 1
    cu = ev.where(F.col("event_type") == "purchase")
    coupon = _envelope(cu, "coupon_use", typ, ts, _map(
        id=F.col("event_id"), coupon_id=k % 10, user_id=F.col("user_id"),
        order_id=F.col("event_id") % 1000, get_time=_fmt_s(ts), coupon_status=F.lit("1401"),
        using_time=F.when(upd & (k % 3 == 0), _fmt_s(ts)),
        used_time=F.when(upd & (k % 3 == 1), _fmt_s(ts))),
        F.when(~upd, F.lit(None).cast(schemas.STR_MAP))
        .when(k % 3 == 0, _old(using_time=None)).when(k % 3 == 1, _old(used_time=None))
        .otherwise(_old(coupon_status="1401")))
    fv = ev.where(F.col("event_type") == "click")
    favor = _envelope(fv, "favor_info", typ, ts, _map(
        id=F.col("event_id"), user_id=F.col("user_id"), sku_id=F.col("event_id") % 2000,
        create_time=_fmt_s(ts),
        is_cancel=F.when(upd & (k % 3 == 1), F.lit("1")).otherwise(F.lit("0"))),
        F.when(~upd, F.lit(None).cast(schemas.STR_MAP))
        .when(k % 3 == 0, _old(is_cancel="1")).when(k % 3 == 1, _old(is_cancel="0"))
        .otherwise(_old(create_time=_fmt_s(ts - 60))))
    cm = ev.where(F.col("event_type") == "view")
    comment = _envelope(cm, "comment_info", typ, ts, _map(
        id=F.col("event_id"), user_id=F.col("user_id"), sku_id=F.col("event_id") % 2000,
        order_id=F.col("event_id") % 1000, create_time=_fmt_s(ts),
        appraise=F.concat(F.lit("120"), (k % 5 + 1).cast("string"))))
    return [coupon, favor, comment]


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The business-database change topic as one envelope DataFrame.

    Built as a union of per-table branches with a literal ``table``: a filter on the
    table name prunes every other branch, so each operator scans only its source.
    """
    def build():
        parts = (_order_parts(spark, sf_dir) + _line_parts(spark, sf_dir)
                 + _user_parts(spark, sf_dir) + _event_parts(spark, sf_dir))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
    return build()


# ============================================================================ dimensions
#
# Fixed recipe values (dimensions, from ``part`` and ``nation``): sku = p_partkey; spu =
# first word of p_name; trademark = p_brand (name 'tm ' || brand); category3 = p_type ||
# '-' || p_size % 5 (name lower(p_type) || ' ' || p_size % 5); category2 = p_type (name
# lower(p_type)); category1 = first letter of p_type (name 'group ' || letter);
# province = nation (id n_nationkey, name n_name).

def product_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    p = table(spark, sf_dir, "part")
    c3 = F.concat(F.col("p_type"), F.lit("-"), (F.col("p_size") % 5).cast("string"))
    sku = p.select(F.col("p_partkey").cast("string").alias("id"),
                   F.substring_index("p_name", " ", 1).alias("spu_id"),
                   F.col("p_brand").alias("tm_id"), c3.alias("category3_id"))
    spu = (p.select(F.substring_index("p_name", " ", 1).alias("id")).distinct()
           .withColumn("spu_name", F.col("id")))
    tm = (p.select(F.col("p_brand").alias("id")).distinct()
          .withColumn("tm_name", F.concat(F.lit("tm "), F.col("id"))))
    cat3 = p.select(c3.alias("id"),
                    F.concat(F.lower("p_type"), F.lit(" "),
                             (F.col("p_size") % 5).cast("string")).alias("name"),
                    F.col("p_type").alias("category2_id")).distinct()
    cat2 = p.select(F.col("p_type").alias("id"), F.lower("p_type").alias("name"),
                    F.substring("p_type", 1, 1).alias("category1_id")).distinct()
    cat1 = (p.select(F.substring("p_type", 1, 1).alias("id")).distinct()
            .withColumn("name", F.concat(F.lit("group "), F.col("id"))))
    return {"sku_info": sku, "spu_info": spu, "base_trademark": tm, "base_category3": cat3,
            "base_category2": cat2, "base_category1": cat1}


def province_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").cast("string").alias("id"),
                    F.col("n_name").alias("name"),
                    F.col("n_regionkey").cast("string").alias("region_id"))


# Dimension routing rules (source table, sink table, columns, key, extra).
RULE_ROWS = [
    ("user_info", "dim_user_info", "id,create_time", None, None),
    ("coupon_use", "dim_coupon_use", "id,coupon_id,user_id,coupon_status,using_time", "id",
     None),
    ("favor_info", "dim_favor_info", "id,user_id,sku_id,is_cancel", None, None),
]


def rules(spark: SparkSession) -> DataFrame:
    return _fixed(spark, RULE_ROWS, schemas.RULES)


# A topic of rule changes. user_info gets a column by an update, the rule of
# sku_info is deleted, and one record is no JSON.
RULE_CHANGES = [
    '{"op":"r","after":{"source_table":"user_info","sink_table":"dim_user_info",'
    '"sink_columns":"id,name"}}',
    '{"op":"r","after":{"source_table":"sku_info","sink_table":"dim_sku_info",'
    '"sink_columns":"id,brand","sink_pk":"id"}}',
    '{"op":"u","before":{"source_table":"user_info"},"after":{"source_table":"user_info",'
    '"sink_table":"dim_user_info","sink_columns":"id,name,level","sink_pk":"id"}}',
    "not a record",
    '{"op":"d","before":{"source_table":"sku_info"}}',
    '{"op":"c","after":{"source_table":"base_province","sink_table":"dim_base_province",'
    '"sink_columns":"id,name,region_id"}}',
]


def rule_topic(spark: SparkSession) -> DataFrame:
    """Rule changes as text records (value, offset)."""
    return spark.createDataFrame(list(enumerate(RULE_CHANGES)), "offset long, value string")


def dim_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of dimension tables as JSON text (value, offset). Fixed recipe values:

    * user_info: bootstrap-insert per customer at ts 694224000 (offset = c_custkey); every order
      is an update of its customer (level = o_orderpriority) at midnight of its day, so
      changes of one second occur (offset 10^9 + o_orderkey), a delete when o_orderkey % 13 = 0
    * base_province: insert per nation (offset 2 * 10^9 + n_nationkey); sku_info: insert per
      part (offset 3 * 10^9 + p_partkey)
    """
    c, o, n, p = (table(spark, sf_dir, t) for t in ("customer", "orders", "nation", "part"))
    start = F.lit(694224000)
    out = None
    for df, at, name, kind, ts, data in (
            (c, F.col("c_custkey"), "user_info", "bootstrap-insert", start, _map(
                id=F.col("c_custkey"), name=F.col("c_name"), level=F.col("c_mktsegment"),
                secret=F.lit("s"))),
            (o, F.lit(10**9) + F.col("o_orderkey"), "user_info",
             F.when(F.col("o_orderkey") % 13 == 0, "delete").otherwise("update"),
             _epoch_s("o_orderdate"), _map(
                 id=F.col("o_custkey"), name=F.concat(F.lit("customer "), _txt("o_custkey")),
                 level=F.col("o_orderpriority"), secret=F.lit("s"))),
            (n, F.lit(2 * 10**9) + F.col("n_nationkey"), "base_province", "insert", start, _map(
                id=F.col("n_nationkey"), name=F.col("n_name"),
                region_id=F.col("n_regionkey"))),
            (p, F.lit(3 * 10**9) + F.col("p_partkey"), "sku_info", "insert", start, _map(
                id=F.col("p_partkey"), brand=F.col("p_brand")))):
        rec = F.struct(
            F.lit(DATABASE).alias("database"), F.lit(name).alias("table"),
            (F.lit(kind) if isinstance(kind, str) else kind).alias("type"),
            ts.cast("long").alias("ts"), data.alias("data"))
        rows = df.select(F.to_json(rec).alias("value"), at.cast("long").alias("offset"))
        out = rows if out is None else out.unionByName(rows)
    return out
