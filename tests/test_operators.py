"""Hand-made rows per operator with expected outputs written from the reference's
state machines (ties, nulls, day changes, exact time bounds)."""

from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater import schemas
from tidewater.functions.sequence import time_bucket, with_next, with_prev
from tidewater.operators import cdc, dedupe, joins, logs, visitors

DAY = 86_400_000
T0 = 1_704_067_200_000  # 2024-01-01 00:00:00 UTC


def page_rows(spark, rows):
    """rows: (offset, mid, ts_ms, last_page_id, page_id, is_new, uid)"""
    data = [Row(common=Row(mid=m, uid=u, is_new=n, vc="v", ch="c", ar="1"),
                page=Row(page_id=p, last_page_id=lp, item=None, item_type=None, during_time=1),
                err=None, ts=ts, offset=o)
            for o, m, ts, lp, p, n, u in rows]
    schema = T.StructType([
        T.StructField("common", schemas.COMMON), T.StructField("page", schemas.PAGE),
        T.StructField("err", schemas.ERR), T.StructField("ts", T.LongType()),
        T.StructField("offset", T.LongType())])
    return spark.createDataFrame(data, schema)


def offsets(df):
    return sorted(r["offset"] for r in df.select("offset").collect())


def test_user_jump_edges(spark):
    rows = [
        (1, "a", T0, None, "home", "1", "u"),            # next start 9.999 s later: match
        (2, "a", T0 + 9_999, None, "home", "1", "u"),    # next row exactly 10 s later: timeout
        (3, "a", T0 + 19_999, None, "home", "1", "u"),   # followed by a page within 10 s: no
        (4, "a", T0 + 24_999, "home", "good_detail", "1", "u"),
        (5, "b", T0, None, "home", "1", "u"),            # last row of its device: timeout
    ]
    df = page_rows(spark, rows)
    assert offsets(visitors.user_jump(df)) == [1, 2, 5]
    # tiny buckets force every neighbour to be found across bucket edges
    assert offsets(visitors.user_jump(df, bucket_ms=7)) == [1, 2, 5]


def test_daily_unique_visitor_and_page_uv(spark):
    rows = [
        (1, "a", T0 + 5, None, "home", "1", "u"),
        (2, "a", T0 + 9, None, "home", "1", "u"),
        (3, "a", T0 + DAY, None, "good_detail", "1", "u"),
        (4, "a", T0 + DAY + 1, "home", "home", "1", "u"),
        (5, "a", T0 + DAY + 2, "home", "good_detail", "1", "u"),
    ]
    df = page_rows(spark, rows)
    assert offsets(visitors.daily_unique_visitor(df)) == [1, 3]
    got = {r["offset"]: (r["home_uv_ct"], r["good_detail_uv_ct"])
           for r in visitors.page_daily_unique(df).collect()}
    assert got == {1: (1, 0), 3: (0, 1), 4: (1, 0)}


def test_login_back_flow_eight_days(spark):
    rows = [
        (1, "a", T0, None, "home", "1", "u"),
        (2, "a", T0 + 3600_000, None, "home", "1", "u"),       # same day: nothing
        (3, "a", T0 + 7 * DAY, None, "home", "1", "u"),        # 7 days: unique, not back
        (4, "a", T0 + 15 * DAY, None, "home", "1", "u"),       # 8 days: back
        (5, "a", T0 + 15 * DAY + 1, None, "home", "1", None),  # no user: ignored
    ]
    got = {r["offset"]: (r["uu_ct"], r["back_ct"])
           for r in visitors.login_unique_and_back(page_rows(spark, rows)).collect()}
    assert got == {1: (1, 0), 3: (1, 0), 4: (1, 1)}


def test_fix_new_flag(spark):
    rows = [
        (1, "a", T0 + DAY, None, "home", "0", "u"),      # first row old: anchor = day before
        (2, "a", T0 + DAY + 5, None, "home", "1", "u"),  # claims new on another day -> 0
        (3, "b", T0, None, "home", "1", "u"),            # first row new: anchor = own day
        (4, "b", T0 + 5, None, "home", "1", "u"),        # same day stays 1
        (5, "b", T0 + DAY, None, "home", "1", "u"),      # next day -> 0
    ]
    df = page_rows(spark, rows)
    got = {r["offset"]: r["is_new"]
           for r in logs.fix_new_flag(df).select("offset", "common.is_new").collect()}
    assert got == {1: "0", 2: "0", 3: "1", 4: "1", 5: "0"}


def test_split_dirty(spark):
    raw = spark.createDataFrame(
        [('{"common":{"mid":"m"},"ts":5}', 1), ("", 2), ("[1]", 3), ('{"common":', 4),
         ("   ", 5)], "value string, offset long")
    clean, dirty = logs.split_dirty(raw)
    assert [(r["offset"], r["mid"]) for r in clean.select("offset", "common.mid").collect()] \
        == [(1, "m")]
    assert sorted(r["offset"] for r in dirty.collect()) == [2, 3, 4, 5]


def test_neighbours_across_buckets(spark):
    df = spark.createDataFrame([("k", 1), ("k", 5), ("k", 100), ("j", 3)], "key string, ts long")
    nxt = with_next(df, ["key"], ["ts"], ["ts"], time_bucket("ts", 2))
    got = {(r["key"], r["ts"]): r["next_ts"] for r in nxt.collect()}
    assert got == {("k", 1): 5, ("k", 5): 100, ("k", 100): None, ("j", 3): None}
    prv = with_prev(df, ["key"], ["ts"], ["ts"], time_bucket("ts", 2))
    got = {(r["key"], r["ts"]): r["prev_ts"] for r in prv.collect()}
    assert got == {("k", 1): None, ("k", 5): 1, ("k", 100): 5, ("j", 3): None}


def test_settle_and_gap(spark):
    df = spark.createDataFrame(
        [("d", 1000, "a"), ("d", 3000, "b"), ("d", 3001, "c"), ("e", 10, "x")],
        "id string, ts long, v string")
    got = {r["id"]: r["v"] for r in dedupe.settle_latest(df, "id", "ts", 2000).collect()}
    assert got == {"d": "b", "e": "x"}
    g = spark.createDataFrame([("d", 0), ("d", 4999), ("d", 9999), ("d", 30000)],
                              "id string, ts long")
    kept = sorted(r["ts"] for r in dedupe.first_per_key_gap(g, "id", "ts", 5000).collect())
    assert kept == [0, 9999, 30000]  # gap measured from the previous row; exactly 5 s emits


def test_latest_by_key_delete(spark):
    df = spark.createDataFrame([("1", 1, "a"), ("1", 2, None), ("2", 1, "b")],
                               "id string, ts long, v string")
    got = sorted(r["id"] for r in dedupe.latest_by_key(df, ["id"], ["ts"], "v").collect())
    assert got == ["2"]


def change(spark, rows):
    return spark.createDataFrame(rows, schemas.CHANGE_LOG)


def test_cart_add_and_coupon_key_presence(spark):
    log = change(spark, [
        ("shop", "cart_info", "insert", 1, {"id": "1", "sku_num": "2"}, None),
        ("shop", "cart_info", "update", 2, {"id": "2", "sku_num": "5"}, {"sku_num": "3"}),
        ("shop", "cart_info", "update", 3, {"id": "3", "sku_num": "5"}, {"sku_num": "7"}),
        ("shop", "cart_info", "update", 4, {"id": "4", "sku_num": "5"}, {"is_checked": "1"}),
        ("shop", "coupon_use", "update", 5, {"id": "5", "using_time": "2024-01-01 00:00:00"},
         {"using_time": None}),
        ("shop", "coupon_use", "update", 6, {"id": "6"}, {"coupon_status": "1"}),
    ])
    got = {r["id"]: r["sku_num"] for r in cdc.cart_add(log).collect()}
    assert got == {"1": 2, "2": 2}
    assert [r["id"] for r in cdc.coupon_order(log).collect()] == ["5"]


def test_favor_add_limited_to_table(spark):
    log = change(spark, [
        ("shop", "favor_info", "insert", 1, {"id": "1"}, None),
        ("shop", "favor_info", "update", 2, {"id": "2", "is_cancel": "0"}, {"is_cancel": "1"}),
        ("shop", "other", "update", 3, {"id": "3", "is_cancel": "0"}, {"is_cancel": "1"}),
    ])
    assert sorted(r["id"] for r in cdc.favor_add(log).collect()) == ["1", "2"]


def test_interval_join_inclusive(spark):
    left = spark.createDataFrame([(1, 1, 10_000)], "k long, lid long, lts long")
    right = spark.createDataFrame([(1, 1, 5_000), (1, 2, 15_000), (1, 3, 15_001), (2, 4, 10_000)],
                                  "k long, rid long, rts long")
    got = sorted(r["rid"] for r in
                 joins.interval_join(left, right, "k", "lts", "rts", -5000, 5000).collect())
    assert got == [1, 2]


def test_order_wide_inner_and_left(spark):
    from tidewater.operators import trade
    from tidewater.sources.driver_tables import dictionary
    log = change(spark, [
        ("shop", "order_detail", "insert", 1,
         {"id": "10", "order_id": "1", "source_type": "2401", "order_price": "44.88",
          "sku_num": "2"}, None),
        ("shop", "order_detail", "insert", 1,
         {"id": "11", "order_id": "1", "source_type": "2405"}, None),  # no dictionary entry
        ("shop", "order_detail", "insert", 1, {"id": "12", "order_id": "9",
                                                "source_type": "2401"}, None),  # no order
        ("shop", "order_info", "insert", 1, {"id": "1", "user_id": "7"}, None),
        ("shop", "order_detail_activity", "insert", 1,
         {"order_detail_id": "10", "activity_id": "3"}, None),
    ])
    rows = trade.order_wide(log, dictionary(spark)).collect()
    assert [(r["order_detail_id"], r["activity_id"], r["coupon_id"], r["source_type_name"],
             r["split_original_amount"]) for r in rows] == \
        [("10", "3", None, "user search", "89.7600")]


def test_rule_changes_with_deletes(spark):
    from tidewater.operators import dims

    def rec(table, op, cols="id"):
        rule = (f'{{"source_table":"{table}","sink_table":"dim_{table}","sink_columns":"{cols}",'
                '"sink_pk":"id","sink_extend":null}')
        before, after = ("null", rule) if op == "c" else (rule, rule if op == "u" else "null")
        return f'{{"before":{before},"after":{after},"op":"{op}"}}'

    rows = [(0, rec("a", "c")), (1, rec("b", "c")), (2, rec("a", "u", "id,name")),
            (3, rec("b", "d")), (4, "not json"), (5, None), (6, rec("c", "d")), (7, rec("c", "c"))]
    df = spark.createDataFrame(rows, "offset long, value string")
    got = {r.source_table: r.sink_columns for r in dims.read_rules(df).collect()}
    assert got == {"a": "id,name", "c": "id"}


def test_change_log_text(spark):
    from tidewater.operators.cdc import old_has_key, read_change_log
    rows = [('{"database":"d","table":"t","type":"update","ts":5,"data":{"id":"1"},'
             '"old":{"k":null}}',), ('{"table":"t","type":"insert","ts":6,"data":{"id":"2"}}',),
            ("{broken",), ("",), (None,)]
    df = spark.createDataFrame(rows, "value string")
    got = read_change_log(df).select("ts", "data", old_has_key("k").alias("has")).collect()
    assert sorted((r.ts, r.data["id"], bool(r.has)) for r in got) == [(5, "1", True),
                                                                    (6, "2", False)]


def test_fractional_times(spark):
    from tidewater.functions.time import not_earlier
    rows = [("2022-04-01 11:10:55.04Z", "2022-04-01 11:10:55.040Z", True),
            ("2022-04-01 11:10:55.4Z", "2022-04-01 11:10:55.04Z", True),
            ("2022-04-01 11:10:55.04Z", "2022-04-01 11:10:55.1Z", False),
            ("bad", "2022-04-01 11:10:55.1Z", None)]
    df = spark.createDataFrame(rows, "a string, b string, want boolean")
    assert all(r.got == r.want for r in df.select(
        not_earlier("a", "b").alias("got"), "want").collect())


def test_reports_on_a_stored_metric_table(spark):
    import uuid

    from tidewater.operators import reports
    from tidewater.session import ensure_checkpoint_dir
    from tidewater.sources import topics
    path = f"{ensure_checkpoint_dir(spark)}/m-{uuid.uuid4().hex[:8]}"
    rows = [("2024-01-15 00:00:00", "2024-01-15 00:00:10", 2.5),
            ("2024-01-15 00:00:10", "2024-01-15 00:00:20", 4.0),
            ("2024-01-16 00:00:00", "2024-01-16 00:00:10", 9.0)]
    df = spark.createDataFrame(rows, "stt string, edt string, order_amount double")
    for _ in range(2):  # a replayed batch replaces itself
        topics.write_metrics(df, path, df.columns, batch_id=3)
    stored = topics.read_metrics(spark, path)
    assert stored.count() == 3 and "processed_at" in stored.columns
    report = reports.gmv_report(stored, 20240115)
    assert report.first().gmv == 6.5
    assert reports.gmv_json(report).first().json == '{"status":0,"msg":"","data":6.5}'
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    assert reports.gmv_report(stored).first().gmv is None  # today has no rows


def test_bad_money_does_not_stop_a_metric(spark):
    from tidewater.operators.metrics import money_sum
    df = spark.createDataFrame([("1.25",), ("n/a",), (None,)], "x string")
    assert df.agg(money_sum("x").alias("s")).first().s == 1.25


def test_bad_records_and_tombstones_are_skipped(spark):
    raw = spark.createDataFrame([('{"ts":1}',), ("{x",), ("",), (None,), ("[1]",)], "value string")
    assert [r.ts for r in logs.parse_or_skip(raw, schemas.CLICK_LOG).collect()] == [1]
    assert sorted(r.value for r in logs.drop_tombstones(raw).collect()) == sorted(["[1]", "{x", '{"ts":1}'])


def test_enrich_keeps_rows_without_a_match(spark):
    from tidewater.operators import dims
    df = spark.createDataFrame([("1",), ("2",), (None,)], "k string")
    dim = spark.createDataFrame([("1", "a", 5), (None, "n", 6)], "id string, name string, n int")
    out = dims.enrich(df, dim, "k", "id", {"name": "k_name"})
    assert out.columns == ["k", "k_name"]
    assert sorted(out.collect(), key=str) == [("1", "a"), ("2", None), (None, None)]


def test_text_to_ms(spark):
    from tidewater.functions.time import text_to_ms
    df = spark.createDataFrame([("2024-01-01 00:00:01",), ("2024-01-01",), ("x",), (None,)],
                               "t string")
    assert [r[0] for r in df.select(text_to_ms("t")).collect()] == [T0 + 1000, T0, None, None]
