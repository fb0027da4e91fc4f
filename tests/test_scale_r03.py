"""Steps that must not grow faster than their input (findings F10, F22-F25, F27, F29, F30)."""

import glob
import json
import re

import pytest
from pyspark.sql import functions as F

from tidewater import schemas
from tidewater.operators import cdc, logs, trade
from tidewater.plans import queries
from tidewater.streaming import jobs
from tidewater.streaming import trade as st
from tidewater.streaming.processors import FLAT_SCHEMA

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_json_text_is_parsed_once(spark):
    # every filter and field used to repeat the parse.
    raw = spark.createDataFrame([("{}", 1)], "text string, offset long").select(
        F.concat(F.col("text"), F.lit("")).alias("value"), "offset")
    clean, _ = logs.split_dirty(raw)
    assert len(re.findall("from_json|jsontostructs", plan(
        clean.where(F.col("common.mid") == "a").select("page.page_id", "ts")).lower())) == 1
    rows = cdc.read_change_log(raw).where(F.col("type") == "insert").select("ts", "data")
    assert len(re.findall("from_json|jsontostructs", plan(rows).lower())) == 1


def test_parsed_rows_keep_columns_and_kinds(spark):
    good = json.dumps({"common": {"mid": "a"}, "ts": 5})
    raw = spark.createDataFrame([(good, 1), ("", 2), (None, 3), ("[1]", 4), ('{"ts":', 5)],
                                "value string, offset long")
    p = logs.parse_json(raw, schemas.CLICK_LOG)
    assert p.columns == ["value", "offset", "_rec", "is_dirty"]
    got = {r.offset: (r.value, r.is_dirty) for r in p.collect()}
    assert got == {1: (good, False), 2: ("", True), 3: (None, True), 4: ("[1]", True),
                   5: ('{"ts":', True)}


@pytest.mark.parametrize("job", [jobs.unique_visitor_stream, jobs.user_jump_stream,
                                 jobs.new_flag_stream])
def test_devices_share_state_in_groups(spark, tmp_path, job):
    # calls were paid a device.
    s = (spark.readStream.schema(FLAT_SCHEMA).parquet(str(tmp_path))
         .withWatermark("event_time", "2 seconds"))
    assert "_group" in job(s)._jdf.queryExecution().analyzed().toString()


def test_rows_without_device_are_one_device(spark, tmp_path):
    rows = [(m, t, o, None, "v", "c", "a", "1", 1) for m, t, o in
            ((None, 1_000, 1), ("a", 1_500, 2), (None, 2_000, 3), ("z", 90_000_000, 4))]
    df = spark.createDataFrame(rows, ", ".join(FLAT_SCHEMA.split(", ")[:-1])).withColumn(
        "event_time", F.timestamp_millis("ts"))
    folder = jobs.land_topic(df, str(tmp_path / "t"))
    out = jobs.run_to_table(spark, jobs.unique_visitor_stream(
        jobs.read_topic_stream(spark, folder)), "uv_null")
    assert sorted(r.offset for r in out.collect()) == [1, 2]


def test_arrivals_hold_every_change_once_in_order(spark):
    log = spark.range(1000).select(F.when(F.col("id") % 100 != 0, F.col("id") % 37).alias("ts"),
                                   "id")
    parts = [p.collect() for p in st.arrivals(log, 300)]
    assert len(parts) == 4
    assert sorted(r.id for p in parts for r in p) == list(range(1000))
    last = -1
    for p in parts:
        times = [r.ts for r in p if r.ts is not None]
        assert min(times) > last
        last = max(times)


def test_order_stream_in_several_arrivals(spark, monkeypatch):
    # the whole log was held at once.
    whole = sorted(map(str, queries.q_stream_order_wide(spark, SF).collect()))
    cuts = []
    monkeypatch.setattr(st, "ARRIVAL_ROWS", 4_000)
    append = st.append_changes
    monkeypatch.setattr(st, "append_changes", lambda df, root: (cuts.append(1), append(df, root)))
    assert sorted(map(str, queries.q_stream_order_wide(spark, SF).collect())) == whole
    assert whole and len(cuts) > 1


def test_settled_lines_move_once_by_order_and_once_by_line(spark):
    # A third exchange of the lines came before the settling.
    kept = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                                 "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = queries.settled_lines(spark, SF, cols=queries.PROVINCE_COLS)._jdf.queryExecution(
        ).executedPlan().toString()
    finally:
        for k, v in kept.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    moves = [x for x in text.splitlines() if "Exchange hashpartitioning" in x]
    assert len([x for x in moves if "order_detail_id" in x]) <= 4  # lines, extras, first times


def test_order_wide_orders_first_is_the_same(spark):
    log = queries.clog(spark, SF)
    a = trade.order_wide(log, queries.dt.dictionary(spark))
    b = trade.order_wide(log, queries.dt.dictionary(spark), orders_first=True)
    assert a.columns == b.columns
    assert sorted(map(str, a.select(queries.WIDE_COLS).collect())) == sorted(
        map(str, b.select(queries.WIDE_COLS).collect()))


def test_dimension_batches_are_read_by_many_tasks(spark):
    # each micro-batch was one file.
    queries.q_stream_maintain_dims(spark, SF)
    newest = max(glob.glob(f"{queries._scratch(spark)}/dims-*/changes".replace("file:", "")),
                 key=lambda p: __import__("os").path.getmtime(p))
    assert len(glob.glob(f"{newest}/*.parquet")) > 12
