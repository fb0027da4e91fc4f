"""Streams over several micro-batches: carried state, rows out of order, late rows. (Whole
tables are compared with SQL in test_oracle.py.)"""

import uuid

import pytest
from pyspark.sql import functions as F

from tidewater.plans.queries import REGISTRY
from tidewater.session import ensure_checkpoint_dir
from tidewater.streaming import jobs
from tidewater.streaming.processors import FLAT_COLS, FLAT_SCHEMA, day_of

SF = "/root/testdata/sf0.001"
DAY = 86_400_000


def batches(spark, files):
    """A topic with one file per micro-batch; rows (mid, ts, last_page_id[, is_new])."""
    folder = f"{ensure_checkpoint_dir(spark)}/topic-{uuid.uuid4().hex[:8]}"
    n = 0
    for i, rows in enumerate(files):
        full = []
        for mid, ts, page, *flag in rows:
            full.append((mid, ts, n, page, "v", "c", "a", flag[0] if flag else "0", 1))
            n += 1
        df = spark.createDataFrame(full, FLAT_SCHEMA.replace(", event_time timestamp", ""))
        (df.withColumn("event_time", F.timestamp_millis("ts")).select(*FLAT_COLS).coalesce(1)
         .write.mode("append").parquet(folder))
    return jobs.read_topic_stream(spark, folder, files_per_trigger=1)


def run(spark, stream, cols):
    return sorted(tuple(r) for r in jobs.run_to_table(spark, stream, "t").select(*cols).collect())


def test_daily_visitor_over_batches(spark):
    files = [[("a", 1000, None)], [("b", 2 * DAY, None)], [("a", 2 * DAY + 5000, None)],
             [("a", 2 * DAY + 9000, None)], [("a", 2 * DAY + 20_000, None)],
             [("z", 3 * DAY + 10_000, None)], [("a", 3 * DAY + 30_000, None)],
             [("z", 9 * DAY, None)]]
    out = run(spark, jobs.unique_visitor_stream(batches(spark, files)), ["mid", "ts"])
    assert out == [("a", 1000), ("a", 2 * DAY + 5000), ("a", 3 * DAY + 30_000),
                   ("b", 2 * DAY), ("z", 3 * DAY + 10_000)]


def test_first_of_a_day_arrives_second(spark):
    files = [[("a", 6000, None)], [("a", 5000, None)], [("z", DAY, None)]]
    out = run(spark, jobs.unique_visitor_stream(batches(spark, files)), ["mid", "ts"])
    assert out == [("a", 5000)]


def test_jumps_out_of_order_and_late(spark):
    files = [[("a", 6000, "home")], [("a", 5000, None)],  # the start arrives after its page
             [("b", 7000, None)], [("c", 40_000, None)], [("c", 45_000, None)],
             [("b", 8000, "home")],  # later than the watermark: dropped
             [("c", 47_000, "x")], [("z", 90_000, "x")]]
    out = run(spark, jobs.user_jump_stream(batches(spark, files)), ["mid", "ts"])
    assert out == [("b", 7000), ("c", 40_000)]


def test_jump_bound_is_reached_exactly(spark):
    files = [[("a", 5000, None)], [("a", 15_000, "x")], [("b", 16_000, None)],
             [("b", 25_999, "x")], [("z", 90_000, "x")]]
    out = run(spark, jobs.user_jump_stream(batches(spark, files)), ["mid", "ts"])
    assert out == [("a", 5000)]


def test_new_flag_over_batches(spark):
    files = [[("a", DAY + 2000, None, "1")], [("a", DAY + 1000, None, "0")],
             [("b", DAY + 3000, None, "1")], [("b", 2 * DAY, None, "1")],
             [("z", 3 * DAY, None, "0")]]
    out = run(spark, jobs.new_flag_stream(batches(spark, files)), ["mid", "ts", "is_new"])
    # a's first record claims no new visitor, so its later claim is on another day
    assert out == [("a", DAY + 1000, "0"), ("a", DAY + 2000, "0"), ("b", DAY + 3000, "1"),
                   ("b", 2 * DAY, "0")]


def test_days_follow_the_zone():
    assert day_of(0, "UTC") == 0 and day_of(-1, "UTC") == -1
    assert day_of(0, "America/New_York") == -1 and day_of(DAY - 1, "Asia/Tokyo") == 1


def test_fan_out_foreach_batch(spark):
    from tidewater.sources import driver_tables as dt

    base = f"{ensure_checkpoint_dir(spark)}/fanout-{uuid.uuid4().hex[:8]}"
    dt.raw_click_log(spark, SF).select("value").write.text(f"{base}/raw")
    jobs.run_fan_out(spark, f"{base}/raw", f"{base}/out")
    counts = {n: spark.read.parquet(f"{base}/out/{n}").count()
              for n in ("page", "start", "error", "display", "action", "dirty")}
    batch = REGISTRY["split_dirty"](spark, SF)
    assert counts["dirty"] == batch.where("kind = 'dirty'").count()
    assert counts["page"] == REGISTRY["fan_out_page"](spark, SF).count()
    assert counts["display"] == REGISTRY["explode_displays"](spark, SF).count()


def record(mid, ts, flag, page="home"):
    import json
    return json.dumps({"common": {"mid": mid, "is_new": flag}, "ts": ts,
                       "page": {"page_id": page}})


def land_text(spark, folder, files):
    for lines in files:
        (spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1)
         .write.mode("append").text(folder))


def flags(spark, root):
    """(device, time, flag) of the page output: rows with both, and the others."""
    rows = [(r.mid, r.ts, r.is_new) for r in spark.read.parquet(f"{root}/page").select(
        "common.mid", "ts", "common.is_new").collect()]
    whole = [r for r in rows if None not in r]
    return sorted(whole), sorted((r for r in rows if None in r), key=str)


FAN_FILES = [
    [record("a", DAY + 5, "1"), record("a", DAY + 9, "1"), "{broken"],
    [record("a", 2 * DAY, "1"), record("b", 5 * DAY, "0"), record(None, 7, "1")],
    [record("b", 5 * DAY + 1, "1"), record("b", 4 * DAY, "1"),  # four days "late": still kept
     record("c", None, "1"), record("a", DAY + 7, "1"), ""]]
FAN_FLAGS = [("a", DAY + 5, "1"), ("a", DAY + 7, "1"), ("a", DAY + 9, "1"), ("a", 2 * DAY, "0"),
             ("b", 4 * DAY, "1"), ("b", 5 * DAY, "0"), ("b", 5 * DAY + 1, "0")]


def test_fan_out_repairs_flags_over_batches(spark):
    base = f"{ensure_checkpoint_dir(spark)}/fanout-{uuid.uuid4().hex[:8]}"
    land_text(spark, f"{base}/raw", FAN_FILES)
    jobs.run_fan_out(spark, f"{base}/raw", f"{base}/out", files_per_trigger=1)
    # without a device or a time there is nothing to repair by
    assert flags(spark, f"{base}/out") == (FAN_FLAGS, [("c", None, "1"), (None, 7, "1")])
    dirty = spark.read.parquet(f"{base}/out/dirty")
    assert sorted(r.value for r in dirty.collect()) == ["", "{broken"]
    assert spark.read.parquet(f"{base}/out/page").select("batch_id").distinct().count() == 3


def test_fan_out_goes_on_after_a_failure_within_a_batch(spark):
    base = f"{ensure_checkpoint_dir(spark)}/fanout-{uuid.uuid4().hex[:8]}"
    land_text(spark, f"{base}/raw", FAN_FILES)
    write = jobs.fan_out_writer(f"{base}/out")
    failed = []

    def dies_once(batch, batch_id):
        write(batch, batch_id)  # all outputs are there, but the batch is not committed
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost")

    def go():
        raw = spark.readStream.option("maxFilesPerTrigger", 1).text(f"{base}/raw")
        jobs.fan_out(raw, f"{base}/out", dies_once)

    with pytest.raises(Exception, match="lost"):
        go()
    go()
    assert failed and flags(spark, f"{base}/out")[0] == FAN_FLAGS
