"""Streams of the trade side and of dimensions over several micro-batches: released state,
timers, late rows, silent sources, replays, crashes. (Whole tables: test_oracle.py.)"""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from tidewater import schemas
from tidewater.operators import dims, joins
from tidewater.session import ensure_checkpoint_dir
from tidewater.sources import driver_tables as dt
from tidewater.sources import upsert
from tidewater.streaming import changelog
from tidewater.streaming import dims as sd
from tidewater.streaming import jobs
from tidewater.streaming import trade as st

DAY = 86_400


def new_folder(spark):
    return f"{ensure_checkpoint_dir(spark)}/tst-{uuid.uuid4().hex[:8]}"


def topic(spark, files, schema):
    """A stream with one file per micro-batch."""
    folder = new_folder(spark)
    for rows in files:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def run(spark, df):
    """Rows and the last progress of a stream."""
    jobs.prepare(spark)
    base = new_folder(spark)
    q = (df.writeStream.format("parquet").option("checkpointLocation", f"{base}/_c")
         .trigger(availableNow=True).start(f"{base}/out"))
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{base}/out").collect(), q.lastProgress


def change(table, ts, type_="insert", old=None, **data):
    return "shop", table, type_, ts, {k: str(v) for k, v in data.items()}, old


def line(i, ts):
    return change("order_detail", ts, id=i, order_id=f"o{i}", sku_id="s", order_price="2.50",
                  sku_num=2, source_type="2401", create_time="t")


def orders(spark, lines, infos, activities, coupons):
    made = {"order_detail": lines, "order_info": infos, "order_detail_activity": activities,
            "order_detail_coupon": coupons}
    return st.order_wide_stream(
        {t: topic(spark, files, schemas.CHANGE_LOG) for t, files in made.items()},
        dt.dictionary(spark))


def test_order_wide_over_batches_releases_state(spark):
    n = 8  # one order every ten days, a batch each
    at = [1000 + 10 * DAY * k for k in range(n)]
    wide = orders(
        spark,
        [[line(k, t)] for k, t in enumerate(at)],
        [[change("order_info", t + 2 * DAY, id=f"o{k}", user_id=f"u{k}")]
         for k, t in enumerate(at)],
        [[change("order_detail_activity", t + 5, order_detail_id=k if k % 2 else f"x{k}",
                 activity_id="a")] for k, t in enumerate(at)],
        [[change("order_detail_coupon", t + DAY, order_detail_id=k if k < 2 else f"x{k}",
                 coupon_id="c")] for k, t in enumerate(at)])
    rows, last = run(spark, wide)
    got = {r.order_detail_id: (r.user_id, r.activity_id, r.coupon_id, r.source_type_name,
                               r.split_original_amount) for r in rows}
    # The last lines wait: nothing has passed them by three days yet.
    assert got == {str(k): (f"u{k}", "a" if k % 2 else None, "c" if k < 2 else None,
                            "user search", "5.0000") for k in range(n - 1)}
    held = sum(o["numRowsTotal"] for o in last["stateOperators"])
    assert held <= 6, held  # the newest rows only, not those of eight orders


def test_order_changes_beyond_the_retention_do_not_join(spark):
    wide = orders(
        spark, [[line(1, 1000)], [line(9, 30 * DAY)]],
        [[change("order_info", 1000 + 3 * DAY, id="o1", user_id="in")],
         [change("order_info", 1001 + 3 * DAY, "update", {"order_status": "1001"}, id="o1",
                 user_id="out"), change("order_info", 30 * DAY, id="o9")]],
        [[change("order_detail_activity", 1000, order_detail_id="1", activity_id="a")],
         [change("order_detail_activity", 30 * DAY, order_detail_id="z")]],
        [[change("order_detail_coupon", 1000, order_detail_id="1", coupon_id="c")],
         [change("order_detail_coupon", 30 * DAY, order_detail_id="z")]])
    rows, _ = run(spark, wide)
    assert [(r.order_detail_id, r.user_id) for r in rows] == [("1", "in")]


SETTLE = "id string, ts long, v string, event_time timestamp"


def settle(spark, files, **more):
    rows = [[(k, ts, v) for k, ts, v in f] for f in files]
    s = topic(spark, rows, "id string, ts long, v string")
    s = s.withColumn("event_time", F.timestamp_millis("ts")).withWatermark("event_time", "2 seconds")
    rows, last = run(spark, st.settle_stream(s, "id", 2000, ["ts", "v"], SETTLE, **more))
    return sorted((r.id, r.ts, r.v) for r in rows), last


def test_settle_replaces_until_the_timer_and_never_emits_again(spark):
    files = [[("a", 1000, "x")], [("a", 3000, "z"), ("a", 2500, "y")],  # out of order
             [("b", 1500, "b"), ("a", 3001, "too late for the timer")],
             [("c", 20_000, "c")], [("a", 21_000, "done already")], [("z", 60_000, "z")],
             [("z", 60_500, "z2")], [("b", 61_000, "late row of b")], [("y", 90_000, "y")]]
    got, _ = settle(spark, files)
    assert got == [("a", 3000, "z"), ("b", 1500, "b"), ("c", 20_000, "c"), ("z", 60_500, "z2")]


def test_settle_forgets_after_its_retention(spark):
    files = [[("a", 1000, "x")], [("z", 30_000, "z")], [("a", 31_000, "again")],
             [("z", 60_000, "z")], [("y", 90_000, "y")]]
    kept, _ = settle(spark, files)
    again, last = settle(spark, files, retention_ms=10_000)
    assert [r for r in kept if r[0] == "a"] == [("a", 1000, "x")]
    assert [r for r in again if r[0] == "a"] == [("a", 1000, "x"), ("a", 31_000, "again")]


def test_distinct_orders_over_batches_and_late_rows(spark):
    rows = [[("o1", "1", "2.00", 1), ("o1", "1", "3.00", 2)], [("o2", "1", "1.00", 9)],
            [("o1", "1", "1.50", 8), ("o1", "2", "bad", 3)], [("o3", "1", "1.00", 30)],
            [("o3", "1", "1.00", 31)], [("o9", "1", "100.00", 4)],  # its window has been given out
            [("o4", "1", "1.00", 60)]]
    s = topic(spark, rows, "order_id string, province_id string, split_total_amount string, s long")
    s = s.withColumn("event_time", F.timestamp_seconds("s")).withWatermark("event_time", "2 seconds")
    names = spark.createDataFrame([("1", "one")], "id string, name string")
    got, last = run(spark, st.province_order_stream(s.drop("s"), names))
    assert sorted((r.stt[-8:], r.province_id, r.province_name, r.order_count, r.order_amount)
                  for r in got) == [("00:00:00", "1", "one", 2, 7.5),
                                    ("00:00:00", "2", None, 1, 0.0),
                                    ("00:00:30", "1", "one", 1, 2.0)]
    assert sum(o["numRowsTotal"] for o in last["stateOperators"]) <= 2


LEFT = [(1, "a", 100), (2, "a", 200), (3, "b", 100), (4, None, 100), (2, "a", 200)]
RIGHT = [(1, "a", 95), (2, "a", 105), (3, "a", 206), (4, "c", 100), (5, None, 100)]


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
@pytest.mark.parametrize("lo,hi", [(-5, 5), (0, 10), (-3, 40), (-200, 200)])
def test_interval_join_in_batch(spark, how, lo, hi):
    a = spark.createDataFrame(LEFT, "l int, k string, lt long")
    b = spark.createDataFrame(RIGHT, "r int, k string, rt long")
    got = sorted(map(tuple, joins.interval_join(a, b, "k", "lt", "rt", lo, hi, how)
                     .select("k", "l", "r").collect()), key=str)
    match = [(x, y) for x in LEFT for y in RIGHT
             if x[1] is not None and x[1] == y[1] and x[2] + lo <= y[2] <= x[2] + hi]
    want = [(x[1], x[0], y[0]) for x, y in match]
    if how in ("left", "full"):
        want += [(x[1], x[0], None) for x in LEFT if x not in [m[0] for m in match]]
    if how in ("right", "full"):
        want += [(y[1], None, y[0]) for y in RIGHT if y not in [m[1] for m in match]]
    assert got == sorted(want, key=str)


@pytest.mark.parametrize("how", ["inner", "left", "full"])
@pytest.mark.parametrize("which,silent", [("min", False), ("min", True), ("max", True)])
def test_interval_join_streams_and_a_silent_source(spark, how, which, silent):
    """Unmatched rows come once; under ``min`` a silent source holds them back, under ``max``
    it does not."""
    left = [[(1, "a", 100), (2, "b", 100)], [(3, "a", 150)], [(9, "z", 5000)], [(9, "z", 5001)]]
    right = [[(1, "a", 95), (2, "a", 105), (3, "c", 100)], [(4, "a", 144)]]
    if not silent:
        right += [[(8, "y", 5000)], [(8, "y", 5001)]]
    a = topic(spark, left, "l int, k string, s long").withColumn(
        "lt", F.timestamp_seconds("s")).withWatermark("lt", "0 seconds").drop("s")
    b = topic(spark, right, "r int, k string, s long").withColumn(
        "rt", F.timestamp_seconds("s")).withWatermark("rt", "0 seconds").drop("s")
    st.policy(spark, which)
    try:
        rows, _ = run(spark, st.interval_join_stream(a, b, "k", "lt", "rt", "-5 seconds",
                                                     "5 seconds", how))
    finally:
        st.policy(spark, "min")
    got = sorted(((r.k, r.l, r.r) for r in rows if r.k not in "zy"), key=str)
    want = [("a", 1, 1), ("a", 1, 2)]
    if how != "inner" and not (silent and which == "min"):
        want += [("a", 3, None), ("b", 2, None)]
    if how == "full" and not (silent and which == "min"):
        want += [("a", None, 4), ("c", None, 3)]
    elif how != "inner" and silent and which == "min":
        want += [("b", 2, None)] + ([("c", None, 3)] if how == "full" else [])
    assert got == sorted(want, key=str)


# ------------------------------------------------------------------ upsert table, dimensions

ROW = "id string, v string, ts long"


def put(spark, root, batch, rows):
    upsert.write_delta(spark.createDataFrame(rows, ROW), root, batch)


def current(spark, root, **more):
    return sorted((r.id, r.v) for r in upsert.read_current(
        spark, root, ROW, ["id"], ["ts"], "v", **more).collect())


def test_compacted_log_reads_one_snapshot_and_the_deltas_behind_it(spark):
    root = new_folder(spark)
    assert current(spark, root) == [] and upsert.compact(spark, root, ROW, ["id"], ["ts"]) == -1
    for b in range(7):
        put(spark, root, b, [(str(b % 3), f"v{b}", b), ("gone", None if b == 4 else "x", b)])
        if b in (2, 5):
            assert upsert.compact(spark, root, ROW, ["id"], ["ts"]) == b
            upsert.vacuum(spark, root)
    assert upsert.generations(spark, root) == [2, 5]
    assert upsert.batches(spark, root) == [3, 4, 5, 6]  # those that the older snapshot lacks
    files = upsert.read_log(spark, root, ROW).inputFiles()
    assert {f.split("/")[-2] for f in files} == {"gen=5", "batch_id=6"}
    assert current(spark, root) == [("0", "v6"), ("1", "v4"), ("2", "v5"), ("gone", "x")]
    assert current(spark, root, upto=4) == [("0", "v3"), ("1", "v4"), ("2", "v2")]


def test_crash_while_compacting_and_replayed_batches_lose_nothing(spark):
    root = new_folder(spark)
    put(spark, root, 0, [("a", "1", 1), ("b", "1", 1)])
    put(spark, root, 1, [("a", "2", 2)])
    # A snapshot that was being written when the job died: files, but no commit.
    spark.createDataFrame([("a", "broken", 9)], ROW).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        f"{root}/snapshot/gen=1")
    assert upsert.generations(spark, root) == []
    assert current(spark, root) == [("a", "2"), ("b", "1")]
    assert upsert.compact(spark, root, ROW, ["id"], ["ts"]) == 1
    put(spark, root, 1, [("a", "2", 2)])  # the batch is replayed
    assert current(spark, root) == [("a", "2"), ("b", "1")]
    put(spark, root, 2, [("b", None, 5)])
    put(spark, root, 3, [("b", "older than its delete", 4)])
    assert upsert.compact(spark, root, ROW, ["id"], ["ts"]) == 3
    put(spark, root, 4, [("b", "older as well", 3)])
    assert current(spark, root) == [("a", "2")]


def rec(table, ts, type_="update", **data):
    pairs = ",".join(f'"{k}":"{v}"' for k, v in data.items())
    return f'{{"database":"shop","table":"{table}","type":"{type_}","ts":{ts},"data":{{{pairs}}}}}'


def rule(columns, table="user_info", pk="id"):
    return (f'{{"op":"u","after":{{"source_table":"{table}","sink_table":"dim_{table}",'
            f'"sink_columns":"{columns}","sink_pk":"{pk}"}}}}')


class Job:
    """A dimension job whose rules and changes arrive between runs."""

    def __init__(self, spark):
        self.spark, self.base, self.n, self.rules = spark, new_folder(spark), 0, 0

    def add_rule(self, text):
        self.spark.createDataFrame([(text, self.rules)], "value string, offset long").write.mode(
            "append").parquet(f"{self.base}/rules")
        self.rules += 1

    def add(self, *records):
        rows = [(r, self.n + k) for k, r in enumerate(records)]
        self.n += len(rows)
        self.spark.createDataFrame(rows, "value string, offset long").coalesce(1).write.mode(
            "append").parquet(f"{self.base}/changes")

    def run(self, every=2):
        s = self.spark.readStream.schema("value string, offset long").parquet(f"{self.base}/changes")
        sd.maintain(s, lambda x: dims.read_rules(x.read.parquet(f"{self.base}/rules")),
                    f"{self.base}/t", every)
        return self.now()

    def now(self, upto=None):
        return {(r.sink_table, r.pk): dict(r.data)
                for r in sd.read_dims(self.spark, f"{self.base}/t", upto=upto).collect()}


def test_dimension_job_follows_rules_and_offsets(spark):
    j = Job(spark)
    j.add_rule(rule("id,name"))
    j.add(rec("user_info", 5, id=1, name="a", x="dropped"), rec("user_info", 5, id=1, name="b"),
          rec("user_info", 4, id=2, name="c"), rec("sku_info", 4, id=7), "broken {",
          rec("user_info", 9, "delete", id=2), rec("user_info", 9, name="no key"))
    assert j.run() == {("dim_user_info", "1"): {"id": "1", "name": "b"},
                       ("dim_user_info", "2"): {"id": "2", "name": "c"}}
    j.add_rule(rule("id,x"))
    j.add_rule(rule("id", "sku_info"))
    j.add(rec("user_info", 5, id=1, name="z", x="same second, later offset"),
          rec("user_info", 3, id=2, x="older"), rec("sku_info", 1, "bootstrap-insert", id=7))
    want = {("dim_user_info", "1"): {"id": "1", "x": "same second, later offset"},
            ("dim_user_info", "2"): {"id": "2", "name": "c"},
            ("dim_sku_info", "7"): {"id": "7"}}
    assert j.run() == want
    j.add_rule('{"op":"d","before":{"source_table":"sku_info"}}')
    j.add(rec("sku_info", 8, id=8), rec("user_info", 8, id=3, x="3"))
    assert j.run() == want | {("dim_user_info", "3"): {"id": "3", "x": "3"}}
    assert j.now(upto=1) == want
    # The same batch once more changes nothing.
    batch = spark.read.parquet(f"{j.base}/changes").where("offset >= 10")
    sd.writer(lambda x: dims.read_rules(x.read.parquet(f"{j.base}/rules")), f"{j.base}/t")(batch, 2)
    assert j.now() == want | {("dim_user_info", "3"): {"id": "3", "x": "3"}}


def test_bad_rule_stops_the_job(spark):
    rules = spark.createDataFrame([("t", "dim t; drop", "id", "id", None)], schemas.RULES)
    with pytest.raises(ValueError):
        sd.check_rules(rules)
    with pytest.raises(ValueError):
        sd.check_rules(spark.createDataFrame([("t", "dim_t", "a,b", None, None)], schemas.RULES))


def test_a_change_between_two_batches_is_seen_by_the_second_only(spark):
    j = Job(spark)
    j.add_rule(rule("id,name"))
    j.add(rec("user_info", 1, id=1, name="before"))
    j.run()
    facts, out = new_folder(spark), new_folder(spark)

    def more(*rows):
        spark.createDataFrame(rows, "u string, n int").coalesce(1).write.mode("append").parquet(facts)
        s = spark.readStream.schema("u string, n int").parquet(facts)
        sd.enrich(s, f"{j.base}/t", "dim_user_info", "u", {"name": "user_name"}, out)

    def seen():
        return sorted((r.n, r.user_name, r.dim_version) for r in
                      spark.read.parquet(f"{out}/rows").collect())

    more(("1", 1), ("2", 2))
    j.add(rec("user_info", 2, id=1, name="after"))
    j.run()
    more(("1", 3))
    want = [(1, "before", 0), (2, None, 0), (3, "after", 1)]
    assert seen() == want
    # Replayed after a failure, the first batch still reads what it read then.
    write = sd.enrich_writer(f"{j.base}/t", "dim_user_info", "u", {"name": "user_name"}, out)
    write(spark.createDataFrame([("1", 1), ("2", 2)], "u string, n int"), 0)
    assert seen() == want


# ------------------------------------------------------------------ change-log joins

def feed(spark, files, **more):
    s = topic(spark, [[(a, k, o, v) for a, k, o, v in f] for f in files], changelog.IN)
    rows, _ = run(spark, changelog.join_stream(s, **more))
    return sorted((r.k, r.seq, r.op, r.l, r.r) for r in rows)


def test_left_join_takes_back_the_row_without_a_partner(spark):
    got = feed(spark, [[("l", "1", 0, "a")], [("r", "1", 0, "x")], [("r", "1", 0, "y")],
                       [("l", "1", 0, "b")], [("r", "2", 0, "z"), ("l", None, 0, "no key")]],
               how="left")
    assert got == [("1", 0, "+I", "a", None), ("1", 1, "-D", "a", None), ("1", 2, "+I", "a", "x"),
                   ("1", 3, "+I", "a", "y"), ("1", 4, "+I", "b", "x"), ("1", 5, "+I", "b", "y")]


def test_latest_rows_replace_each_other(spark):
    got = feed(spark, [[("l", "1", 1, "a")], [("r", "1", 5, "x")], [("l", "1", 0, "older")],
                       [("l", "1", 2, "b")], [("r", "1", 6, "y")]], how="full", latest=True)
    assert [g[2:] for g in got] == [
        ("+I", "a", None), ("-D", "a", None), ("+I", "a", "x"), ("-D", "a", "x"),
        ("+I", "b", "x"), ("-D", "b", "x"), ("+I", "b", "y")]


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_replayed_operations_give_the_batch_join_after_every_batch(spark, how):
    rng = random.Random(how)
    files = [[(rng.choice("lr"), rng.choice("abc"), 0, f"{n}-{i % 4}") for i in range(8)]
             for n in range(4)]
    ops = feed(spark, files, how=how)
    df = spark.createDataFrame([(op, k, seq, l, r) for k, seq, op, l, r in ops], changelog.OUT)
    got = sorted(map(tuple, changelog.replay(df).collect()), key=str)
    left = [(k, v) for f in files for s, k, _, v in f if s == "l"]
    right = [(k, v) for f in files for s, k, _, v in f if s == "r"]
    want = [(k, x, y) for k, x in left for j, y in right if j == k]
    if how in ("left", "full"):
        want += [(k, x, None) for k, x in left if k not in dict(right)]
    if how in ("right", "full"):
        want += [(k, None, y) for k, y in right if k not in dict(left)]
    assert got == sorted(want, key=str)
