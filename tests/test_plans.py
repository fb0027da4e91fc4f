"""What queries move: plans, columns and groups."""

import collections
import os
import random

from tests.test_streaming_trade import new_folder, run, topic

from tidewater import schemas
from tidewater.operators import dims
from tidewater.plans import queries as q
from tidewater.sources import driver_tables as dt
from tidewater.sources import topics
from tidewater.streaming import changelog, jobs, processors
from tidewater.streaming import trade as st

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rules_go_to_the_rows(spark):
    log = spark.createDataFrame([("shop", "user_info", "insert", 1, {"id": "1"}, None)],
                                schemas.CHANGE_LOG)
    unknown_size = spark.createDataFrame(dt.RULE_ROWS, schemas.RULES)
    assert "hashpartitioning" not in plan(dims.apply_rules(log, unknown_size))


def test_codes_have_a_known_size(spark):
    log = spark.createDataFrame([("2401", 1)], "code string, n int")
    for fixed, key, rows in ((dt.dictionary(spark), "dic_code", dt.DICTIONARY_ROWS),
                             (dt.rules(spark), "source_table", dt.RULE_ROWS)):
        assert "hashpartitioning" not in plan(log.join(fixed, log["code"] == fixed[key]))
        assert [tuple(r) for r in fixed.collect()] == rows


def test_settled_rows_hold_what_is_read(spark):
    assert set(q.settled_lines(spark, SF, cols=["order_id"]).columns) == {
        "order_detail_id", "order_id", *q.LINE_ORDER}


def test_latest_lines_hold_what_is_read(spark):
    assert "split_original_amount" not in plan(q.q_latest_per_key(spark, SF))
    assert "sku_name" not in plan(q.q_latest_per_key(spark, SF)).split("max_by(")[1]


def test_change_log_text_is_parsed_once(spark):
    assert "from_json" not in plan(q.q_change_log_json(spark, SF))


def test_topics_are_compressed(spark):
    folder = new_folder(spark)
    topics.write_topic(spark.createDataFrame([("a" * 5000,)], "v string"), folder)
    assert {f[-7:] for f in os.listdir(folder) if f.startswith("part")} == {".txt.gz"}
    assert topics.read_topic(spark, folder).first().value == '{"v":"%s"}' % ("a" * 5000)


def test_keys_of_a_group_keep_their_own_rows_and_numbers(spark, monkeypatch):
    monkeypatch.setattr(changelog, "GROUPS", 1)
    rng = random.Random(2)
    files = [[(rng.choice("lr"), rng.choice("abcd"), rng.randint(0, 9), f"{n}-{i}")
              for i in range(12)] for n in range(3)]
    for latest in (False, True):
        rows, _ = run(spark, changelog.join_stream(
            topic(spark, files, changelog.IN), "full", latest))
        numbers = collections.defaultdict(list)
        for r in rows:
            numbers[r.k].append(r.seq)
        assert all(sorted(v) == list(range(len(v))) for v in numbers.values())
        held = {}
        for s, k, o, v in (x for f in files for x in f):
            mine = held.setdefault(k, {"l": [], "r": []})
            if not latest:
                mine[s].append((o, v))
            elif not mine[s] or (o, v) > mine[s][0]:
                mine[s] = [(o, v)]
        want = [(k, x[1], y[1]) for k, h in held.items()
                for x in h["l"] or [(0, None)] for y in h["r"] or [(0, None)]]
        got = changelog.replay(spark.createDataFrame(rows, changelog.OUT)).collect()
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_keys_of_a_group_settle_and_burst_on_their_own(spark, monkeypatch):
    monkeypatch.setattr(processors, "GROUPS", 1)
    cols = "id string, ts long, v string, event_time timestamp"
    files = [[("a", 1000, "a1"), ("b", 2000, "b1")], [("a", 3000, "a2"), ("b", 9000, "b2")],
             [("c", 60000, "c1"), ("a", 61000, "a3")], [("z", 200000, "z1")]]

    def stream():
        return (topic(spark, files, "id string, ts long, v string")
                .selectExpr("*", "timestamp_millis(ts) AS event_time")
                .withWatermark("event_time", "0 seconds"))
    rows, _ = run(spark, st.settle_stream(stream(), "id", 5000, ["ts"], cols, None))
    assert sorted(r.v for r in rows) == ["a2", "b1", "c1"]
    rows, _ = run(spark, st.settle_stream(stream(), "id", 5000, ["ts"], cols, 20000))
    assert sorted(r.v for r in rows) == ["a2", "a3", "b1", "c1"]
    rows, _ = run(spark, jobs.gap_stream(stream(), "id", 5000, ["ts"], cols))
    assert sorted(r.v for r in rows) == ["a1", "a3", "b1", "b2", "c1"]
