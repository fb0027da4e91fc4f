"""Steps that must not grow faster than their input, and state by packed tables (findings of
round 4)."""

import glob
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewater.plans import queries
from tidewater.sources import topics
from tidewater.streaming import jobs
from tidewater.streaming import trade as st
from tidewater.streaming.changelog import ChangelogJoin
from tidewater.streaming.processors import GapProcessor

SF = "/root/testdata/sf0.001"
ROW = "id string, ts long, v string, event_time timestamp"


class Store:
    """The state of one group of keys in memory, with its timers and the number of calls."""

    def __init__(self):
        self.calls, self.timers, self.parts = 0, set(), {}

    def getListState(self, name, schema, ttl=None):
        return self.parts.setdefault(name, Listed(self))

    def getMapState(self, name, key, value, ttl=None):
        return self.parts.setdefault(name, Mapped(self))

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)


class Listed:
    def __init__(self, store):
        self.store, self.rows = store, []

    def _call(self):
        self.store.calls += 1

    def exists(self):
        self._call()
        return bool(self.rows)

    def get(self):
        self._call()
        return iter(list(self.rows))

    def put(self, rows):
        self._call()
        self.rows = [tuple(r) for r in rows]

    def appendValue(self, row):
        self._call()
        self.rows.append(tuple(row))

    def appendList(self, rows):
        self._call()
        self.rows += [tuple(r) for r in rows]

    def clear(self):
        self.put([])


class Mapped(Listed):
    def __init__(self, store):
        self.store, self.rows = store, {}

    def getValue(self, key):
        self._call()
        return self.rows.get(key)

    def updateValue(self, key, value):
        self._call()
        self.rows[key] = value

    def removeKey(self, key):
        self._call()
        self.rows.pop(key, None)


class Clock:
    def __init__(self, watermark):
        self.watermark = watermark

    def getCurrentWatermarkInMs(self):
        return self.watermark


def through(processor, batches, delay=2_000):
    """Rows that one group gives out over micro-batches, as Spark would call it, and its state."""
    store, out, watermark, top = Store(), [], 0, 0
    processor.init(store)
    for rows in [*batches, []]:
        rows = [r for r in rows if r[1] >= watermark]
        top = max([top, *[r[1] for r in rows]])
        if rows:
            df = pd.DataFrame(rows, columns=["id", "ts", "v"])
            df["event_time"] = pd.to_datetime(df["ts"], unit="ms")
            list(processor.handleInputRows((0,), iter([df]), Clock(watermark)))
        watermark = max(watermark, top - delay)
        for at in sorted(t for t in store.timers if t <= watermark):
            store.timers.discard(at)
            for df in processor.handleExpiredTimer((0,), Clock(watermark), None):
                out += list(df[["id", "ts", "v"]].itertuples(index=False, name=None))
    return out, store, watermark


def random_batches(seed, n=40):
    rng, at, out = np.random.default_rng(seed), 10_000, []
    for _ in range(n):
        out.append([(rng.choice(["a", "b", "c", None, "é"]), int(at + rng.integers(0, 4_000)),
                     rng.choice(["x", "y", None])) for _ in range(rng.integers(0, 6))])
        at += int(rng.integers(0, 3_000))
    return out


def in_order(batches, delay=2_000):
    """What is not late, and lies before the last watermark, in order by key."""
    watermark = top = 0
    by_key = {}
    for rows in batches:
        rows = [r for r in rows if r[1] >= watermark]
        for r in rows:
            by_key.setdefault(r[0], []).append(r)
        top = max([top, *[r[1] for r in rows]])
        watermark = max(watermark, top - delay)
    return {k: sorted((r for r in v if r[1] < watermark), key=lambda r: (r[1], r[2] or ""))
            for k, v in by_key.items()}, watermark


@pytest.mark.parametrize("seed", range(5))
def test_bursts_over_random_batches(seed):
    batches = random_batches(seed)
    got, store, _ = through(GapProcessor(5_000, ROW, ["ts", "v"], "id"), batches)
    want = []
    by_key, _ = in_order(batches)
    for rows in by_key.values():
        last = None
        for r in rows:
            if last is None or r[1] - last >= 5_000:
                want.append(r)
            last = r[1]
    assert sorted(map(str, got)) == sorted(map(str, want)) and want


@pytest.mark.parametrize("retention", [None, 9_000])
@pytest.mark.parametrize("seed", range(5))
def test_settling_over_random_batches(seed, retention):
    batches = random_batches(seed)
    got, store, _ = through(st.SettleProcessor(ROW, ["ts", "v"], 3_000, retention, key="id"),
                            batches)
    by_key, watermark = in_order(batches)
    want = []
    if retention is None:
        for rows in by_key.values():
            own = [r for r in rows if r[1] <= rows[0][1] + 3_000] if rows else []
            if own and watermark > own[0][1] + 3_000:
                want.append(own[-1])
        assert sorted(map(str, got)) == sorted(map(str, want)) and want
    else:
        assert {str(r[0]) for r in got} == {str(k) for k, v in by_key.items() if v}
        assert len(got) >= len({r[0] for r in got})


@pytest.mark.parametrize("make", [
    lambda: GapProcessor(5_000, ROW, ["ts", "v"], "id"),
    lambda: st.SettleProcessor(ROW, ["ts", "v"], 3_000, key="id")])
def test_state_calls_do_not_follow_the_keys(make):
    # state was read and written key by key.
    rows = [(f"k{i}", 10_000 + i, "x") for i in range(3_000)]
    got, store, _ = through(make(), [rows, [("z", 90_000, "x")], [("z", 99_000, "x")]])
    assert len(got) >= 3_000
    assert store.calls < 200


def test_long_numbers_beside_nulls_stay_exact(spark):
    big = 2**60 + 1
    p = GapProcessor(5_000, "id string, ts long, n long, event_time timestamp", ["ts"], "id")
    p.init(Store())
    df = pd.DataFrame({"id": ["a", None], "ts": [1, 2], "n": pd.Series([big, None], dtype=object),
                       "event_time": pd.to_datetime([1, 2], unit="ms")})
    list(p.handleInputRows((0,), iter([df]), Clock(0)))
    (out,) = list(p.handleExpiredTimer((0,), Clock(5), None))
    assert [None if pd.isna(x) else int(x) for x in out.sort_values("ts")["n"]] == [big, None]


def test_a_join_of_streams_has_one_store_a_task(spark, tmp_path):
    # four stores a task and join were opened, written and saved in each micro-batch.
    jobs.prepare(spark)
    sides = []
    for p in "lr":
        rows = spark.range(20).select("id", F.timestamp_seconds(F.col("id") * 60).alias(f"{p}_t"))
        folder = jobs.land_topic(rows, str(tmp_path / p))
        sides.append(spark.readStream.schema(rows.schema).parquet(folder)
                     .withWatermark(f"{p}_t", "0 seconds"))
    out = st.interval_join_stream(*sides, "id", "l_t", "r_t", "-1 minutes", "1 minutes")
    jobs.run_to_folder(out, str(tmp_path / "q"))
    assert spark.read.parquet(str(tmp_path / "q" / "out")).count() > 15
    parts = {p.name for p in (tmp_path / "q" / "_checkpoint" / "state" / "0" / "0").iterdir()}
    assert parts and not [p for p in parts if p.startswith(("left-", "right-"))]


def test_changelog_state_is_packed_and_holds_the_latest(spark):
    # each row was a value of its own in the state.
    join, store = ChangelogJoin("left", latest=True), Store()
    join.init(store)
    ops = []
    for batch in ([("l", f"k{i}", i, f"row {i}") for i in range(500)],
                  [("l", f"k{i}", i + 1, f"newer {i}") for i in range(0, 500, 2)]
                  + [("r", "k1", 0, "right")]):
        df = pd.DataFrame(batch, columns=["side", "k", "ord", "row"])
        for out in join.handleInputRows((0,), iter([df]), Clock(0)):
            ops += list(out.itertuples(index=False, name=None))
    assert all(len(store.parts[s].rows) == 1 for s in ("rows_l", "rows_r", "count"))
    assert len({(k, n) for _, k, n, _, _ in ops}) == len(ops)
    left = {}
    for op, k, _, l, r in ops:
        left[k, l, r] = left.get((k, l, r), 0) + (1 if op == "+I" else -1)
    assert {x for x, n in left.items() if n} == {
        (f"k{i}", f"row {i}" if i % 2 else f"newer {i}", "right" if i == 1 else None)
        for i in range(500)}


def newest(spark, pattern):
    root = queries._scratch(spark).replace("file:", "")
    return max(glob.glob(f"{root}/{pattern}"), key=os.path.getmtime)


def test_changelog_topic_is_written_where_it_is_read(spark):
    # all rows moved to three tasks first, which wrote one file each.
    queries.REGISTRY["stream_changelog_latest"](spark, SF)
    folder = newest(spark, "topics/changelog-*")
    files = glob.glob(f"{folder}/_part=*/*.parquet")
    assert len(files) > 3 and all(".zstd." in f for f in files)
    batches = glob.glob(f"{newest(spark, 'streams/changelog-*')}/_checkpoint/offsets/[0-9]*")
    assert len(batches) >= 3


def test_change_log_keeps_what_the_joins_read(spark):
    # the whole parsed log was written, and lines moved twice with all their columns.
    queries.REGISTRY["change_log_json"](spark, SF)
    folder = newest(spark, "change_log-*")
    kept = {os.path.basename(p) for p in glob.glob(f"{folder}/table=*")}
    assert kept == {f"table={t}" for t in queries.ORDER_TABLES}


@pytest.mark.parametrize("name", ["stream_keyword_metrics", "stream_province_order_metrics"])
def test_metric_streams_in_several_arrivals(spark, monkeypatch, name):
    # The state of all windows of the topic was held at once.
    whole = sorted(map(str, queries.REGISTRY[name](spark, SF).collect()))
    runs, run = [], jobs.run_to_folder
    monkeypatch.setattr(jobs, "run_to_folder", lambda df, base: (runs.append(1), run(df, base))[1])
    monkeypatch.setattr(queries, "SEARCH_ROWS", 30)
    monkeypatch.setattr(jobs, "ARRIVAL_ROWS", 2_000)
    assert sorted(map(str, queries.REGISTRY[name](spark, SF).collect())) == whole
    assert whole and len(runs) > 1


def test_parts_of_a_topic_hold_every_row_once(spark, tmp_path):
    df = spark.range(100).select(
        F.when(F.col("id") % 10 != 0, F.col("id") % 37).alias("ts"), "id")
    cuts = jobs.time_cuts(df.select("ts"), 30)
    folders = jobs.stage_arrivals(df, F.col("ts"), cuts, str(tmp_path))
    parts = [spark.read.parquet(f).collect() for f in folders]
    assert len(parts) == 4 and sorted(r.id for p in parts for r in p) == list(range(100))
    times = [[r.ts for r in p if r.ts is not None] for p in parts]
    assert all(max(a) < min(b) for a, b in zip(times, times[1:], strict=False))
    assert all(r.ts is not None for p in parts[1:] for r in p)


def test_order_facts_in_several_passes(spark, monkeypatch):
    # the shuffles of all lines lay on the disks beside the topic.
    whole = sorted(map(str, queries.REGISTRY["order_fact_typed"](spark, SF).collect()))
    cuts, write = [], topics.write_topic
    monkeypatch.setattr(topics, "write_topic", lambda df, path: (cuts.append(df), write(df, path)))
    monkeypatch.setattr(queries, "PASS_LINES", 1_000)
    assert sorted(map(str, queries.REGISTRY["order_fact_typed"](spark, SF).collect())) == whole
    assert whole and len(cuts) == queries.MOST_PASSES
    # Both sides of the join by order are cut, so neither is moved as a whole.
    text = cuts[0]._jdf.queryExecution().optimizedPlan().toString()
    assert len([x for x in text.splitlines() if "Filter" in x and "xxhash64" in x]) >= 2
