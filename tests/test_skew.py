"""A hot key holding a third of all rows: the bucketed neighbour lookup must equal a
plain per-key window, and its plan must not put a whole key into one window partition."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.functions.sequence import first_per_group, time_bucket, with_next


def hot_rows(spark, n=30_000):
    # ids 0..n-1; every third row belongs to key 'hot', the rest spread over 500 keys
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))).alias("key"),
        ((F.col("id") * 7919) % 1_000_003).alias("ts"), F.col("id"))


def test_with_next_matches_window_under_skew(spark):
    df = hot_rows(spark)
    got = with_next(df, ["key"], ["ts", "id"], ["ts", "id"], time_bucket("ts", 10_000))
    w = Window.partitionBy("key").orderBy("ts", "id")
    want = df.select("key", "ts", "id", F.lead("ts").over(w).alias("next_ts"),
                     F.lead("id").over(w).alias("next_id"))
    a = {tuple(r) for r in got.select("key", "ts", "id", "next_ts", "next_id").collect()}
    b = {tuple(r) for r in want.collect()}
    assert a == b


def test_plan_windows_are_bucketed(spark):
    df = hot_rows(spark)
    got = with_next(df, ["key"], ["ts", "id"], ["ts"], time_bucket("ts", 10_000))
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        got.explain()
    plan = buf.getvalue()
    assert "Window [" in plan
    for line in plan.splitlines():
        if "Window [" in line and "lead(ts" in line:
            assert "_tw_bucket" in line  # rows are windowed per (key, bucket)


def test_first_per_group_hot_key(spark):
    df = hot_rows(spark).withColumn("day", (F.col("ts") / 100_000).cast("long"))
    got = {tuple(r) for r in first_per_group(df, ["key", "day"], ["ts", "id"])
           .select("key", "day", "id").collect()}
    w = Window.partitionBy("key", "day").orderBy("ts", "id")
    want = {tuple(r) for r in df.withColumn("rn", F.row_number().over(w))
            .where("rn = 1").select("key", "day", "id").collect()}
    assert got == want
