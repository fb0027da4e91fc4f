"""Structured Streaming forms of the click-log jobs.

The page log is read as a file stream (the topic landed as parquet), event time gets a
bounded-lateness watermark, the per-device state machines run as ``transformWithState``
processors, and metrics are tumbling-window aggregations in append mode. Checkpoints
and outputs live under the shared folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater import schemas
from tidewater.functions.time import window_text
from tidewater.session import ensure_checkpoint_dir, free_shuffles, ship_package
from tidewater.streaming.processors import (FLAT_COLS, FLAT_SCHEMA, DailyFirstProcessor,
                                            JumpProcessor, group_of)

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def flat_page(page: DataFrame) -> DataFrame:
    """Page log (nested click records) as the flat rows the processors take."""
    return page.select(
        F.col("common.mid").alias("mid"), "ts", "offset",
        F.col("page.last_page_id").alias("last_page_id"), F.col("common.vc").alias("vc"),
        F.col("common.ch").alias("ch"), F.col("common.ar").alias("ar"),
        F.col("common.is_new").alias("is_new"),
        F.col("page.during_time").alias("during_time"),
        F.timestamp_millis("ts").alias("event_time"))


def land_topic(df: DataFrame, folder: str) -> str:
    """Write rows as the landed topic (parquet files) for a file stream."""
    df.write.mode("overwrite").parquet(folder)
    return folder


# Rows that one arrival of a topic holds, about.
ARRIVAL_ROWS = 4_000_000


def time_cuts(times: DataFrame, rows: int) -> list[int]:
    """Times that cut a topic into parts of about ``rows`` rows; ``times``: their ``ts``."""
    n = -(-times.count() // rows)
    return sorted({int(c) for c in times.approxQuantile(
        "ts", [i / n for i in range(1, n)], 1 / (10 * n))}) if n > 1 else []


def stage_arrivals(df: DataFrame, time: Column, cuts: list[int], base: str) -> list[str]:
    """Writes rows once, without moving them between tasks, in parts by ``time`` (those without
    one in the first); the folders of the parts in order of time, for ``run_arrivals``."""
    part = F.lit(0)
    for c in cuts:
        part = part + F.coalesce(time >= c, F.lit(False)).cast("int")
    (df.withColumn("_part", part).write.partitionBy("_part").option("compression", "zstd")
     .parquet(f"{base}/staged"))
    free_shuffles(df.sparkSession)
    jvm = df.sparkSession.sparkContext._jvm
    topic = jvm.org.apache.hadoop.fs.Path(f"{base}/topic")
    topic.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).mkdirs(topic)
    return [f"{base}/staged/_part={i}" for i in range(len(cuts) + 1)]


def run_arrivals(spark: SparkSession, df: DataFrame, staged: list[str], base: str) -> DataFrame:
    """``run_to_table`` over the topic ``base``/topic, whose parts arrive one after the other: the
    stream goes on after each, so it holds the state of one part and not of the whole topic.
    Parts follow each other in time, so no row is late that would not be late in one."""
    prepare(spark)
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path
    fs = path(base).getFileSystem(sc._jsc.hadoopConfiguration())
    out = f"{base}/stream/out"
    for i, folder in enumerate(staged):
        if i and not fs.exists(path(folder)):
            continue
        for f in fs.listStatus(path(folder)) if fs.exists(path(folder)) else ():
            name = f.getPath().getName()
            if name.endswith(".parquet"):
                fs.rename(f.getPath(), path(f"{base}/topic/{i:06d}-{name}"))
        run_to_folder(df, f"{base}/stream")
        free_shuffles(spark)
    return spark.read.schema(df.schema).parquet(out)


def read_topic_stream(spark: SparkSession, folder: str, delay: str = "2 seconds",
                      files_per_trigger: int | None = None) -> DataFrame:
    """File-backed page topic as a stream with a bounded out-of-orderness watermark.
    ``files_per_trigger`` bounds a micro-batch, and so what a key holds."""
    return (_files(spark, FLAT_SCHEMA, files_per_trigger).parquet(folder)
            .withWatermark("event_time", delay))


def _files(spark: SparkSession, schema: str, files_per_trigger: int | None):
    r = spark.readStream.schema(schema)
    return r if files_per_trigger is None else r.option("maxFilesPerTrigger", files_per_trigger)


def _zone(df: DataFrame) -> str:
    return df.sparkSession.conf.get("spark.sql.session.timeZone")


def _grouped(stream: DataFrame, key: str):
    """Rows by groups of keys, as a ``GroupedProcessor`` takes them."""
    return stream.withColumn("_group", group_of(key)).groupBy("_group")


def unique_visitor_stream(stream: DataFrame) -> DataFrame:
    """First session start of every (device, day) (T8, streaming)."""
    starts = stream.where(F.col("last_page_id").isNull())
    return _grouped(starts, "mid").transformWithStateInPandas(
        DailyFirstProcessor(_zone(stream)), FLAT_SCHEMA, "Append", "EventTime")


def user_jump_stream(stream: DataFrame, within_ms: int = 10_000) -> DataFrame:
    """Bounced session starts (T9, streaming) with an event-time timeout."""
    return _grouped(stream, "mid").transformWithStateInPandas(
        JumpProcessor(within_ms), FLAT_SCHEMA, "Append", "EventTime")


def channel_metrics_stream(spark: SparkSession, pages: str, visitors: str, jumps: str,
                           length: str = "10 seconds", delay: str = "13 seconds",
                           files_per_trigger: int | None = None) -> DataFrame:
    """Channel metrics (A1) over three topics - pages, unique visitors, jumps - unioned, then
    one windowed aggregation emitted when the watermark closes it. The watermark of 13 s
    (T11) covers the 2 s of lateness, the 10 s that a jump is held, and one second."""
    zero = F.lit(0).cast("long")
    one = F.lit(1).cast("long")
    keys = ["event_time", "vc", "ch", "ar", "is_new"]
    measures = {
        pages: {"sv": F.col("last_page_id").isNull().cast("long"), "pv": one,
                "dur": F.col("during_time")},
        visitors: {"uv": one}, jumps: {"uj": one}}
    rows = None
    for folder, own in measures.items():
        part = (_files(spark, FLAT_SCHEMA, files_per_trigger).parquet(folder)
                .select(*keys, *[own.get(c, zero).alias(c)
                                 for c in ("uv", "sv", "pv", "dur", "uj")]))
        rows = part if rows is None else rows.unionByName(part)
    rows = rows.withWatermark("event_time", delay)
    g = rows.groupBy(F.window("event_time", length).alias("win"), "vc", "ch", "ar", "is_new").agg(
        F.sum("uv").alias("uv_ct"), F.sum("sv").alias("sv_ct"), F.sum("pv").alias("pv_ct"),
        F.coalesce(F.sum("dur"), zero).alias("dur_sum"), F.sum("uj").alias("uj_ct"))
    return g.select(*window_text("win"), "vc", "ch", "ar", "is_new", "uv_ct", "sv_ct",
                    "pv_ct", "dur_sum", "uj_ct")


def prepare(spark: SparkSession) -> None:
    """What stateful streams need of the session: the package on the executors and a state
    store that holds lists and timers. It does not count its rows, for which it would read
    every key before it is written, keeps the states of the last batches only (what is not
    needed goes soon from the disks), and a join of streams has one store a task for both sides
    instead of four."""
    ship_package(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "false")
    spark.conf.set("spark.sql.streaming.minBatchesToRetain", "2")
    spark.conf.set("spark.sql.streaming.join.stateFormatVersion", "3")
    spark.conf.set("spark.sql.streaming.stateStore.maintenanceInterval", "10s")


def run_to_table(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Run a streaming DataFrame over everything available (``availableNow``) into a
    parquet table under the checkpoint folder, and return that table."""
    prepare(spark)
    base = f"{ensure_checkpoint_dir(spark)}/streams/{name}-{uuid.uuid4().hex[:8]}"
    return spark.read.schema(df.schema).parquet(run_to_folder(df, base))


def run_to_folder(df: DataFrame, base: str) -> str:
    """Run a streaming DataFrame over everything available; the folder of its rows, which
    another stream can read as a topic."""
    q = (df.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", f"{base}/_checkpoint").option("compression", "zstd")
         .trigger(availableNow=True).start(f"{base}/out"))
    q.awaitTermination()
    return f"{base}/out"


def land_page_log(spark: SparkSession, page: DataFrame, name: str) -> str:
    base = f"{ensure_checkpoint_dir(spark)}/topics/{name}-{uuid.uuid4().hex[:8]}"
    return land_topic(flat_page(page).select(*FLAT_COLS), base)


def repaired_log_stream(raw: DataFrame) -> DataFrame:
    """Raw click records (``value``, ``offset`` where there is one) with the repaired
    ``is_new`` beside the text (T2 ahead of T17). Flags follow the order of arrival: there is
    no watermark, so no record is late or lost. Records that are dirty or have no device or
    time pass as they are."""
    from tidewater.operators.logs import parse_json
    from tidewater.streaming.processors import ARRIVAL_SCHEMA, ArrivalFlagProcessor

    offset = F.col("offset") if "offset" in raw.columns else F.lit(None)
    rows = parse_json(raw, schemas.CLICK_LOG).select(
        F.col("_rec.common.mid").alias("mid"), F.col("_rec.ts").alias("ts"),
        offset.cast("long").alias("offset"), F.col("_rec.common.is_new").alias("is_new"),
        "value", "is_dirty")
    keyed = ~F.col("is_dirty") & F.col("mid").isNotNull() & F.col("ts").isNotNull()
    fixed = rows.where(keyed).drop("is_dirty").groupBy("mid").transformWithStateInPandas(
        ArrivalFlagProcessor(_zone(raw)), ARRIVAL_SCHEMA, "Append", "None")
    out = fixed.unionByName(rows.where(~keyed).drop("is_dirty")).drop("mid", "ts")
    return out if "offset" in raw.columns else out.drop("offset")


def fan_out_writer(root: str):
    """``foreachBatch`` function writing the five log outputs and the dirty records of one
    micro-batch (T17, S10). Takes (value, is_new[, offset]); ``is_new`` replaces the record's
    own flag. The batch is persisted once, each output is appended to its own folder with
    the batch id as a partition (dynamic overwrite makes a replayed batch idempotent),
    then the batch is released. Memory held is bounded by one micro-batch."""
    from tidewater.operators.logs import fan_out_log, split_dirty

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            clean, dirty = split_dirty(batch.withColumnRenamed("is_new", "_is_new"))
            clean = clean.withColumn("common", F.col("common").withField(
                "is_new", F.col("_is_new"))).drop("_is_new")
            outs = fan_out_log(clean)
            outs["dirty"] = dirty.drop("_is_new")
            for name, df in outs.items():
                (df.withColumn("batch_id", F.lit(batch_id).cast("long"))
                 .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy("batch_id")
                 .parquet(f"{root}/{name}"))
        finally:
            batch.unpersist()
    return write


def fan_out(raw: DataFrame, root: str, writer=None) -> None:
    """Repair the flags of a raw click-log stream and route it into page/start/error/display/
    action and dirty tables under ``root``: all available input, one checkpointed query."""
    prepare(raw.sparkSession)
    q = (repaired_log_stream(raw).writeStream.foreachBatch(writer or fan_out_writer(root))
         .option("checkpointLocation", f"{root}/_checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()


def run_fan_out(spark: SparkSession, raw_folder: str, root: str,
                files_per_trigger: int | None = None) -> None:
    """``fan_out`` of a topic of text files."""
    from tidewater.sources.topics import read_topic
    options = {} if files_per_trigger is None else {"maxFilesPerTrigger": files_per_trigger}
    fan_out(read_topic(spark, raw_folder, stream=True, **options), root)


KEYWORD_SQL = """
SELECT date_format(window.start, 'yyyy-MM-dd HH:mm:ss') AS stt,
       date_format(window.end, 'yyyy-MM-dd HH:mm:ss') AS edt,
       'search' AS source, keyword, count(*) AS keyword_count
FROM (
  SELECT window(rt, '{length}') AS window, keyword
  FROM {view}
  LATERAL VIEW explode(regexp_extract_all(lower(item), '{pattern}', 0)) w AS keyword
  WHERE item IS NOT NULL AND last_page_id = 'search' AND item_type = 'keyword')
GROUP BY window, keyword
"""


def keyword_metrics_stream(spark: SparkSession, folder: str, length: str = "10 seconds",
                           view: str = "page_log_stream") -> DataFrame:
    """Keyword counts per window over a page-log stream, in SQL (S5, T12, A4): the page
    table keeps item fields and ts, computes ``rt`` (seconds precision) and a 2 s
    watermark, and the words come from a lateral explode of the built-in tokenizer."""
    from tidewater.functions.text import WORD_PATTERN
    src = (spark.readStream.schema(
        "ts long, offset long, last_page_id string, item string, item_type string")
        .parquet(folder)
        .withColumn("rt", F.timestamp_seconds(F.floor(F.col("ts") / 1000)))
        .withWatermark("rt", "2 seconds"))
    src.createOrReplaceTempView(view)
    pattern = WORD_PATTERN.replace("\\", "\\\\")
    return spark.sql(KEYWORD_SQL.format(length=length, view=view, pattern=pattern))


def new_flag_stream(stream: DataFrame) -> DataFrame:
    """New-visitor flag repair over a click-record stream (T2, streaming)."""
    from tidewater.streaming.processors import NewFlagProcessor
    return _grouped(stream, "mid").transformWithStateInPandas(
        NewFlagProcessor(_zone(stream)), FLAT_SCHEMA, "Append", "EventTime")


def login_stream(stream: DataFrame, back_days: int = 8) -> DataFrame:
    """Daily-unique and back-flow logins over a stream of login rows (T4, streaming)."""
    from tidewater.streaming.processors import LOGIN_SCHEMA, LoginProcessor
    return _grouped(stream, "uid").transformWithStateInPandas(
        LoginProcessor(back_days, _zone(stream)), LOGIN_SCHEMA, "Append", "EventTime")


def gap_stream(stream: DataFrame, key: str, gap_ms: int, sort_cols: list[str],
               out_schema: str) -> DataFrame:
    """Burst-first rows per key over a stream (T1b, streaming); ``stream`` has ``ts``
    (epoch ms) and an ``event_time`` column with a watermark."""
    from tidewater.streaming.processors import GapProcessor
    return _grouped(stream, key).transformWithStateInPandas(
        GapProcessor(gap_ms, out_schema, sort_cols, key), out_schema, "Append", "EventTime")
