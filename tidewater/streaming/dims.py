"""The dimension job as a stream (D1, J11, S7, S14), and lookups that see its changes.

``maintain`` routes a topic of changes by rules that are read anew for every micro-batch, so a
rule counts from the batch after its arrival, and a deleted one no more. Each batch becomes a
delta of one upsert table for all sinks; every ``every`` batches a snapshot follows. Within a
second the change with the higher offset wins, in whatever batch it comes.

``enrich`` looks a stream up in a dimension as it is at the start of each micro-batch. The
version it used is written before the rows, so a batch that is replayed after a failure reads
the same version again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import dims
from tidewater.operators.cdc import read_change_log
from tidewater.operators.dedupe import latest_per_key
from tidewater.sources import upsert
from tidewater.sources.topics import dim_schema, safe_name

DIM_SCHEMA = "sink_table string, pk string, data map<string,string>, ts long, offset long"
KEYS, ORDER = ["sink_table", "pk"], ["ts", "offset"]
MOST_RULES = 10_000


def check_rules(rules: DataFrame) -> None:
    """Raises if a rule cannot make a table (S14): a bad name, or a key that is no column.
    Rules are configuration: more than ``MOST_RULES`` are an error as well."""
    rows = rules.select("sink_table", "sink_columns", "sink_pk").limit(MOST_RULES + 1).collect()
    if len(rows) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    for r in rows:
        safe_name(r.sink_table)
        dim_schema(r.sink_columns, r.sink_pk)


def dim_rows(changes: DataFrame, rules: DataFrame) -> DataFrame:
    """The last change of every dimension row in ``changes`` (value: JSON text, offset)."""
    routed = dims.prune_columns(dims.apply_rules(read_change_log(changes), rules))
    keyed = routed.select("sink_table", F.col("data")[F.col("sink_pk")].alias("pk"), "data",
                          "ts", "offset")
    return latest_per_key(keyed.where(F.col("pk").isNotNull()), KEYS, ORDER)


def writer(rules_of: Callable[[SparkSession], DataFrame], root: str,
           every: int = 10) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function of ``maintain``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rules = rules_of(spark)
        check_rules(rules)
        upsert.write_delta(dim_rows(batch, rules), root, batch_id)
        if (batch_id + 1) % every == 0:
            upsert.compact(spark, root, DIM_SCHEMA, KEYS, ORDER)
            upsert.vacuum(spark, root)
    return write


def maintain(changes: DataFrame, rules_of: Callable[[SparkSession], DataFrame], root: str,
             every: int = 10) -> None:
    """Runs the dimension job over everything available of ``changes`` (a stream of value and
    offset) into the table ``root``."""
    q = (changes.writeStream.foreachBatch(writer(rules_of, root, every))
         .option("checkpointLocation", f"{root}/_checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()


def read_dims(spark: SparkSession, root: str, sink_table: str | None = None,
              upto: int | None = None) -> DataFrame:
    """Current rows (sink_table, pk, data) of one dimension or of all, or as they were after
    batch ``upto``."""
    where = None if sink_table is None else F.col("sink_table") == sink_table
    return upsert.read_current(spark, root, DIM_SCHEMA, KEYS, ORDER, "data", upto, where)


def _version_of(spark: SparkSession, root: str, out: str, batch_id: int) -> int:
    """The version of the dimension that a batch reads: the newest when it first ran."""
    path = f"{out}/_versions/batch_id={batch_id}"
    if batch_id not in upsert._numbered(spark, f"{out}/_versions", "batch_id"):
        now = upsert.version(spark, root)
        spark.range(now, now + 1).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path).first()[0]


def enrich_writer(root: str, sink_table: str, key: str, fields: dict[str, str],
                  out: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that adds ``fields`` (dimension column -> output column) of
    the row whose key equals ``key`` to each batch (left join; a miss gives nulls) and the
    version read as ``dim_version``; one folder a batch under ``out/rows``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = _version_of(spark, root, out, batch_id)
        rows = read_dims(spark, root, sink_table, seen)
        flat = rows.select("pk", *[F.col("data")[c].alias(c) for c in fields])
        (dims.enrich(batch, flat, key, "pk", fields)
         .withColumn("dim_version", F.lit(seen).cast("long"))
         .write.mode("overwrite").parquet(f"{out}/rows/batch_id={batch_id}"))
    return write


def enrich(stream: DataFrame, root: str, sink_table: str, key: str, fields: dict[str, str],
           out: str) -> None:
    """Runs ``enrich_writer`` over everything available of ``stream``."""
    q = (stream.writeStream.foreachBatch(enrich_writer(root, sink_table, key, fields, out))
         .option("checkpointLocation", f"{out}/_checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
