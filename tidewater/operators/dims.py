"""Dimension tables and lookups.

Lookups are left joins against a dimension DataFrame read once per query (streaming:
once per micro-batch), so there is no cache to evict (D2). Rule tables are a fixed,
small configuration and are broadcast; product and province dimensions grow with the
catalogue and are left to the planner's measured-size choice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater import schemas

ACCEPTED_TYPES = ("insert", "update", "bootstrap-insert")


def lookup_join(df: DataFrame, dim: DataFrame, left_on: str, right_on: str,
                fields: Sequence[str], how: str = "left") -> DataFrame:
    """Enrich ``df`` with ``fields`` of the dimension row whose ``right_on`` equals
    ``left_on`` (J6/J7). A miss gives nulls (Q3)."""
    r = dim.select(F.col(right_on).alias("_tw_dk"), *fields)
    return df.join(r, df[left_on] == r["_tw_dk"], how).drop("_tw_dk")


def enrich(df: DataFrame, dim: DataFrame, key: str, dim_key: str,
           fields: dict[str, str]) -> DataFrame:
    """Generic enrichment hook (J7/X4): ``fields`` maps dim column -> output column."""
    r = dim.select(F.col(dim_key).alias("_tw_dk"),
                   *[F.col(src).alias(dst) for src, dst in fields.items()])
    return df.join(r, df[key] == r["_tw_dk"], "left").drop("_tw_dk")


def product_dim(sku: DataFrame, spu: DataFrame, trademark: DataFrame, cat3: DataFrame,
                cat2: DataFrame, cat1: DataFrame) -> DataFrame:
    """Denormalised product dimension (J9/J10): the snowflake chain sku -> spu,
    trademark, category3 -> category2 -> category1 joined once, so facts need one join."""
    return (sku.select(F.col("id").alias("sku_id"), "spu_id", "tm_id", "category3_id")
            .join(spu.select(F.col("id").alias("spu_id"), "spu_name"), "spu_id", "left")
            .join(trademark.select(F.col("id").alias("tm_id"), "tm_name"), "tm_id", "left")
            .join(cat3.select(F.col("id").alias("category3_id"),
                              F.col("name").alias("category3_name"), "category2_id"),
                  "category3_id", "left")
            .join(cat2.select(F.col("id").alias("category2_id"),
                              F.col("name").alias("category2_name"), "category1_id"),
                  "category2_id", "left")
            .join(cat1.select(F.col("id").alias("category1_id"),
                              F.col("name").alias("category1_name")),
                  "category1_id", "left"))


def read_rules(changes: DataFrame, value: str = "value", offset: str = "offset") -> DataFrame:
    """Current rules from a topic of rule changes, JSON text ``{before, after, op}`` (S7): the
    latest change of each source table counts; one without ``after`` deletes its rule, and
    text that is no change is skipped."""
    c = F.from_json(F.col(value), schemas.RULE_CHANGE)
    rows = changes.select(c.alias("c"), F.col(offset).alias("_at")).where(
        F.col("c.after").isNotNull() | F.col("c.before").isNotNull())
    source = F.coalesce("c.after.source_table", "c.before.source_table")
    last = rows.groupBy(source.alias("_src")).agg(F.max_by("c.after", "_at").alias("r"))
    return last.where(F.col("r").isNotNull()).select("r.*")


def apply_rules(log: DataFrame, rules: DataFrame) -> DataFrame:
    """Rows whose table has a rule and whose type is insert/update/bootstrap-insert,
    tagged with ``sink_table``, ``sink_columns`` and ``sink_pk`` (J11, P22). Deletes and
    unconfigured tables are dropped. Rules are configuration, so they go to the rows: a log has
    few tables, and a shuffle by table would put each in one task."""
    r = rules.select(
        F.col("source_table").alias("_src"), "sink_table", "sink_columns",
        F.coalesce(F.col("sink_pk"), F.lit("id")).alias("sink_pk"))
    return (log.where(F.col("type").isin(*ACCEPTED_TYPES))
            .join(F.broadcast(r), F.col("table") == r["_src"], "inner").drop("_src"))


def prune_columns(tagged: DataFrame) -> DataFrame:
    """Keep only the data keys listed in the rule's ``sink_columns`` (exact names)."""
    cols = F.split(F.col("sink_columns"), ",")
    return tagged.withColumn(
        "data", F.map_filter("data", lambda k, _v: F.array_contains(cols, k)))


def maintain_dims(log: DataFrame, rules: DataFrame) -> DataFrame:
    """Current dimension rows (D1): route by rule, prune columns, keep the latest change
    per (sink table, key) - an upsert merge expressed as a ``max_by`` aggregation.
    Output: sink_table, pk, data (map of kept columns)."""
    pruned = prune_columns(apply_rules(log, rules))
    keyed = pruned.withColumn("pk", F.col("data")[F.col("sink_pk")])
    return (keyed.groupBy("sink_table", "pk")
            .agg(F.max_by("data", F.struct("ts", "type")).alias("data")))


def dim_long(dims: DataFrame) -> DataFrame:
    """One row per (sink table, key, non-null column) of a dimension table."""
    return (dims.select("sink_table", "pk", F.explode("data").alias("column", "value"))
            .where(F.col("value").isNotNull()))
