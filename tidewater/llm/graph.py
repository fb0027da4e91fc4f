"""Connected components of a large edge list, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import with_group_total
from tidewater.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """``edges``: a, b (long, not null). Result: node, root (the smallest node that links
    reach), one row per node with an edge. Alternates large-star and small-star rounds until
    nothing changes; a node with very many links is spread over parts."""
    least = {"m": (F.min("v"), F.min("m"))}

    def stars(d: DataFrame, keep) -> DataFrame:
        g = with_group_total(d, ["u"], ["v"], least)
        return g.withColumn("m", F.least("m", "u")).where(keep)

    now = materialize(edges.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while not _is_star_forest(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (stars(both, F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        small = stars(large, F.lit(True))
        now = materialize(
            small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small.select("u", F.col("m").alias("v"))).distinct(), "stars")
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def forest_roots(pointers: DataFrame) -> DataFrame:
    """``pointers``: a, b (long), one row per a, without cycles. Result: node, root (where the
    pointers from the node end), one row per node with a pointer to or from it. Pointers double
    in every round. Many rows may point to one node: both sides of the join are read from
    written tables, so its exchange can be split where it is skewed."""
    now = materialize(pointers.select("a", "b"), "pointers")
    while True:
        further = now.select(F.col("a").alias("b"), F.col("b").alias("c"))
        after = materialize(
            now.join(further, "b", "left").select(
                "a", F.coalesce("c", "b").alias("b"), F.col("c").isNotNull().alias("moved")),
            "pointers")
        now = after.select("a", "b")
        if after.where("moved").isEmpty():
            break
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _is_star_forest(edges: DataFrame) -> bool:
    """Whether every u > v has one v, which is no u itself: then v is its least node."""
    twice = edges.groupBy("u").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    ends = edges.select(F.col("v").alias("u")).distinct()
    return twice.isEmpty() and edges.join(ends, "u", "left_semi").isEmpty()
