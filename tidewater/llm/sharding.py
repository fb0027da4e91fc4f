"""Shards by vector bin packing, with DataFrame operations around a bounded plan.

Items are groups of documents with equal texts, each a vector of bytes, tokens (words) and
rows. Items are packed one after another, the largest first, each into the shard whose
residual capacity has the highest dot product with it. What the plan sees does not grow with
the corpus: groups above a share of 1 / BUNDLES of any total (at most 3 * BUNDLES of them)
are items of their own, all others are joined by hash into 2 * BUNDLES bundles, half of them
small so that the last items level the shards. A group goes to one shard whole. Only a group
larger than a shard is split by doc_id into parts, so one text that fills a third of the corpus
still spreads; and, largest first, groups that would leave the bytes of the shards more than
SPREAD_MOST apart (down to a sixteenth of a shard).

The law is ``bytes``: the sizes of the shards are near equal. Its dimension weighs most.

Defined cases: a null text has size 1 and counts as its own group; repeated rows are placed
together with their group; a null doc_id is kept; an empty table gives an empty result;
empty shards are possible when there are fewer items than shards.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import group_rank, start
from tidewater.session import materialize

BUNDLES = 4096
FINE = 0.1  # share of the hash space in the small bundles
PARTS = 16  # parts of a split group per shard that it could fill
SPREAD_MOST = 0.01  # of a shard's mean bytes, between the largest and the smallest
WEIGHTS = (1.0, 0.25, 0.25)  # of bytes, tokens and rows


def dot_product_packing(items: np.ndarray, shards: int,
                        weights: tuple[float, ...] = WEIGHTS) -> np.ndarray:
    """Shard of each item (rows: vectors)."""
    total = np.maximum(items.sum(axis=0), 1)
    unit = items / total * shards  # a full shard is 1 in every dimension
    left = np.ones((shards, items.shape[1]))
    w = np.asarray(weights)
    out = np.zeros(len(items), np.int64)
    for i in np.argsort(-unit.max(axis=1), kind="stable"):
        k = int((left @ (w * unit[i])).argmax())
        out[i] = k
        left[k] -= unit[i]
    return out


def plan(groups: list[str], items: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each item, where the items of a group stay together unless the group is
    larger than a shard or, whole, would keep the bytes from being level."""
    names, group = np.unique(np.asarray(groups, str), return_inverse=True)
    whole = np.zeros((len(names), items.shape[1]))
    np.add.at(whole, group, items)
    filled = (whole / np.maximum(items.sum(axis=0), 1)).max(axis=1, initial=0) * shards
    limit = 1.0
    while True:
        together = filled[group] <= limit
        own = np.where(together, group, len(names) + np.arange(len(items)))
        _, unit = np.unique(own, return_inverse=True)
        vectors = np.zeros((int(unit.max(initial=-1)) + 1, items.shape[1]))
        np.add.at(vectors, unit, items)
        where = dot_product_packing(vectors, shards)[unit]
        size = np.bincount(where, items[:, 0], minlength=shards)
        if limit * PARTS <= 1 or np.ptp(size) <= SPREAD_MOST * size.mean():
            return where
        limit /= 2


def _bundle(key: Column) -> Column:
    r = F.pmod(F.xxhash64(key, F.lit(11)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return F.when(r < 1 - FINE, F.floor(r / (1 - FINE) * BUNDLES)).otherwise(
        BUNDLES + F.floor((r - (1 - FINE)) / FINE * BUNDLES)).cast("string")


def assign(docs: DataFrame, shards: int = 16) -> DataFrame:
    """doc_id, size (UTF-8 bytes and 1), text_crc32, shard and slot (0, 1 ... within the
    shard) of every row of ``docs`` (doc_id, text)."""
    spark = start(docs)
    text = F.coalesce("text", F.lit(""))
    rows = materialize(docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.size(F.split(F.trim(text), r"\s+")).cast("long").alias("tokens"),
        F.xxhash64("text", F.octet_length(text)).alias("key")), "sizes")
    sums = [F.sum("size").alias("size"), F.sum("tokens").alias("tokens"),
            F.count(F.lit(1)).alias("rows")]
    total = [max(x or 0, 1) for x in rows.agg(*sums).first()]
    share = F.greatest(F.col("size") / total[0], F.col("tokens") / total[1],
                       F.col("rows") / total[2])
    # At most 3 * BUNDLES rows: shares of a total above 1 / BUNDLES.
    heavy = (rows.groupBy("key").agg(*sums).withColumn("share", share)
             .where(F.col("share") > 1 / BUNDLES)
             .select("key", F.ceil(F.col("share") * shards * PARTS).cast("long").alias("parts"))
             .collect())
    parts = spark.createDataFrame(heavy, "key long, parts long")
    part = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(5)), F.col("parts"))
    named = (rows.join(F.broadcast(parts), "key", "left")
             .withColumn("item", F.when(F.col("parts").isNull(), _bundle(F.col("key")))
                         .otherwise(F.concat_ws(":", F.col("key"), part))))
    # Bounded as well: bundles and parts of heavy groups.
    items = named.groupBy("item").agg(*sums).collect()
    items.sort(key=lambda r: r.item)
    vectors = np.asarray([(r["size"], r.tokens, r.rows) for r in items], float).reshape(-1, 3)
    where = plan([r.item.split(":")[0] + ":" * (":" in r.item) for r in items], vectors, shards)
    places = spark.createDataFrame(
        [(r.item, int(k)) for r, k in zip(items, where, strict=True)], "item string, shard int")
    placed = named.join(F.broadcast(places), "item").select(
        "doc_id", "size", "text_crc32", "shard")
    return group_rank(placed, ["shard"], ["doc_id", "size", "text_crc32"], "slot")
