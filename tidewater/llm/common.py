"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.session import ship_package

# Parts over which a hot group is spread. A power of two above the usual number of task
# slots; results do not depend on it.
SPREAD = 128


# Bytes of an Arrow batch between the JVM and Python. Spark's default (64 MB, or 10,000 rows of
# any length) is held several times over by each task, in both.
_ARROW, _ARROW_DEFAULT, _ARROW_BYTES = (
    "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "8m")


def start(df: DataFrame) -> SparkSession:
    """Session of ``df`` with this package on its executors and small Arrow batches, unless
    their size was set."""
    spark = df.sparkSession
    ship_package(spark)
    if spark.conf.get(_ARROW, None) == _ARROW_DEFAULT:
        spark.conf.set(_ARROW, _ARROW_BYTES)
    return spark


def part_of(cols: Sequence[str], parts: int = SPREAD) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(parts)).cast("int")


def eq(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> Column:
    """Null-safe equality of ``cols`` on both sides."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & left[c].eqNullSafe(right[c])
    return cond


_ROW = "_row"


def packed(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The columns ``keep`` and all others, by number, in one column, so that an operator's own
    columns cannot clash with those of the caller. ``unpacked`` undoes it."""
    rest = [c for c in df.columns if c not in keep]
    return df.select(*keep, F.struct(F.lit(True).alias("there"), *[
        F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)]).alias(_ROW))


def unpacked(df: DataFrame, columns: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``columns`` as they were before ``packed``; those of ``keep`` as they are now."""
    place = {c: i for i, c in enumerate(c for c in columns if c not in keep)}
    return df.select(*[F.col(_ROW)[f"c{place[c]}"].alias(c) if c in place else F.col(c)
                       for c in columns])


def group_rank(df: DataFrame, groups: Sequence[str], order: Sequence[str], name: str,
               parts: int = SPREAD) -> DataFrame:
    """Adds ``name``: 0, 1, 2 ... within ``groups`` (not null), without one task holding a
    whole group. Rows are numbered inside (group, part of the hashed order columns) and
    shifted by the counts of the parts before."""
    d = df.withColumn("_gr_part", part_of(order, parts))
    keys = [*groups, "_gr_part"]
    before = Window.partitionBy(*groups).orderBy("_gr_part").rowsBetween(
        Window.unboundedPreceding, -1)
    base = (d.groupBy(*keys).agg(F.count(F.lit(1)).alias("_gr_n"))
            .select(*keys, F.coalesce(F.sum("_gr_n").over(before), F.lit(0)).alias("_gr_base")))
    inner = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    return (d.withColumn("_gr_in", inner).join(base, keys)
            .withColumn(name, (F.col("_gr_in") + F.col("_gr_base")).cast("long"))
            .drop("_gr_in", "_gr_base", "_gr_part"))


def with_group_total(df: DataFrame, key: Sequence[str], spread_by: Sequence[str],
                     aggs: dict[str, tuple[Column, Column]],
                     parts: int = SPREAD) -> DataFrame:
    """Adds aggregates of each ``key`` group to its rows, without one task reading a whole
    group: partial results per (key, part) are merged per key and joined back on
    (key, part). ``aggs``: name -> (aggregate over rows, aggregate merging ``name``).
    Keys must not be null."""
    d = df.withColumn("_gt_part", part_of(spread_by, parts))
    small = d.groupBy(*key, "_gt_part").agg(*[a.alias(n) for n, (a, _) in aggs.items()])
    total = small.groupBy(*key).agg(*[m.alias(n) for n, (_, m) in aggs.items()])
    back = small.select(*key, "_gt_part").join(total, list(key))
    return d.join(back, [*key, "_gt_part"]).drop("_gt_part")


FILTER_BITS = 1 << 26  # bits of the filter of wanted rows


def wanted_filter(want: DataFrame, column: str) -> Broadcast:
    """A filter of fixed size over the hashes in ``column`` (long): says of a row that it may
    be wanted, or that it is not."""
    bit = F.pmod(F.col(column), F.lit(FILTER_BITS)) + 1  # the functions count from 1
    filled = (want.select(column).distinct().groupBy(F.bitmap_bucket_number(bit).alias("b"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")))
    seen = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in filled.collect():  # one job, and at most FILTER_BITS bits, whatever the corpus
        part = np.frombuffer(r.bits, np.uint8)
        at = (r.b - 1) * len(part)
        seen[at:at + len(part)] |= part[:max(0, len(seen) - at)]
    return want.sparkSession.sparkContext.broadcast(seen)


def maybe_wanted(df: DataFrame, seen: Broadcast, column: str, wanted: bool = True) -> DataFrame:
    """Rows of ``df`` that may be wanted, or those that certainly are not. Spares an exchange
    most rows; what follows decides exactly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = seen.value
        for b in batches:
            at = b.column(column).to_numpy(zero_copy_only=False) % FILTER_BITS
            found = (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            yield b.filter(pa.array(found == wanted))

    return df.mapInArrow(run, df.schema)


# ---- numpy helpers used inside tasks --------------------------------------------------

M1 = np.uint64(0xBF58476D1CE4E5B9)
M2 = np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 (a bijection of 64-bit values)."""
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.empty(max(n, 1), np.uint64)
    out[0] = 1
    done = 1
    b = np.uint64(base)
    while done < n:
        step = min(done, n - done)
        top = np.uint64(int(out[done - 1]) * int(b) & 0xFFFFFFFFFFFFFFFF)
        out[done:done + step] = out[:step] * top
        done += step
    return out[:n]


def chunks(sizes: Sequence[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items holding about ``most`` in size (one item at least)."""
    begin = total = 0
    for i, s in enumerate(sizes):
        if i > begin and total + s > most:
            yield begin, i
            begin, total = i, 0
        total += s
    if begin < len(sizes):
        yield begin, len(sizes)


def bounded(batches: Iterator[pa.RecordBatch], column: str = "text",
            most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in batches of about ``most`` bytes of ``column``, so that what a
    task derives from a batch stays small."""
    for b in batches:
        sizes = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False)
        for lo, hi in chunks(sizes.tolist(), most):
            yield b.slice(lo, hi - lo)
