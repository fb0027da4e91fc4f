"""Upsert log with snapshots (S8, S9, S13): bounded reads whatever the number of batches.

Layout of a table ``root``:

* ``delta/batch_id=N``: the keyed rows of batch N. A batch that is written again replaces
  itself.
* ``snapshot/gen=G``: the latest row of every key over the batches up to G, deletes included (a
  late older change must not bring a deleted key back). A snapshot counts once Spark has
  committed it (``_SUCCESS``), so a crash while writing one leaves the table as it was: the
  generation before and all deltas are still there. Only ``vacuum`` removes what a newer
  snapshot covers, and it keeps the generation before, which running readers may hold.

Readers take the newest complete snapshot and the deltas after it, so with a snapshot every
``n`` batches a read costs one row a key and at most ``n`` deltas. ``upto`` reads the table as
it was after a batch. Rows are ordered by columns of their own (event time, offset), not by
batch, so how changes are cut into batches does not show.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators.dedupe import latest_per_key


def _fs(spark: SparkSession, path: str):
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), p


def _numbered(spark: SparkSession, folder: str, name: str) -> list[int]:
    """N of all complete folders ``name=N`` in ``folder``, in order."""
    fs, path = _fs(spark, folder)
    if not fs.exists(path):
        return []
    found = []
    for status in fs.listStatus(path):
        at = status.getPath()
        key, _, number = at.getName().partition("=")
        if key == name and fs.exists(_fs(spark, f"{folder}/{at.getName()}/_SUCCESS")[1]):
            found.append(int(number))
    return sorted(found)


def generations(spark: SparkSession, root: str) -> list[int]:
    """Complete snapshots, by the last batch that each holds."""
    return _numbered(spark, f"{root}/snapshot", "gen")


def batches(spark: SparkSession, root: str) -> list[int]:
    """Complete deltas."""
    return _numbered(spark, f"{root}/delta", "batch_id")


def version(spark: SparkSession, root: str) -> int:
    """The newest batch that the table holds, -1 for none."""
    return max([-1, *generations(spark, root), *batches(spark, root)])


def write_delta(df: DataFrame, root: str, batch_id: int) -> None:
    """Adds the keyed rows of one batch."""
    df.write.mode("overwrite").parquet(f"{root}/delta/batch_id={batch_id}")


def read_log(spark: SparkSession, root: str, schema: T.StructType | str,
             upto: int | None = None) -> DataFrame:
    """Newest snapshot and the deltas behind it; several rows a key."""
    known = [g for g in generations(spark, root) if upto is None or g <= upto]
    gen = known[-1] if known else -1
    paths = [f"{root}/snapshot/gen={gen}"] if known else []
    paths += [f"{root}/delta/batch_id={b}" for b in batches(spark, root)
              if b > gen and (upto is None or b <= upto)]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def read_current(spark: SparkSession, root: str, schema: T.StructType | str, keys: Sequence[str],
                 order: Sequence[str], payload: str | None = None,
                 upto: int | None = None, where=None) -> DataFrame:
    """The latest row of every key by ``order``; a key whose latest ``payload`` is null is
    deleted."""
    log = read_log(spark, root, schema, upto)
    latest = latest_per_key(log if where is None else log.where(where), keys, order)
    return latest if payload is None else latest.where(F.col(payload).isNotNull())


def compact(spark: SparkSession, root: str, schema: T.StructType | str, keys: Sequence[str],
            order: Sequence[str]) -> int:
    """Writes a snapshot of all batches so far; its generation, -1 if there is nothing new."""
    newest = batches(spark, root)
    if not newest or newest[-1] in generations(spark, root):
        return -1
    gen = newest[-1]
    (latest_per_key(read_log(spark, root, schema, gen), keys, order)
     .write.mode("overwrite").parquet(f"{root}/snapshot/gen={gen}"))
    return gen


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Removes snapshots but the newest ``keep``, and deltas that the oldest kept one covers."""
    if keep < 1:
        raise ValueError("the newest snapshot must stay")
    known = generations(spark, root)
    if len(known) < keep:
        return
    oldest = known[-keep]
    gone = [f"snapshot/gen={g}" for g in known[:-keep]]
    gone += [f"delta/batch_id={b}" for b in batches(spark, root) if b <= oldest]
    for folder in gone:
        fs, path = _fs(spark, f"{root}/{folder}")
        fs.delete(path, True)
