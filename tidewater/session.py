"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# The driver tables are naive UTC wall clock; sessions made here follow it unless told
# otherwise.
DEFAULT_TZ = "UTC"


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "tidewater", tz: str = DEFAULT_TZ,
              conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the UI off. Master, partitions and memory are left
    to the submit command unless given."""
    b = (SparkSession.builder.appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", tz))
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables and stream state.

    ``spark.checkpoint.dir`` where it is set; else a folder of this application in the
    SQL warehouse, which all executors share as well, removed when the application ends.
    """
    root = (spark.conf.get("spark.checkpoint.dir", None)
            or spark.sparkContext.getConf().get("spark.checkpoint.dir", None))
    if not root:
        sc = spark.sparkContext
        root = f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch-{sc.applicationId}"
        path = sc._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(path)
        spark.conf.set("spark.checkpoint.dir", root)
    spark.sparkContext.setCheckpointDir(root)
    return root


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the application ends."""
    sc = spark.sparkContext
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    jpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back: it is evaluated
    once, and a lost executor recomputes from the table."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Has the driver notice which finished jobs nobody refers to any more, so that their
    shuffle files go from the executors' disks now and not at some later collection."""
    spark.sparkContext._jvm.System.gc()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors (once per application), so that Python workers
    can import it wherever the driver was started."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for folder, _, names in os.walk(top):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    path = os.path.join(tempfile.mkdtemp(prefix="tidewater-"), "tidewater_pkg.zip")
    with open(path, "wb") as f:
        f.write(buf.getvalue())
    sc.addPyFile(path)  # the driver serves it to every executor
    _SHIPPED.add(sc.applicationId)
