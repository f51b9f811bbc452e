"""Session settings the operators are designed for, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

# Everything else is left at Spark's defaults. AQE measures both sides of a join at run time, so lookups are
# broadcast only when their real size is below the threshold, and the oversized partitions of a hot key are
# split even where the split costs one more exchange.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # archives arrive as large binaries; keep the batches handed to Python small
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
}


def build_session(app_name: str = "repolume", master: str | None = None, **extra: str) -> SparkSession:
    """A session with ``SETTINGS``; keyword settings (``spark_sql_shuffle_partitions="8"``) override them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    overrides = {key.replace("_", "."): value for key, value in extra.items()}
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the cluster's shared ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder: on a cluster such a folder
    would exist on one machine and vanish with it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/repolume/{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder whose readers are done, in whatever store it lies."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


# Folders of settled frames that may be discarded.
_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def settled(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: later steps do not compute it again, and a lost
    executor takes nothing with it."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    _FOLDERS[found] = path
    return found


def discard(*frames: DataFrame) -> None:
    """Delete the folders of settled frames that nothing will read any more."""
    for df in frames:
        path = _FOLDERS.pop(df, None)
        if path is not None:
            remove(df.sparkSession, path)
