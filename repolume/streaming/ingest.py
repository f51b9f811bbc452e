"""Continuous form of cursor paging: landed pages are picked up as they arrive.

``stream_into_store`` keeps the newest version of every record in a state that never expires and lays what has changed
over the stored table, batch by batch; reading the table costs the same however many versions have landed.
``append_versions`` appends every landed version to a log, without state, and ``current_state`` reads the newest one.
Nothing is ever dropped, however late it lands.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from repolume.operators.incremental import latest_per_id
from repolume.plans.activity import key_of, merge_table, updated_column
from repolume.schemas import LISTED_UNDER, RAW, REPO, TABLES
from repolume.sources.pages import page_schema, records_of


def stream_pages(spark: SparkSession, path: str, entity: str, max_files: int = 1000) -> DataFrame:
    """Records of the pages below ``path``, as a stream."""
    schema = page_schema(RAW[entity], entity in LISTED_UNDER)
    pages = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).json(path)
    return records_of(pages)


def stream_table(spark: SparkSession, path: str, schema: T.StructType, max_files: int = 1000) -> DataFrame:
    """Parquet files below ``path``, as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def newest_versions(stream: DataFrame, key: Sequence[str], updated_at: str | None) -> DataFrame:
    """The newest version of each key so far, as a streaming aggregate; of equal times the content decides.

    ``max`` of the whole record, ordered by time and digest, also keeps records without a time.
    """
    columns = stream.columns
    order = [F.col(updated_at)] if updated_at else []
    newest = F.max(F.struct(*order, F.xxhash64(*columns).alias("_digest"), F.struct(*columns).alias("_record")))
    return stream.groupBy(*[F.col(c).alias(f"_k_{c}") for c in key]).agg(newest["_record"].alias("_record")).select("_record.*")


def stream_into_store(
    stream: DataFrame, root: str, table: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None
) -> StreamingQuery:
    """Lay all that has landed over the stored ``table`` and stop; run again to go on from the checkpoint.

    The state (RocksDB, below ``checkpoint``) holds the newest version of every record and emits those that a batch
    touches. ``merge_table`` puts them over the stored rows and rewrites only the buckets they are in. A batch that is run
    again after a failure finds its own rows stored already and gives the same table, and a record that lands late
    loses against the newer one in the state.
    """
    spark = stream.sparkSession
    rows = (transform(stream) if transform else stream).select(*TABLES[table].columns)
    newest = newest_versions(rows, key_of(table), updated_column(table))
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider, None)
    spark.conf.set(provider, STATE_STORE)  # a query keeps the settings it is started with
    started = (
        newest.writeStream.outputMode("update")
        .foreachBatch(lambda batch, _: merge_table(batch, root, table))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    spark.conf.unset(provider) if before is None else spark.conf.set(provider, before)
    return started


def append_versions(
    stream: DataFrame, log: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None
) -> StreamingQuery:
    """Append what has landed to the log and stop; run again to go on from the checkpoint.

    Log and checkpoint have to be in a folder all executors reach. The file sink commits each batch once, also
    when a batch is run again after a failure.
    """
    rows = transform(stream) if transform else stream
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", log)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_state(
    spark: SparkSession, log: str, schema: T.StructType, key: Sequence[str] = (REPO, "id"),
    updated_at: str = "updated_at", seq: str | None = None,
) -> DataFrame:
    """Newest version of every record in the log."""
    return latest_per_id(spark.read.schema(schema).parquet(log), key, updated_at, seq)
