"""Exact deduplication with a streaming registry of digests.

The documents' digests are streamed through a keyed state that never expires and is held on disk (RocksDB, with its
checkpoint in the shared folder). For each digest the state retains the identifier of the document that stays, where
its content lies, and how many documents had the digest. Every document is then looked up in that registry.

A hit proves nothing but equal digests, so full texts are compared as well: documents are grouped by digest *and*
whole text, after partial aggregation in the map tasks, so a group that holds a third of the rows sends one row per
task. Digests that stand for more than one text are decided by text.

Defined results: a NULL text is an empty text; NULL ids sort below all others; repeated rows are members of their
group like any others (and share the verdict of their id); no documents give no rows. Other columns are ignored, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repolume.llm.common import lower_ascii, settled
from repolume.session import scratch_dir

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def registry(digests: DataFrame, folder: str, bytes_per_batch: int = 256 << 30) -> DataFrame:
    """Stream ``digests`` (digest, doc_id, locator; a frame that lies in ``folder`` as Parquet) through the keyed state.

    Returns digest, keep_id, locator (of the document that stays) and group_size. The state is the result: it is
    read back from its checkpoint. A restarted stream continues from the files it has not seen.
    """
    own = digests.sparkSession.newSession()
    for name, value in {
        "spark.sql.streaming.stateStore.providerClass": STATE_STORE,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        # without it every state partition reserves some megabytes of disk before it holds a row
        "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
        "spark.sql.shuffle.partitions": digests.sparkSession.conf.get("spark.sql.shuffle.partitions"),
    }.items():
        own.conf.set(name, value)
    checkpoint = scratch_dir(own, "exact-dedup-state")
    rows = own.readStream.schema(digests.schema).option("maxBytesPerTrigger", bytes_per_batch).parquet(folder)
    state = rows.groupBy("digest").agg(
        F.max(F.struct("doc_id", "locator")).alias("keep"), F.count(F.lit(1)).alias("group_size")
    )
    run = state.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint)
    run.trigger(availableNow=True).start().awaitTermination()
    held = digests.sparkSession.read.format("statestore").load(checkpoint)
    keep, size = (F.col("value")[name] for name in held.schema["value"].dataType.names)
    return held.select(
        F.col("key.digest").alias("digest"), keep["doc_id"].alias("keep_id"), keep["locator"].alias("locator"),
        size.alias("group_size"),
    )


def exact_dedup(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every document; of equal texts the largest id stays.

    Texts are equal when identical after lower-casing A-Z. ``digest`` may be any function of the text, however
    weak: it decides which texts are compared, not which are equal.
    """
    texts = docs.select("doc_id", lower_ascii(F.coalesce("text", F.lit(""))).alias("content"))
    folder = scratch_dir(docs.sparkSession, "exact-dedup-digests")
    digests = texts.select(
        digest(F.col("content")).alias("digest"), sha256(F.col("content")).alias("sha256"), "doc_id",
        F.input_file_name().alias("locator"),
    )
    digests.write.parquet(folder)
    digests = docs.sparkSession.read.schema(digests.schema).parquet(folder)
    if digests.isEmpty():
        known = digests.select("digest", F.col("doc_id").alias("keep_id"), F.lit(0).cast("long").alias("group_size"))
    else:
        known = registry(digests, folder)
    decided = digests.join(known.select("digest", "keep_id", "group_size"), "digest")
    exact = texts.groupBy(digest(F.col("content")).alias("digest"), "content").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    clashing = settled(
        exact.groupBy("digest").agg(F.count(F.lit(1)).alias("n_texts")).where("n_texts > 1").select("digest"),
        "exact-dedup-clashes",
    )
    columns = ["doc_id", "keep_id", "group_size", "sha256"]
    if not clashing.isEmpty():
        by_text = exact.join(clashing, "digest", "left_semi").withColumn("sha256", sha256(F.col("content")))
        members = texts.withColumn("digest", digest(F.col("content"))).join(clashing, "digest", "left_semi")
        decided = (
            decided.join(clashing, "digest", "left_anti")
            .select(columns)
            .unionByName(members.select("doc_id", "content").join(by_text, "content").select(columns))
        )
    return decided.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha256")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns; of repeated rows (same id, equal text) one stays."""
    kept = exact_dedup(docs).where("kept").select("doc_id", F.unhex("text_sha256").alias("digest")).distinct()
    # whole rows travel as one column, so that no column of theirs can clash
    marked = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").alias("id"),
        sha256(lower_ascii(F.coalesce("text", F.lit("")))).alias("digest"),
    )
    same = marked["id"].eqNullSafe(kept["doc_id"]) & (marked["digest"] == kept["digest"])
    return marked.join(kept, same, "left_semi").dropDuplicates(["id", "digest"]).select("row.*")
