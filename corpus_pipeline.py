"""A corpus pipeline: toxic documents go, copies and near copies go, sources are mixed, the rest is tokenized.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``, is written as Parquet, and is read again as the next one's
``docs``. A lost executor costs at most the tasks of one stage. All stages but the last keep the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from repolume.llm.byte_bpe import encode_and_decode, read_ranks
from repolume.llm.exact_dedup import drop_copies
from repolume.llm.minhash import drop_near_duplicates
from repolume.llm.mixing import take_copies
from repolume.llm.toxicity import drop_toxic
from repolume.session import scratch_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labels of the documents that are here."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return drop_near_duplicates(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of its sources takes it."""
    return take_copies(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, ids, n_tokens and the digests of ids and decoded bytes of each row."""
    ranks = read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return encode_and_decode(docs, ranks, public_tokenizers.PATTERN, ["doc_id", "source"], ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("exact dedup", without_copies),
    ("minhash near-dedup", without_near_copies),
    ("mixing sources", mixture),
    ("byte-level bpe", tokens),
]
# Models, chosen paths and random rounding are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
