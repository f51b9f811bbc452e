"""Stored tables and the repository registry."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repolume.schemas import REGISTRY, REPO, TABLES

BUCKET = "repo_bucket"
BUCKETS = 256


def bucket_of(repo: Column) -> Column:
    """Storage bucket of a repository. A folder per repository would mean millions of folders."""
    return F.pmod(F.xxhash64(repo), F.lit(BUCKETS)).cast("int")


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, source: str = "parquet", **options: str) -> DataFrame:
    """Read with a fixed schema; a path that does not exist reads as no rows of that schema."""
    try:
        return spark.read.format(source).schema(schema).options(**options).load(path)
    except AnalysisException as error:
        if not _missing(error):
            raise
        return spark.createDataFrame([], schema)


def table_path(root: str, table: str) -> str:
    spec = TABLES[table]
    return "/".join(part for part in (root.rstrip("/"), spec.folder, spec.name) if part)


def read_bucketed(spark: SparkSession, path: str, schema: T.StructType, buckets: Iterable[int] | None = None) -> DataFrame:
    """Rows that are stored by bucket; naming ``buckets`` reads only their files."""
    df = read_or_empty(spark, path, T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())]))
    if buckets is not None:
        df = df.where(F.col(BUCKET).isin(*buckets))
    return df


def read_table(
    spark: SparkSession, root: str, table: str, repositories: list[str] | None = None, buckets: Iterable[int] | None = None
) -> DataFrame:
    """A stored table, whole or for some repositories or buckets; empty with all its columns if it was never saved.

    Naming repositories or buckets prunes the files.
    """
    spec = TABLES[table]
    df = read_bucketed(spark, table_path(root, table), spec.schema, buckets)
    if repositories is not None:
        buckets = [bucket_of(F.lit(name)) for name in repositories]
        df = df.where(F.col(BUCKET).isin(*buckets) & F.col(REPO).isin(*repositories))
    return df.select(*spec.columns)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Registered repositories, each once, from ``{"repos": [...]}`` documents (one per line)."""
    return read_or_empty(spark, path, REGISTRY, "json").select(F.explode("repos").alias(REPO)).distinct()
