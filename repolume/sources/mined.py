"""Full scans of the mined commit and edit tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from repolume.schemas import MINED_COMMITS, MINED_EDITS
from repolume.sources.tables import read_or_empty


def read_mined_commits(spark: SparkSession, path: str, source: str = "parquet") -> DataFrame:
    return read_or_empty(spark, path, MINED_COMMITS, source)


def read_mined_edits(spark: SparkSession, path: str, source: str = "parquet") -> DataFrame:
    return read_or_empty(spark, path, MINED_EDITS, source)
