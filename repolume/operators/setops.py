"""Unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repolume.operators.incremental import latest_per_id


def concat(*frames: DataFrame) -> DataFrame:
    """Rows of all frames; columns that a frame lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_tagged(parts: dict[str, DataFrame], tag: str = "parent_name") -> DataFrame:
    """Rows of several sources, with the name of the source."""
    return reduce(DataFrame.unionByName, [df.withColumn(tag, F.lit(name)) for name, df in parts.items()])


def stitch(
    windows: Sequence[DataFrame], key: Sequence[str] = ("id",), updated_at: str = "updated_at", seq: str | None = None
) -> DataFrame:
    """One set out of overlapping windows of a listing: every id once, in its newest state; of equal times that of
    the later window (or the larger ``seq``)."""
    numbered = [window.withColumn("_window", F.lit(at)) for at, window in enumerate(windows)]
    return latest_per_id(reduce(DataFrame.unionByName, numbered), key, updated_at, seq or "_window").drop("_window")


def distinct_items(df: DataFrame, column: str, scope: Sequence[str] = (), name: str = "item") -> DataFrame:
    """Distinct elements of an array column."""
    return df.select(*scope, F.explode(column).alias(name)).distinct()
