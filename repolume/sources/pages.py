"""Landed pages of entity listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repolume.schemas import LISTED_UNDER, PARENT, RAW, REPO
from repolume.sources.tables import read_or_empty

# Bits of ``seq`` that hold the position inside a page: no array has more elements than they can count, so pages
# never overlap, and the other 32 bits hold the page.
_POSITION_BITS = 31


def page_schema(record: T.StructType, under_parent: bool = False) -> T.StructType:
    return T.StructType(
        [
            T.StructField(REPO, T.StringType()),
            T.StructField("page", T.LongType()),
            *([T.StructField("parent", PARENT)] if under_parent else []),
            T.StructField("items", T.ArrayType(record)),
        ]
    )


def records_of(pages: DataFrame) -> DataFrame:
    """One row per record of ``{repo_full_name, page, items}`` pages; ``seq`` keeps the listing order. Pages with a
    ``parent`` give it to each of their records."""
    carried = [name for name in pages.columns if name == "parent"]
    return pages.select(REPO, "page", *carried, F.posexplode("items").alias("_pos", "_item")).select(
        REPO, (F.shiftleft("page", _POSITION_BITS) + F.col("_pos")).alias("seq"), *carried, "_item.*"
    )


def read_pages(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """All records of an entity below ``path`` (JSON, one page per line); a missing path reads as no records."""
    return records_of(read_or_empty(spark, path, page_schema(RAW[entity], entity in LISTED_UNDER), "json"))
