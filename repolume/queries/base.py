"""Registry of the queries and access to the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repolume.functions.people import ADJECTIVES, HEX_DIGITS, NOUNS
from repolume.session import settled

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Source:
    """The test tables of one folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))


def query(sql: str | None = None):
    """Register a function of a ``Source`` under its name, with its SQL."""

    def register(function: Callable[[Source], DataFrame]):
        QUERIES[function.__name__] = lambda spark, folder: function(Source(spark, folder))
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` settled, as a pipeline does between two steps."""
    return settled(df, label)


def text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def tag(prefix: str, column: str | Column) -> Column:
    """Prefix and number as one text, e.g. a node id."""
    return F.concat(F.lit(prefix), text(column))


def user(node_id: Column, name: Column | None = None, email: Column | None = None, login: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    pick = lambda value: none if value is None else value
    return F.struct(
        node_id.alias("node_id"), pick(name).alias("name"), pick(email).alias("email"), pick(login).alias("login")
    )


def naive(df: DataFrame) -> DataFrame:
    """Times without zone, as the SQL side has them."""
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n, kind in df.dtypes if kind == "timestamp"})


def as_json(df: DataFrame, *columns: str) -> DataFrame:
    """Arrays as JSON text, which both engines write and compare alike."""
    return df.withColumns({name: F.to_json(name) for name in columns})


def sql_words(words: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{word}'" for word in words) + "]"


def sql_pseudonym(expression: str, salt: str = "") -> str:
    """The pseudonym of a text expression in SQL."""
    digest = f"sha256(concat('{salt}', {expression}))"
    word = "list_extract({words}, instr('{digits}', substr({digest}, {at}, 1))::INTEGER)"
    first = word.format(words=sql_words(ADJECTIVES), digits=HEX_DIGITS, digest=digest, at=1)
    second = word.format(words=sql_words(NOUNS), digits=HEX_DIGITS, digest=digest, at=2)
    return f"CASE WHEN ({expression}) IS NOT NULL THEN concat_ws('-', {first}, {second}, substr({digest}, 3, 32)) END"
