"""Saving and exporting tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repolume.functions.ranking import first_per_key
from repolume.operators.lookups import lookup, unknown_only
from repolume.schemas import REPO, TABLES
from repolume.session import remove, scratch_dir
from repolume.sources.tables import BUCKET, bucket_of, read_bucketed, read_or_empty, read_registry, read_table, table_path


def _write(df: DataFrame, path: str, mode: str) -> set[int]:
    """Write by bucket; returns the buckets that got rows, observed by the job that writes them."""
    seen = Observation()
    # rebalance sizes the output files and splits the bucket of a repository that dominates the table
    (
        df.withColumn(BUCKET, bucket_of(F.col(REPO)))
        .hint("rebalance", BUCKET)
        .observe(seen, F.collect_set(BUCKET).alias("buckets"))
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BUCKET)
        .parquet(path)
    )
    return set(seen.get["buckets"] or ())


def buckets_of(df: DataFrame) -> set[int]:
    """Buckets of the repositories in ``df``: at most ``BUCKETS`` small integers."""
    return {row[0] for row in df.select(bucket_of(F.col(REPO))).distinct().collect()}


def save_table(df: DataFrame, root: str, table: str, repositories: DataFrame | None = None) -> None:
    """Replace the rows of the repositories in ``df``; the other repositories keep theirs.

    ``repositories`` names the repositories to replace when some of them may have no row left. Only their
    buckets are read and rewritten. The overwrite is per partition and takes place at commit, so ``df`` may be
    derived from the stored table itself. ``df`` is computed once.
    """
    spark, spec, path = df.sparkSession, TABLES[table], table_path(root, table)
    df, staged = df.select(*spec.columns), None
    if repositories is None:
        # the rows name the repositories, so they are needed twice
        staged = scratch_dir(spark, f"save-{table}")
        df.write.parquet(staged)
        df = spark.read.schema(spec.schema).parquet(staged)
    _replace(df, path, spec.schema, (df if repositories is None else repositories).select(REPO).distinct())
    if staged:
        remove(spark, staged)


def _replace(df: DataFrame, path: str, schema: T.StructType, replaced: DataFrame) -> None:
    """Replace the rows of the repositories ``replaced`` below ``path`` by ``df``; only their buckets are read and written."""
    spark, buckets = df.sparkSession, buckets_of(replaced)
    if not buckets:
        return
    stored = read_bucketed(spark, path, schema, buckets).select(*schema.names)
    # a bucket that loses its last row is in no partition that is written, so it is emptied on its own
    emptied = buckets - _write(df.unionByName(unknown_only(stored, replaced, [REPO])), path, "overwrite")
    for bucket in sorted(emptied):
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{path}/{BUCKET}={bucket}")


def save_state(df: DataFrame, path: str, schema: T.StructType, replaced: DataFrame) -> None:
    """``save_table`` for what is kept beside the tables."""
    _replace(df.select(*schema.names), path, schema, replaced.select(REPO).distinct())


def save_buckets(df: DataFrame, path: str) -> None:
    """Write ``df`` (settled, all rows of its buckets) over these buckets below ``path``; the other buckets stay."""
    _write(df, path, "overwrite")


def save_together(tables: dict[str, DataFrame], root: str) -> None:
    """Save tables that were derived from each other's stored rows.

    Saving the first one would pull the files from under the second, so all of them are written to the shared
    scratch folder before the first stored table changes. Users are saved first: if the saving stops half-way, no
    stored row refers to a user that is not stored. The scratch folders go when all is saved.
    """
    staged, paths = {}, {}
    for name, df in tables.items():
        paths[name] = scratch_dir(df.sparkSession, f"staged-{name}")
        df.select(*TABLES[name].columns).write.parquet(paths[name])
        staged[name] = df.sparkSession.read.schema(TABLES[name].schema).parquet(paths[name])
    for name in sorted(staged, key=lambda name: name != "users"):
        # the staged rows are at hand, so their repositories cost no second computation
        save_table(staged[name], root, name, staged[name])
    for name, path in paths.items():
        remove(staged[name].sparkSession, path)


def save_if_any(df: DataFrame, root: str, table: str) -> bool:
    """Save unless there is nothing to save; says whether it saved."""
    if df.isEmpty():
        return False
    save_table(df, root, table)
    return True


def append_users(users: DataFrame, root: str) -> None:
    """Add users that are not stored yet, after the stored ones; stored users stay as they are."""
    once = first_per_key(users.select(*TABLES["users"].columns), [REPO, "id"], [F.col("seq"), F.col("anonym_uuid")])
    stored = read_table(users.sparkSession, root, "users")
    fresh = unknown_only(once, stored, [REPO, "id"])
    last = stored.groupBy(REPO).agg(F.max("seq").alias("_last"))
    fresh = lookup(fresh, last, {REPO: REPO}, {"_last": "_last"})
    fresh = fresh.withColumn("seq", F.coalesce("_last", F.lit(-1)) + 1 + F.col("seq")).select(*once.columns)
    _write(fresh, table_path(root, "users"), "append")


def add_repositories(spark: SparkSession, path: str, names: DataFrame) -> None:
    """Append the repositories that are not registered yet, one ``{"repos": [name]}`` line each."""
    fresh = unknown_only(names.select(REPO).distinct(), read_registry(spark, path), [REPO])
    fresh.select(F.array(REPO).alias("repos")).write.mode("append").json(path)


def flat(df: DataFrame) -> DataFrame:
    """Arrays and structs as JSON text, for formats that hold plain values only."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    return df.select(
        *[
            F.to_json(field.name).alias(field.name) if isinstance(field.dataType, nested) else F.col(field.name)
            for field in df.schema.fields
        ]
    )


def export_tables(tables: dict[str, DataFrame], folder: str, source: str = "csv") -> None:
    """Write each table to ``folder/<name>`` as CSV (with header) or JSON, one folder per table."""
    for name, df in tables.items():
        writer = flat(df).write.mode("overwrite").format(source)
        if source == "csv":
            # quotes are doubled as in any CSV reader; line breaks stay inside the quotes
            writer = writer.options(header="true", escape='"', nullValue="\\N")
        writer.save(f"{folder.rstrip('/')}/{name}")


def read_export(spark: SparkSession, folder: str, name: str, schema: T.StructType, source: str = "csv") -> DataFrame:
    """Read an exported table back; nested columns come as JSON text."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    plain = T.StructType(
        [T.StructField(f.name, T.StringType() if isinstance(f.dataType, nested) else f.dataType) for f in schema]
    )
    options = dict(header="true", escape='"', nullValue="\\N", emptyValue="", multiLine="true") if source == "csv" else {}
    return read_or_empty(spark, f"{folder.rstrip('/')}/{name}", plain, source, **options)


def catalog(spark: SparkSession, root: str) -> DataFrame:
    """Folder, table, number of columns and rows of every table of the catalog."""
    counts = [
        read_table(spark, root, name).agg(F.count("*").alias("rows")).select(
            F.lit(spec.folder).alias("folder"),
            F.lit(name).alias("table"),
            F.lit(len(spec.columns)).cast("long").alias("columns"),
            "rows",
        )
        for name, spec in TABLES.items()
    ]
    return reduce(DataFrame.unionByName, counts)
