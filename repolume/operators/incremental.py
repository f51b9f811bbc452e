"""Change detection, upserts and cursor paging."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repolume.functions.ranking import first_per_key, first_rows, with_position
from repolume.functions.scalars import changed
from repolume.operators.lookups import lookup, unknown_only
from repolume.operators.ordering import page
from repolume.schemas import REPO


def latest_per_id(
    df: DataFrame, key: Sequence[str] = (REPO, "id"), updated_at: str = "updated_at", seq: str | None = None
) -> DataFrame:
    """Newest version of each id; ``seq`` decides between versions with the same time. Without ``seq`` their content
    does, so that the same versions give the same row in any input order."""
    tie = F.col(seq).desc_nulls_last() if seq else F.xxhash64(*df.columns)
    return first_per_key(df, key, [F.col(updated_at).desc_nulls_last(), tie])


def upsert(
    old: DataFrame, new: DataFrame, key: Sequence[str] = (REPO, "id"), updated_at: str = "updated_at"
) -> DataFrame:
    """Old rows with the new ones put over them; of an id the newest version stays, the new one if both tie."""
    both = old.withColumn("_is_new", F.lit(0)).unionByName(new.withColumn("_is_new", F.lit(1)), True)
    # of two new versions with the same time the content decides
    ranked = both.withColumn("_is_new", F.struct("_is_new", F.xxhash64(*new.columns)))
    return latest_per_id(ranked, key, updated_at, "_is_new").drop("_is_new")


def has_updates(
    new: DataFrame, old: DataFrame, updated_at: str = "updated_at", key: str = "id", name: str = "has_updates"
) -> DataFrame:
    """One row, one boolean: does the listing differ from what is stored.

    Nothing stored: is there anything new. With ids: is the newest record missing in the store, or stored with
    another time. Without ids: does the newest time differ from the newest stored one. An empty listing brings
    no update.
    """
    keyed = key in old.columns and key in new.columns
    order = [updated_at, key] if keyed else [updated_at]
    newest = new.agg(F.max(F.struct(*order)).alias("_newest"), F.count("*").alias("_new_rows"))
    newest = newest.withColumn("_one", F.lit(0))
    # the newest record is one row; the store is scanned once for its size and for that record
    stored = old.select(*order).withColumn("_one", F.lit(0)).join(F.broadcast(newest), "_one")
    if keyed:
        found = F.max(F.when(F.col(key) == F.col(f"_newest.{key}"), F.col(updated_at)))
    else:
        found = F.max(updated_at)
    store = stored.agg(F.count("*").alias("_old_rows"), found.alias("_found")).withColumn("_one", F.lit(0))
    verdict = (
        F.when(F.col("_new_rows") == 0, False)
        .when(F.col("_old_rows") == 0, True)
        .otherwise(changed(F.col("_found"), F.col(f"_newest.{updated_at}")))
    )
    return newest.join(F.broadcast(store), "_one").select(verdict.alias(name))


def updates_per_repository(
    new: DataFrame, old: DataFrame, updated_at: str = "updated_at", key: str = "id", scope: Sequence[str] = (REPO,),
    name: str = "has_updates",
) -> DataFrame:
    """``has_updates`` for every repository of a listing at once: one row per repository that is listed."""
    scope = list(scope)
    newest = new.groupBy(*scope).agg(F.max(F.struct(updated_at, key)).alias("_newest"))
    newest = newest.select(*scope, F.col(f"_newest.{key}").alias("_id"), F.col(f"_newest.{updated_at}").alias("_at"))
    known = old.groupBy(*scope, key).agg(F.max(updated_at).alias("_stored"), F.lit(True).alias("_known"))
    on = {**{c: c for c in scope}, "_id": key}
    found = lookup(newest, known, on, {"_stored": "_stored", "_known": "_known"})
    verdict = F.col("_known").isNull() | changed(F.col("_stored"), F.col("_at"))
    return found.select(*scope, verdict.alias(name))


def row_digest(columns: Sequence[str]) -> Column:
    """Hash of a row to be summed up. A NULL leaves the hash as it is, so which columns are NULL is hashed too."""
    return F.xxhash64(*columns, *[F.col(c).isNull() for c in columns]).cast("decimal(38,0)")


def children_per_repository(
    repositories: DataFrame, new: DataFrame, old: DataFrame, scope: Sequence[str] = (REPO,), name: str = "has_updates"
) -> DataFrame:
    """Whether the children of each of ``repositories`` (say, the reactions under its issues) differ from the stored
    ones in any column: one row per repository, also for those that have no child left or never had one.

    New rows count for, stored rows against: equal sets, in any order, cancel out. One shuffle of one row per
    repository and task.
    """
    scope = list(scope)
    columns = [c for c in new.columns if c in old.columns and c not in scope]
    signed = lambda df, sign: df.select(*scope, F.lit(sign).alias("_sign"), (row_digest(columns) * sign).alias("_digest"))
    sums = signed(new, 1).unionByName(signed(old, -1)).groupBy(*scope).agg(F.sum("_sign").alias("_n"), F.sum("_digest").alias("_d"))
    differing = sums.where((F.col("_n") != 0) | (F.col("_d") != 0)).withColumn("_differs", F.lit(True))
    asked = repositories.select(*scope).distinct()
    found = lookup(asked, differing, {c: c for c in scope}, {"_differs": "_differs"})
    return found.select(*scope, F.coalesce("_differs", F.lit(False)).alias(name))


def content_per_repository(
    new: DataFrame, old: DataFrame, scope: Sequence[str] = (REPO,), name: str = "has_updates"
) -> DataFrame:
    """Whether a repository's listing differs from the store in any column of any record: one row per repository
    that is listed. For records that change without an update time.

    Both sides are reduced to their number of rows and a sum of row digests, which no order of rows changes.
    """
    scope = list(scope)
    columns = [c for c in new.columns if c in old.columns and c not in scope]
    digest = F.sum(row_digest(columns))
    state = lambda df: df.groupBy(*scope).agg(F.struct(F.count("*"), digest).alias("_state"))
    known = state(old).withColumnRenamed("_state", "_stored")
    found = lookup(state(new), known, {c: c for c in scope}, {"_stored": "_stored"})
    return found.select(*scope, (~F.col("_state").eqNullSafe(F.col("_stored"))).alias(name))


def change_classes(
    new: DataFrame, old: DataFrame, key: Sequence[str] = (REPO, "id"), updated_at: str = "updated_at",
    name: str = "change",
) -> DataFrame:
    """``new``, ``changed`` or ``same`` for every record of a listing, against the store."""
    known = old.select(*key, F.col(updated_at).alias("_old"), F.lit(True).alias("_known"))
    found = lookup(new, known, {c: c for c in key}, {"_old": "_old", "_known": "_known"})
    return found.withColumn(
        name,
        F.when(F.col("_known").isNull(), "new")
        .when(changed(F.col("_old"), F.col(updated_at)), "changed")
        .otherwise("same"),
    ).drop("_old", "_known")


def read_since(
    df: DataFrame, cursor: tuple[datetime, Any] | None, limit: int, updated_at: str = "updated_at", key: str = "id"
) -> DataFrame:
    """Next page after a cursor ``(updated_at, id)``, oldest first.

    The pair is a total order, so records that share a time are neither lost nor repeated. Both parts are
    constants and reach the scan. Records without a time come first, as the listing sorts them.
    """
    if cursor is not None and cursor[0] is None:
        df = df.where(F.col(updated_at).isNotNull() | (F.col(key) > F.lit(cursor[1])))
    elif cursor is not None:
        moment, last = F.lit(cursor[0]), F.lit(cursor[1])
        later = F.col(updated_at) > moment
        df = df.where((F.col(updated_at) >= moment) & (later | (F.col(key) > last)))
    return page(df, limit, 0, updated_at, key)


def next_pages(
    df: DataFrame, cursors: DataFrame, limit: int, updated_at: str = "updated_at", key: str = "id",
    scope: Sequence[str] = (REPO,),
) -> DataFrame:
    """``read_since`` for every repository at once: the next ``limit`` records of each after its own cursor.

    ``cursors`` has one row ``(scope, updated_at, key)`` per repository that was read before; a repository without one is
    read from its beginning, and one whose cursor is at its end gives no row. Records without a time come first. Each
    task keeps the first ``limit`` records of a repository before anything is shuffled, so a repository of any size sends
    one page per task.
    """
    scope = list(scope)
    places = cursors.select(*scope, F.col(updated_at).alias("_at"), F.col(key).alias("_id"), F.lit(True).alias("_begun"))
    found = lookup(df, places, {c: c for c in scope}, {"_at": "_at", "_id": "_id", "_begun": "_begun"}, hot=True)
    same, beyond = F.col(updated_at).eqNullSafe(F.col("_at")), F.col(key) > F.col("_id")
    later = F.col(updated_at).isNotNull() & (F.col("_at").isNull() | (F.col(updated_at) > F.col("_at")))
    waiting = found.where(F.col("_begun").isNull() | later | (same & beyond)).drop("_at", "_id", "_begun")
    return first_rows(waiting, scope, [F.col(updated_at), F.col(key)], limit)


def advance_cursors(
    cursors: DataFrame, pages: DataFrame, updated_at: str = "updated_at", key: str = "id", scope: Sequence[str] = (REPO,)
) -> DataFrame:
    """The cursors after ``pages`` were read: each repository's last record in the order of ``next_pages``."""
    columns = [*scope, updated_at, key]
    last = F.max(F.struct(updated_at, key)).alias("_last")  # NULL times are the smallest, as in the listing
    moved = cursors.select(*columns).unionByName(pages.select(*columns)).groupBy(*scope).agg(last)
    return moved.select(*scope, F.col(f"_last.{updated_at}").alias(updated_at), F.col(f"_last.{key}").alias(key))


def cursor_pages(
    df: DataFrame, size: int, updated_at: str = "updated_at", key: str = "id", scope: Sequence[str] = (),
    name: str = "page",
) -> DataFrame:
    """Page number of every record of the listing: what paging by cursor to the end would return, at once."""
    numbered = with_position(df, [updated_at, key], scope, "_position")
    return numbered.withColumn(name, F.floor(F.col("_position") / size).cast("long")).drop("_position")


def extract(df: DataFrame, function: Callable[..., DataFrame], *args: Any, **kwargs: Any) -> DataFrame:
    """Apply a user-given extraction to a listing: a DataFrame function, so nothing runs per row."""
    return df.transform(function, *args, **kwargs)


def overflow_union(listed: DataFrame, nested: DataFrame, key: Sequence[str] = (REPO, "id"), order: Sequence[str] = ()) -> DataFrame:
    """Events of the flat listing and events found under their parents, each id once, the listed one first."""
    both = listed.withColumn("_from", F.lit(0)).unionByName(nested.withColumn("_from", F.lit(1)), True)
    return first_per_key(both, key, [F.col("_from"), *[F.col(c) for c in order]]).drop("_from")


def cap_modifications(edits: DataFrame, limit: int, key: Sequence[str] = (REPO, "commit_sha")) -> DataFrame:
    """Edits without those of commits that modify more than ``limit`` files.

    The oversized commits are few; they are found by a partial count and taken out by an anti-join.
    """
    oversized = edits.groupBy(*key).agg(F.count("*").alias("_n")).where(F.col("_n") > limit)
    return unknown_only(edits, oversized, key)
