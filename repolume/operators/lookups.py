"""Equi-join lookups.

No lookup is hinted as a broadcast: the users of all repositories grow with the data. Spark measures the side
at run time and broadcasts it below its threshold; above it the fact side of a hot key is split, which is
exact because every lookup side is unique on its key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _splittable(keys: Sequence[Column]) -> Column:
    """A further join key that is always 0.

    Spark splits a hot key only where both sides of the join are shuffled for that join. A side that was
    aggregated by the same key is partitioned already and would not be shuffled again; this key, which the
    aggregation does not have, makes it.
    """
    return F.pmod(F.xxhash64(*keys), F.lit(1))


def _condition(left: Sequence[Column], right: Sequence[Column], hot: bool) -> list[Column]:
    pairs = [a == b for a, b in zip(left, right)]
    return [*pairs, _splittable(left) == _splittable(right)] if hot else pairs


def lookup(
    df: DataFrame, dimension: DataFrame, on: dict[str, str], take: dict[str, str], how: str = "left", hot: bool = False
) -> DataFrame:
    """Add columns of ``dimension`` (unique on its key) to ``df``.

    ``on`` maps columns of ``df`` to key columns, ``take`` maps columns of ``dimension`` to new names. A new
    name that exists already is replaced. ``hot`` says that one key may hold a large part of ``df``; lookups
    by a unique key leave it off, so that several of them share one shuffle.
    """
    side = dimension.select(
        *[F.col(key).alias(f"_k{i}") for i, key in enumerate(on.values())],
        *[F.col(source).alias(f"_v{i}") for i, source in enumerate(take)],
    )
    keys = [side[f"_k{i}"] for i in range(len(on))]
    joined = df.join(side, _condition([df[column] for column in on], keys, hot), how)
    taken = {name: F.col(f"_v{i}") for i, name in enumerate(take.values())}
    kept = [taken.pop(column).alias(column) if column in taken else df[column] for column in df.columns]
    return joined.select(*kept, *[value.alias(name) for name, value in taken.items()])


def user_lookup(
    df: DataFrame, users: DataFrame, column: str, target: str, scope: Sequence[str] = (), key: str = "id",
    value: str = "anonym_uuid",
) -> DataFrame:
    """Source user id -> stored pseudonym; NULL for no user or a user that is not stored."""
    on = {**{name: name for name in scope}, column: key}
    return lookup(df, users, on, {value: target}, hot=True)


def array_lookup(
    df: DataFrame, dimension: DataFrame, column: str, target: str, scope: Sequence[str] = (), key: str = "id",
    value: str = "anonym_uuid",
) -> DataFrame:
    """Map every element of an array, keeping order and length; unknown elements become NULL.

    Only the distinct arrays are unpacked and packed again, since the same few lists (assignees, branches)
    repeat over many rows. An absent array reads as an empty one.
    """
    scope = list(scope)
    items = df.where(F.size(column) > 0).select(*scope, F.col(column).alias("_items")).distinct()
    exploded = items.select(*scope, "_items", F.posexplode("_items").alias("_pos", "_item"))
    mapped = (
        lookup(exploded, dimension, {**{name: name for name in scope}, "_item": key}, {value: "_value"}, hot=True)
        .groupBy(*scope, "_items")
        .agg(F.array_sort(F.collect_list(F.struct("_pos", "_value"))).alias("_pairs"))
        .select(*scope, "_items", F.transform("_pairs", lambda pair: pair["_value"]).alias("_mapped"))
    )
    on = {**{name: name for name in scope}, column: "_items"}
    out = lookup(df, mapped, on, {"_mapped": target}, hot=True)
    empty = F.array().cast(mapped.schema["_mapped"].dataType)
    return out.withColumn(target, F.coalesce(target, empty))


def replace_users(
    df: DataFrame, users: DataFrame, scalars: Sequence[str] = (), arrays: Sequence[str] = (), scope: Sequence[str] = ()
) -> DataFrame:
    """Replace source user ids by stored pseudonyms in any table; the users table stays the only link."""
    order = df.columns
    for column in scalars:
        df = user_lookup(df, users, column, column, scope)
    for column in arrays:
        df = array_lookup(df, users, column, column, scope)
    return df.select(*order)


def commit_accounts(
    commits: DataFrame, accounts: DataFrame, scope: Sequence[str] = (), sha: str = "commit_sha"
) -> DataFrame:
    """Add ``author`` and ``committer`` of the commit's accounts; NULL where the commit has none."""
    on = {**{name: name for name in scope}, sha: "sha"}
    return lookup(commits, accounts, on, {"author": "author", "committer": "committer"})


def _membership(df: DataFrame, known: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    # the keys are made distinct first: a semi or anti join cannot split a key that fills its right side
    side = known.select(*[F.col(key).alias(f"_k{i}") for i, key in enumerate(keys)]).distinct()
    return df.join(side, _condition([df[key] for key in keys], [side[name] for name in side.columns], True), how)


def unknown_only(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``known``."""
    return _membership(df, known, keys, "left_anti")


def known_only(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is in ``known``."""
    return _membership(df, known, keys, "left_semi")
