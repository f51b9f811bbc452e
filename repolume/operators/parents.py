"""Records that are listed under a parent: which record a review or reaction belongs to."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repolume.operators.lookups import lookup
from repolume.schemas import REPO


def parent_kind(parent: Column) -> Column:
    """``issue``, ``comment``, ``review_comment`` or ``pull_request``: as the listing says, else as its url tells; NULL
    if neither does. ``issue_comment`` is another name of ``comment``."""
    url = parent["url"]
    told = (
        F.when(url.contains("/issues/comments/"), "comment")
        .when(url.contains("/pulls/comments/"), "review_comment")
        .when(url.contains("/pulls/"), "pull_request")
        .when(url.contains("/issues/"), "issue")
    )
    return F.when(parent["kind"] == "issue_comment", "comment").otherwise(F.coalesce(parent["kind"], told))


def with_parents(children: DataFrame, numbered: dict[str, DataFrame]) -> DataFrame:
    """``children`` with ``parent_name`` and ``parent_id`` in place of ``parent`` (kind, id, url).

    An id that the listing names is taken. Otherwise the url ends in one: the id itself for comments, the number for
    issues and pull requests, whose id is looked up in ``numbered`` (kind -> ``repo_full_name, number, id``). A
    reference that leads nowhere gives a NULL id; no child is dropped. Children that need no lookup are not shuffled,
    and a parent with any number of children is split, since every parent has one id.
    """
    parent = F.col("parent")
    end = F.nullif(F.regexp_extract(parent["url"], "/([0-9]+)/?$", 1), F.lit("")).cast("long")
    kind = parent_kind(parent)
    by_number = kind.isin("issue", "pull_request")
    rest = [name for name in children.columns if name != "parent"]
    referring = children.select(
        *rest,
        kind.alias("parent_name"),
        F.coalesce(parent["id"], F.when(~by_number, end)).alias("parent_id"),
        F.when(by_number & parent["id"].isNull(), end).alias("_number"),
    )
    direct = referring.where(F.col("_number").isNull())
    if not numbered:
        return referring.drop("_number")
    pool = reduce(
        DataFrame.unionByName,
        [df.select(REPO, F.lit(kind).alias("kind"), "number", "id") for kind, df in numbered.items()],
    )
    # of two records with one number (a repository made anew) the one with the larger, later id
    once = pool.groupBy(REPO, "kind", "number").agg(F.max("id").alias("id"))
    on = {REPO: REPO, "parent_name": "kind", "_number": "number"}
    found = lookup(referring.where(F.col("_number").isNotNull()), once, on, {"id": "parent_id"}, hot=True)
    return direct.unionByName(found).drop("_number")
