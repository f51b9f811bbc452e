"""Tags and branches of commits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repolume.functions.ranking import with_position
from repolume.functions.scalars import split_list
from repolume.operators.lookups import array_lookup, lookup
from repolume.schemas import REPO
from repolume.session import settled


def add_tags(
    commits: DataFrame, tags: DataFrame, scope: Sequence[str] = (REPO,), sha: str = "commit_sha",
    order: Sequence[str] = ("seq",),
) -> DataFrame:
    """Add ``tag``: the last listed tag that points at the commit, ``''`` without one.

    ``tags`` has ``sha``, ``name`` and the listing order.
    """
    last = tags.groupBy(*scope, "sha").agg(F.max_by("name", F.struct(*order)).alias("name"))
    found = lookup(commits, last, {**{name: name for name in scope}, sha: "sha"}, {"name": "tag"})
    return found.withColumn("tag", F.coalesce("tag", F.lit("")))


def branch_names(
    commits: DataFrame, column: str = "branches", scope: Sequence[str] = (REPO,), separator: str = ","
) -> DataFrame:
    """Distinct branch names of the comma lists. The lists repeat a lot, so they are made distinct first."""
    lists = commits.where(F.col(column).isNotNull()).select(*scope, column).distinct()
    return lists.select(*scope, F.explode(split_list(F.col(column), separator)).alias("branch_names")).distinct()


def branch_dictionary(
    commits: DataFrame, column: str = "branches", scope: Sequence[str] = (REPO,), separator: str = ","
) -> DataFrame:
    """``branch_names``, numbered from 0 by name inside each repository.

    The names are few beside the commits: they are settled before they are numbered, so the commits are read once.
    """
    names = settled(branch_names(commits, column, scope, separator), "branch-names")
    return with_position(names, ["branch_names"], scope, "id").select(*scope, "id", "branch_names")


def encode_branches(
    commits: DataFrame, branches: DataFrame, column: str = "branches", target: str = "branch_ids",
    scope: Sequence[str] = (REPO,), separator: str = ",",
) -> DataFrame:
    """Comma list -> array of branch ids, in list order."""
    listed = commits.withColumn("_branches", split_list(F.col(column), separator))
    return array_lookup(listed, branches, "_branches", target, scope, "branch_names", "id").drop("_branches")
