"""Row filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repolume.functions.scalars import contains_any
from repolume.operators.lookups import unknown_only
from repolume.schemas import REPO


def pull_requests_only(issues: DataFrame, flag: str = "is_pull_request") -> DataFrame:
    return issues.where(F.col(flag))


def present(df: DataFrame, column: str) -> DataFrame:
    """Rows with a value in ``column``."""
    return df.where(F.col(column).isNotNull())


def equal_or_rest(df: DataFrame, column: str, value: str, flag: str = "is_equal") -> DataFrame:
    """Mark the rows where ``column`` is ``value`` against the rest; a missing value belongs to the rest."""
    return df.withColumn(flag, F.coalesce(F.col(column) == value, F.lit(False)))


def select_repositories(
    df: DataFrame, whitelist: Sequence[str] | None = None, blacklist: Sequence[str] | None = None, column: str = "name"
) -> DataFrame:
    """Keep names that contain a whitelist pattern and no blacklist pattern.

    Patterns are case-sensitive substrings; an absent or empty list does not restrict.
    """
    name = F.col(column)
    if whitelist:
        df = df.where(contains_any(name, whitelist))
    if blacklist:
        df = df.where(~contains_any(name, blacklist))
    return df


def clean_branch_names(refs: DataFrame, column: str = "ref", scope: Sequence[str] = (REPO,)) -> DataFrame:
    """Branch names of a repository out of its refs.

    Local heads come first; remote heads follow unless the branch is local already, and ``HEAD`` is no branch.
    Adds ``branch`` and ``is_local``; other refs are dropped.
    """
    scope = list(scope)
    local_prefix, remote_prefix = "refs/heads/", "refs/remotes/origin/"
    ref = F.col(column)
    local = refs.where(ref.startswith(local_prefix)).select(
        *scope, F.replace(ref, F.lit(local_prefix), F.lit("")).alias("branch")
    )
    remote = (
        refs.where(ref.startswith(remote_prefix))
        .select(*scope, F.replace(ref, F.lit(remote_prefix), F.lit("")).alias("branch"))
        .where(F.col("branch") != "HEAD")
    )
    tracked = unknown_only(remote.distinct(), local, [*scope, "branch"])
    return local.distinct().withColumn("is_local", F.lit(True)).unionByName(
        tracked.withColumn("is_local", F.lit(False))
    )
