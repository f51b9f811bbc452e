"""Counts, summaries, first appearances and contribution shares."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repolume.fixed_values import COMMUNITY_FILES, NOT_KNOWN
from repolume.functions.ranking import with_position
from repolume.functions.scalars import owner_of, without_nulls
from repolume.operators.lookups import lookup
from repolume.schemas import REPO, TABLES


def count_rows(df: DataFrame, name: str = "rows") -> DataFrame:
    """Number of rows, 0 for an empty collection."""
    return df.agg(F.count("*").alias(name))


def count_present(df: DataFrame, column: str, name: str = "values") -> DataFrame:
    """Number of rows with a value in ``column``."""
    return df.agg(F.count(column).alias(name))


def latest(df: DataFrame, column: str = "updated_at", scope: Sequence[str] = (), name: str = "last_update") -> DataFrame:
    return df.groupBy(*scope).agg(F.max(column).alias(name))


def distinct_values(df: DataFrame, column: str, scope: Sequence[str] = ()) -> DataFrame:
    return df.where(F.col(column).isNotNull()).select(*scope, column).distinct()


def counts_per_key(sources: dict[str, DataFrame], key: str = REPO) -> DataFrame:
    """Rows per ``key`` of several tables at once: one column per table, one shuffle for all of them.

    ``sources`` maps the name of a count to a frame that has ``key``.
    """
    tagged = [df.select(key, F.lit(name).alias("_source")) for name, df in sources.items()]
    return (
        reduce(DataFrame.unionByName, tagged)
        .groupBy(key)
        .agg(*[F.count_if(F.col("_source") == name).alias(name) for name in sources])
    )


def first_appearances(
    edits: DataFrame, commits: DataFrame, files: dict[str, str] = COMMUNITY_FILES, scope: Sequence[str] = (REPO,),
    filename: str = "filename", sha: str = "commit_sha", author_date: str = "author_date",
    committed_at: str = "committed_at",
) -> DataFrame:
    """Author date of the oldest commit that touched each file, one column per file; NULL if none did.

    Only edits of the named files are shuffled, as one row of flags per commit, and the join reuses that
    shuffle. ``commits`` is the mined log, which still has the author date.
    """
    touched = (
        edits.where(F.col(filename).isin(*files.values()))
        .groupBy(*scope, sha)
        .agg(*[F.bool_or(F.col(filename) == name).alias(target) for target, name in files.items()])
    )
    dated = touched.join(commits.select(*scope, sha, author_date, committed_at), [*scope, sha])
    order = F.struct(committed_at, author_date)
    return dated.groupBy(*scope).agg(
        *[F.min_by(author_date, F.when(F.col(target), order)).alias(target) for target in files]
    )


def first_value_per_name(
    df: DataFrame, names: dict[str, str], scope: Sequence[str], column: str, value: str, order: Sequence[str]
) -> DataFrame:
    """Pivot with fixed names: ``value`` of the first row in ``order`` where ``column`` has each name."""
    first = [
        F.min_by(value, F.when(F.col(column) == name, F.struct(*order))).alias(target) for target, name in names.items()
    ]
    return df.groupBy(*scope).agg(*first)


def contributor_companies(contributors: Column, company: str = "company") -> Column:
    """Companies of a record's contributors, in listing order; contributors without one are left out."""
    return without_nulls(F.transform(F.coalesce(contributors, F.array()), lambda person: person[company]))


def list_per_parent(
    children: DataFrame, parent: Sequence[str], value: str, order: Sequence[str], chunk_size: int, name: str | None = None
) -> DataFrame:
    """The values of each parent's children in order, as arrays of ``chunk_size``: parent, ``chunk`` from 0, values.

    No child is left out. A parent with many children has many rows, so no array and no task outgrows a chunk.
    """
    placed = with_position(children.select(*dict.fromkeys([*parent, *order, value])), order, parent, "_at")
    chunk = F.floor(F.col("_at") / chunk_size).cast("long").alias("chunk")
    listed = F.array_sort(F.collect_list(F.struct("_at", F.col(value).alias("_value"))))
    values = F.transform(listed, lambda entry: entry["_value"])
    return placed.groupBy(*parent, chunk).agg(values.alias(name or value))


def contribution_share(
    edits: DataFrame, commits: DataFrame, amount: Column, scope: Sequence[str] = (REPO,), sha: str = "commit_sha",
    author: str = "author", name: str = "amount", digits: int = 9,
) -> DataFrame:
    """Share of each author in the ``amount`` of all edits of the repository.

    Edits are summed per commit first, so the join takes one row per commit and no commit is too big. A
    repository without any amount gives NULL shares.
    """
    per_commit = edits.groupBy(*scope, sha).agg(F.sum(amount).alias(name))
    owned = per_commit.join(commits.select(*scope, sha, author), [*scope, sha])
    return share_of_total(owned, [*scope, author], scope, name, digits)


def share_of_total(
    df: DataFrame, keys: Sequence[str], scope: Sequence[str], name: str, digits: int = 9
) -> DataFrame:
    """``sum(name)`` per ``keys`` and its share in the sum per ``scope`` (a part of the keys, or nothing).

    The totals come from a second, tiny aggregation instead of a window: a window would gather all authors of
    one repository in one task.
    """
    scope = list(scope)
    per_key = df.groupBy(*keys).agg(F.sum(name).alias(name))
    totals = per_key.groupBy(*scope).agg(F.sum(name).alias("_total"))
    if scope:
        # NULL-safe: a NULL scope has its total too, and no filter sets the two aggregations apart, so that
        # Spark runs them on one and the same shuffle
        side = totals.select(*[F.col(c).alias(f"_s_{c}") for c in scope], "_total")
        joined = per_key.join(side, [per_key[c].eqNullSafe(side[f"_s_{c}"]) for c in scope], "left")
    else:
        joined = per_key.withColumn("_one", F.lit(0)).join(F.broadcast(totals.withColumn("_one", F.lit(0))), "_one")
    ratio = F.round(F.try_divide(F.col(name).cast("double"), F.col("_total").cast("double")), digits)
    return joined.select(*keys, name, ratio.alias("share"))


def share_changed_lines(edits: DataFrame, commits: DataFrame, scope: Sequence[str] = (REPO,)) -> DataFrame:
    """Share of each author in the added and removed lines of a repository."""
    lines = F.coalesce("total_added_lines", F.lit(0)) + F.coalesce("total_removed_lines", F.lit(0))
    return contribution_share(edits, commits, lines, scope, name="changed_lines")


def share_edit_distance(edits: DataFrame, commits: DataFrame, scope: Sequence[str] = (REPO,)) -> DataFrame:
    """Share of each author in the edit distance of a repository."""
    return contribution_share(edits, commits, F.coalesce("levenshtein_dist", F.lit(0)), scope, name="edit_distance")


# Counted tables of the repository summary: name of the count -> source name. Review comments are what the
# summary counts as pull request reviews.
SUMMARY_COUNTS = {
    "commit_count": "commits",
    "contributor_count": "contributors",
    "tag_count": "tags",
    "pullrequest_review_count": "review_comments",
    "release_count": "releases",
    "branch_count": "branches",
    "commit_comment_count": "commit_comments",
    "labels_count": "labels",
    "milestone_count": "milestones",
    "pullrequest_count": "pull_requests",
    "workflow_count": "workflows",
    "issues_count": "issues",
    "issues_comment_count": "issue_comments",
}


def repository_summary(
    repositories: DataFrame, sources: dict[str, DataFrame], commits: DataFrame | None = None,
    edits: DataFrame | None = None, companies: bool = False,
) -> DataFrame:
    """One row per repository with the columns of the ``repository`` table.

    ``repositories`` are raw records. ``sources`` maps names of ``SUMMARY_COUNTS`` values to tables; a table
    that is not given counts 0. ``commits`` is the mined log (``committed_at``, ``author_date``), ``edits`` the
    mined edits, for the dates.
    """
    spec = TABLES["repository"]
    r = F.col
    base = repositories.select(
        F.col("full_name").alias(REPO),
        r("name").alias("repo_name"),
        F.when(r("organization").isNull(), NOT_KNOWN).otherwise(r("organization.name")).alias("organization_name"),
        F.when(r("organization").isNull(), NOT_KNOWN).otherwise(r("organization.type")).alias("repo_type"),
        owner_of(r("full_name")).alias("user_name"),
        r("created_at").alias("creation_date"),
        r("stargazers_count").alias("stars"),
        "size",
        r("url").alias("repo_url"),
        r("html_url").alias("repo_html_url"),
        F.coalesce(F.length("readme_content"), F.lit(0)).cast("long").alias("readme_length"),
        *[
            F.coalesce(r(flag), F.lit(False)).alias(flag)
            for flag in ("has_wiki", "has_pages", "has_projects", "has_downloads")
        ],
        "watchers_count",
        r("fork").alias("is_fork"),
        r("language").alias("prog_language"),
        *([contributor_companies(r("contributors")).alias("contributor_companies")] if companies else []),
    )
    key = {REPO: REPO}
    given = {name: sources[source] for name, source in SUMMARY_COUNTS.items() if source in sources}
    if given:
        base = lookup(base, counts_per_key(given), key, {name: name for name in given})
    if commits is not None:
        dates = commits.groupBy(REPO).agg(F.max("committed_at").alias("last_commit_date"))
        base = lookup(base, dates, key, {"last_commit_date": "last_commit_date"})
        if edits is not None:
            first = first_appearances(edits, commits)
            base = lookup(base, first, key, {c: c for c in COMMUNITY_FILES})
    if companies:
        base = base.withColumn("contributor_companies_count", F.size("contributor_companies").cast("long"))
    columns = []
    for field in spec.schema.fields:
        value = F.col(field.name) if field.name in base.columns else F.lit(None).cast(field.dataType)
        if field.name in SUMMARY_COUNTS or field.name == "contributor_companies_count":
            value = F.coalesce(value, F.lit(0).cast("long"))
        elif field.name == "contributor_companies":
            value = F.coalesce(value, F.array().cast("array<string>"))
        columns.append(value.alias(field.name))
    return base.select(*columns)
