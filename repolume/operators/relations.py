"""Joins along the foreign keys of the tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repolume.functions.scalars import url_number, url_repository
from repolume.operators.filters import pull_requests_only
from repolume.operators.lookups import known_only, lookup, unknown_only
from repolume.schemas import REPO


@dataclass(frozen=True)
class Relation:
    """``child.column`` refers to ``parent.key``; ``array`` marks a column that holds many references."""

    child: str
    column: str
    parent: str
    key: str
    array: bool = False
    when: str | None = None

    @property
    def name(self) -> str:
        return f"{self.child}.{self.column}->{self.parent}.{self.key}"


def _reaction(child: str, parent: str, label: str) -> Relation:
    return Relation(child, "parent_id", parent, "id", when=f"parent_name = '{label}'")


RELATIONS = (
    Relation("issue_comments", "issue_url", "issues", "url"),
    Relation("issue_events", "issue_id", "issues", "id"),
    Relation("issue_events", "commit_sha", "commits", "commit_sha"),
    _reaction("issue_reactions", "issues", "issue"),
    _reaction("issue_reactions", "issue_comments", "comment"),
    _reaction("pull_request_reactions", "review_comments", "review_comment"),
    Relation("review_comments", "pull_request_url", "pull_requests", "url"),
    Relation("review_comments", "commit_sha", "commits", "commit_sha"),
    Relation("reviews", "pull_request_id", "pull_requests", "id"),
    Relation("pull_requests", "number", "issues", "number"),
    Relation("pull_requests", "merge_commit_sha", "commits", "commit_sha"),
    Relation("pull_requests", "commit_shas", "commits", "commit_sha", array=True),
    Relation("workflow_runs", "workflow_id", "workflows", "id"),
    Relation("workflow_runs", "commit_sha", "commits", "commit_sha"),
    Relation("workflow_runs", "pull_requests", "pull_requests", "id", array=True),
    Relation("edits", "commit_sha", "commits", "commit_sha"),
    Relation("commits", "branch_ids", "branches", "id", array=True),
    *[
        Relation(child, column, "users", "anonym_uuid")
        for child, column in (
            ("issues", "author"), ("issues", "closed_by"), ("issue_comments", "author"), ("issue_events", "author"),
            ("issue_events", "assignee"), ("issue_events", "assigner"), ("issue_reactions", "author"),
            ("pull_requests", "merged_by"), ("reviews", "author"), ("review_comments", "author"),
            ("pull_request_reactions", "author"), ("releases", "author"), ("commits", "author"),
            ("commits", "committer"),
        )
    ],
    Relation("issues", "assignees", "users", "anonym_uuid", array=True),
    Relation("pull_requests", "review_requested_users", "users", "anonym_uuid", array=True),
)


def _reference(relation: Relation) -> Callable[[Column], Column]:
    target = f"{relation.parent}.{relation.key}"
    return lambda value: F.struct(
        F.lit(relation.name).alias("relation"), F.lit(target).alias("target"), value.cast("string").alias("key")
    )


def audit(
    tables: dict[str, DataFrame], relations: Sequence[Relation] = RELATIONS, scope: Sequence[str] = (REPO,)
) -> DataFrame:
    """Number of references of every relation between the given tables and how many of them have no parent.

    Every table is read once on each side: a child row unfolds to all its references, a parent row to all its keys.
    References are counted per key before the join, so a key that fills a child table travels as one row.
    """
    scope = list(scope)
    checked = [r for r in relations if r.child in tables and r.parent in tables]
    references, keys = [], []
    for child in dict.fromkeys(r.child for r in checked):
        found = []
        for relation in (r for r in checked if r.child == child):
            values = F.col(relation.column) if relation.array else F.array(relation.column)
            if relation.when:
                values = F.when(F.expr(relation.when), values)
            found.append(F.transform(F.coalesce(F.array_compact(values), F.array()), _reference(relation)))
        references.append(tables[child].select(*scope, F.inline(F.concat(*found))))
    for parent in dict.fromkeys(r.parent for r in checked):
        names = dict.fromkeys(r.key for r in checked if r.parent == parent)
        entries = F.array(
            *(F.struct(F.lit(f"{parent}.{name}").alias("target"), F.col(name).cast("string").alias("key")) for name in names)
        )
        keys.append(tables[parent].select(*scope, F.inline(entries)).where("key IS NOT NULL"))
    on = [*scope, "target", "key"]
    counted = reduce(DataFrame.unionByName, references).groupBy(*on, "relation").agg(F.count("*").alias("_n"))
    present = reduce(DataFrame.unionByName, keys).groupBy(*on).agg(F.lit(True).alias("_found"))
    sums = counted.join(present, on, "left").groupBy("relation").agg(
        F.sum("_n").alias("_refs"), F.sum(F.when(F.col("_found").isNull(), F.col("_n"))).alias("_orphans")
    )
    # one row for every relation, also for those without references
    names = sums.sparkSession.createDataFrame([(r.name,) for r in checked], "relation string")
    zero = lambda name: F.coalesce(f"_{name}", F.lit(0)).cast("long").alias(name)
    return names.join(sums, "relation", "left").select("relation", zero("refs"), zero("orphans"))


def flagged_pull_requests(pull_requests: DataFrame, issues: DataFrame, scope: Sequence[str] = (REPO,)) -> DataFrame:
    """Pull requests whose number is an issue flagged as one."""
    return known_only(pull_requests, pull_requests_only(issues), [*scope, "number"])


def missing_issues(pull_requests: DataFrame, issues: DataFrame, scope: Sequence[str] = (REPO,)) -> DataFrame:
    """Pull requests without their issue: those issues have to be built first."""
    return unknown_only(pull_requests, pull_requests_only(issues), [*scope, "number"])


def issues_complete(pull_requests: DataFrame, issues: DataFrame) -> DataFrame:
    """One row: flagged issues, pull requests, and whether the issues suffice."""
    flagged = issues.agg(F.count_if("is_pull_request").alias("issues"), F.lit(0).cast("long").alias("pulls"))
    pulls = pull_requests.agg(F.lit(0).cast("long").alias("issues"), F.count("*").alias("pulls"))
    both = flagged.unionByName(pulls).agg(F.sum("issues").alias("flagged_issues"), F.sum("pulls").alias("pull_requests"))
    return both.withColumn("complete", F.col("flagged_issues") >= F.col("pull_requests"))


ISSUE_PART = ("title", "body", "state", "labels", "assignees", "author", "closed_by", "created_at", "closed_at", "locked")


def complete_pull_requests(
    pull_requests: DataFrame, issues: DataFrame, columns: Sequence[str] = ISSUE_PART, scope: Sequence[str] = (REPO,)
) -> DataFrame:
    """Pull requests with the columns that only their issue carries."""
    on = {**{name: name for name in scope}, "number": "number"}
    return lookup(pull_requests, pull_requests_only(issues), on, {c: c for c in columns}, "inner", hot=True)


def child_with_parent(
    child: DataFrame, parent: DataFrame, column: str, key: str, take: dict[str, str], scope: Sequence[str] = (REPO,),
    how: str = "left",
) -> DataFrame:
    """Child rows with columns of the parent they refer to (parents are unique on ``key``)."""
    return lookup(child, parent, {**{name: name for name in scope}, column: key}, take, how, hot=True)


def comments_with_issue(comments: DataFrame, issues: DataFrame, take: dict[str, str]) -> DataFrame:
    return child_with_parent(comments, issues, "issue_url", "url", take)


def review_comments_with_pull_request(comments: DataFrame, pull_requests: DataFrame, take: dict[str, str]) -> DataFrame:
    return child_with_parent(comments, pull_requests, "pull_request_url", "url", take)


def events_with_issue(events: DataFrame, issues: DataFrame, take: dict[str, str]) -> DataFrame:
    return child_with_parent(events, issues, "issue_id", "id", take)


def events_with_commit(events: DataFrame, commits: DataFrame, take: dict[str, str]) -> DataFrame:
    return child_with_parent(events, commits, "commit_sha", "commit_sha", take)


def reviews_with_pull_request(reviews: DataFrame, pull_requests: DataFrame, take: dict[str, str]) -> DataFrame:
    return child_with_parent(reviews, pull_requests, "pull_request_id", "id", take)


def runs_with_workflow(runs: DataFrame, workflows: DataFrame, take: dict[str, str]) -> DataFrame:
    return child_with_parent(runs, workflows, "workflow_id", "id", take)


def runs_with_commit(runs: DataFrame, commits: DataFrame, take: dict[str, str]) -> DataFrame:
    return child_with_parent(runs, commits, "commit_sha", "commit_sha", take)


def edits_with_commit(edits: DataFrame, commits: DataFrame, take: dict[str, str]) -> DataFrame:
    return child_with_parent(edits, commits, "commit_sha", "commit_sha", take)


def reactions_with_parent(
    reactions: DataFrame, parents: dict[str, DataFrame], take: dict[str, str], scope: Sequence[str] = (REPO,)
) -> DataFrame:
    """Reactions with columns of their parent, whichever table it is in. ``parents``: parent_name -> table."""
    scope = list(scope)
    pool = reduce(
        DataFrame.unionByName,
        [
            df.select(*scope, F.lit(label).alias("parent_name"), F.col("id").alias("parent_id"), *take)
            for label, df in parents.items()
        ],
    )
    on = {name: name for name in [*scope, "parent_name", "parent_id"]}
    return lookup(reactions, pool, on, take, hot=True)


def join_by_array(
    df: DataFrame, parent: DataFrame, array: str, key: str, take: dict[str, str], item: str = "item",
    scope: Sequence[str] = (REPO,), how: str = "inner",
) -> DataFrame:
    """One row per array element, with the columns of the parent the element refers to."""
    rest = [c for c in df.columns if c != array]
    items = df.select(*rest, F.explode(array).alias(item))
    return lookup(items, parent, {**{name: name for name in scope}, item: key}, take, how, hot=True)


def with_url_key(df: DataFrame, url: str, number: str = "parent_number", repository: str | None = None) -> DataFrame:
    """Natural key out of a url: the number at its end and, when asked, the repository."""
    df = df.withColumn(number, url_number(F.col(url)))
    return df.withColumn(repository, url_repository(F.col(url))) if repository else df
