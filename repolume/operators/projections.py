"""Raw records -> table rows, one ``select`` per entity.

Every function takes raw records (``schemas.RAW``) and returns the columns of its table. People are written by
``People``; fields that a record lacks are NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repolume.fixed_values import COMMIT_DROPS, COMMIT_RENAMES, DATE_PATTERN, EDIT_RENAMES
from repolume.functions.people import People, real_user_id
from repolume.functions.ranking import first_per_key, with_position
from repolume.functions.scalars import field_of
from repolume.schemas import REPO, TABLES
from repolume.session import settled

c = F.col


def _shape(df: DataFrame, table: str, **computed: Column) -> DataFrame:
    """Columns of ``table``: the computed ones, the others as they are."""
    return df.select(*[computed[n].alias(n) if n in computed else c(n) for n in TABLES[table].columns])


def issues(raw: DataFrame, people: People = People()) -> DataFrame:
    return _shape(
        raw, "issues",
        labels=field_of(c("labels"), "name"),
        assignees=people.several(c("assignees")),
        author=people.one(c("user")),
        closed_by=people.one(c("closed_by")),
        is_pull_request=c("pull_request").isNotNull(),
    )


def issue_comments(raw: DataFrame, people: People = People()) -> DataFrame:
    return _shape(raw, "issue_comments", author=people.one(c("user")))


def issue_events(raw: DataFrame, people: People = People(), issue_id: str | None = None) -> DataFrame:
    """Events of the flat listing, or (``issue_id`` names the column with the parent) events found under issues."""
    parent = c("issue.id") if issue_id is None else F.coalesce(c(issue_id), c("issue.id"))
    return _shape(
        raw, "issue_events",
        issue_id=parent,
        author=people.one(c("actor")),
        assignee=people.one(c("assignee")),
        assigner=people.one(c("assigner")),
        commit_sha=c("commit_id"),
        label=c("label.name"),
    )


def nested(raw: DataFrame, field: str, parent_id: str) -> DataFrame:
    """Records of an array field as raw records of their own, with the id of the parent."""
    return raw.select(REPO, c("id").alias(parent_id), F.posexplode(field).alias("seq", "_item")).select(
        REPO, c("seq").cast("long").alias("seq"), parent_id, "_item.*"
    )


def nested_issue_events(raw_issues: DataFrame, people: People = People()) -> DataFrame:
    return issue_events(nested(raw_issues, "events", "_issue_id"), people, "_issue_id")


def reactions(raw_parents: DataFrame, parent_name: str, people: People = People()) -> DataFrame:
    """Reactions under issues, comments or review comments."""
    found = nested(raw_parents, "reactions", "parent_id")
    return _shape(found, "issue_reactions", parent_name=F.lit(parent_name), author=people.one(c("user")))


def listed_reactions(resolved: DataFrame, people: People = People()) -> DataFrame:
    """Reactions of listings whose parents are resolved (``parent_name, parent_id``)."""
    return _shape(resolved, "issue_reactions", author=people.one(c("user")))


DEEP_COLUMNS = (
    "additions", "changed_files", "comments", "commits", "deletions", "mergeable", "mergeable_state", "merged",
    "rebaseable", "review_comments", "maintainer_can_modify", "merged_by",
)


def pull_requests(
    raw: DataFrame, people: People = People(), deep: bool = False, review_requests: bool = False, commits: bool = False
) -> DataFrame:
    """Base columns always; deep columns, requested reviewers and commit shas on demand, else NULL."""
    fields = {field.name: field.dataType for field in TABLES["pull_requests"].schema}
    computed = {
        "commits": c("commits_count"),
        "merged_by": people.one(c("merged_by")),
        "review_requested_users": people.several(c("requested_users")),
        "commit_shas": field_of(c("commits"), "sha"),
    }
    left_out = [] if deep else list(DEEP_COLUMNS)
    if not review_requests:
        left_out.append("review_requested_users")
    if not commits:
        left_out.append("commit_shas")
    computed.update({name: F.lit(None).cast(fields[name]) for name in left_out})
    return _shape(raw, "pull_requests", **computed)


def reviews(raw_pull_requests: DataFrame, people: People = People()) -> DataFrame:
    found = nested(raw_pull_requests, "reviews", "pull_request_id")
    return _shape(found, "reviews", author=people.one(c("user")))


def listed_reviews(resolved: DataFrame, people: People = People()) -> DataFrame:
    """Reviews of listings whose pull requests are resolved (``parent_id``)."""
    return _shape(resolved, "reviews", pull_request_id=c("parent_id"), author=people.one(c("user")))


def review_comments(raw: DataFrame, people: People = People()) -> DataFrame:
    return _shape(raw, "review_comments", author=people.one(c("user")), commit_sha=c("commit_id"))


def releases(raw: DataFrame, people: People = People()) -> DataFrame:
    return _shape(raw, "releases", author=people.one(c("author")))


def workflows(raw: DataFrame) -> DataFrame:
    return _shape(raw, "workflows")


def workflow_runs(raw: DataFrame) -> DataFrame:
    return _shape(
        raw, "workflow_runs",
        commit_sha=c("head_sha"),
        state=c("status"),
        pull_requests=field_of(c("pull_requests"), "id"),
    )


def tags(raw: DataFrame) -> DataFrame:
    return raw.select(REPO, "seq", c("commit.sha").alias("sha"), "name")


def commit_accounts(raw: DataFrame, people: People = People()) -> DataFrame:
    return raw.select(
        REPO, "sha", people.one(c("author")).alias("author"), people.one(c("committer")).alias("committer")
    )


def users(raw: DataFrame, people: People = People(), order: tuple[str, ...] = ("seq",)) -> DataFrame:
    """Users table out of user structs (``repo_full_name, user`` and ``order``): each user once, as first met.

    If ``seq`` alone is no total order, ``order`` names the columns that are; ``seq`` is then the user's number in it.
    """
    met = raw.where(real_user_id(c("user")).isNotNull()).select(REPO, *order, "user.*")
    once = first_per_key(met, [REPO, "node_id"], [*map(c, order), c("name"), c("email"), c("login")])
    if order != ("seq",):
        once = settled(once, "users-met").withColumnRenamed("seq", "_seq")
        names = ["_seq" if name == "seq" else name for name in order]
        once = with_position(once, [*names, "node_id"], [REPO], "seq")
    return _shape(
        once, "users",
        anonym_uuid=people.from_id(c("node_id")),
        id=c("node_id"),
        alias=F.lit(None).cast("array<string>"),
    )


def commits(mined: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Mined commits with table names, parsed times and without what the table does not hold.

    ``committer_name`` and ``branches`` stay: identities and branches are resolved from them.
    """
    dropped = [name for name in COMMIT_DROPS if name not in keep]
    renamed = mined.withColumnsRenamed(COMMIT_RENAMES).drop(*dropped)
    return renamed.withColumn("commited_at", F.to_timestamp("commited_at", DATE_PATTERN))


def commit_log(mined: DataFrame) -> DataFrame:
    """Mined commits with both dates parsed, as the repository summary needs them."""
    return mined.select(
        REPO,
        c("hash").alias("commit_sha"),
        F.to_timestamp("author_date", DATE_PATTERN).alias("author_date"),
        F.to_timestamp("committer_date", DATE_PATTERN).alias("committed_at"),
    )


def fill_numbers(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Cast columns and put 0 for missing numbers; text columns keep their NULLs."""
    return df.withColumns({name: F.coalesce(c(name), F.lit(0)).cast(kind) for name, kind in columns.items()})


def edits(mined: DataFrame) -> DataFrame:
    numbers = ("total_added_lines", "total_removed_lines", "levenshtein_dist")
    renamed = mined.withColumnsRenamed(EDIT_RENAMES)
    return fill_numbers(renamed, {name: "long" for name in numbers}).select(*TABLES["edits"].columns)
