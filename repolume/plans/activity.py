"""All tables out of landed pages and mined logs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repolume.fixed_values import REACTION_PARENTS
from repolume.functions.people import People
from repolume.functions.ranking import first_per_key
from repolume.operators import projections
from repolume.operators.aggregates import repository_summary
from repolume.operators.enrich import branch_names
from repolume.operators.incremental import overflow_union, upsert
from repolume.operators.lookups import known_only, unknown_only
from repolume.operators.parents import parent_kind, with_parents
from repolume.operators.setops import union_tagged
from repolume.plans.selection import TableSelection
from repolume.plans.versions import version_tables
from repolume.schemas import LISTED_UNDER, REPO, TABLES
from repolume.session import discard, settled
from repolume.sinks.tables import append_users, buckets_of, save_table
from repolume.sources.tables import read_table

ISSUE, COMMENT, REVIEW_COMMENT = REACTION_PARENTS

# Raw entity -> its user fields (plain, then arrays).
_USER_FIELDS = {
    "issue": (("user", "closed_by"), ("assignees",)),
    "issue_comment": (("user",), ()),
    "issue_event": (("actor", "assignee", "assigner"), ()),
    "pull_request": (("merged_by",), ("requested_users",)),
    "review_comment": (("user",), ()),
    "release": (("author",), ()),
    "commit_account": (("author", "committer"), ()),
    "listed_review": (("user",), ()),
    "listed_issue_reaction": (("user",), ()),
    "listed_pull_reaction": (("user",), ()),
}
# Raw entity -> array of nested records -> their user fields.
_NESTED_USERS = {
    "issue": {"reactions": ("user",), "events": ("actor", "assignee", "assigner")},
    "issue_comment": {"reactions": ("user",)},
    "pull_request": {"reviews": ("user",)},
    "review_comment": {"reactions": ("user",)},
}


# Order in which users are met.
MET = ("entity", "seq", "position")


def met_users(raw: dict[str, DataFrame]) -> DataFrame:
    """``repo_full_name, entity, seq, position, user`` for every user struct of the given raw entities.

    Entity, record and position inside the record are a total order of the structs of a repository.
    """
    found = []
    for rank, (entity, (plain, arrays)) in enumerate(_USER_FIELDS.items()):
        if entity not in raw:
            continue
        df = raw[entity]
        structs = [F.array(*plain)] if plain else []
        lists = [F.coalesce(F.col(name), F.array()) for name in arrays]
        for nested, names in _NESTED_USERS.get(entity, {}).items():
            lists += [F.coalesce(F.col(f"{nested}.{name}"), F.array()) for name in names]
        if structs or lists:
            listed = F.posexplode(F.concat(*structs, *lists)).alias("position", "user")
            found.append(df.select(REPO, F.lit(rank).alias("entity"), "seq", listed))
    return reduce(DataFrame.unionByName, found)


def attach_parents(raw: dict[str, DataFrame], stored: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """``raw`` with the reviews and reactions of listings led to their parents.

    ``review`` becomes ``listed_review``; ``reaction`` becomes ``listed_pull_reaction`` (under review comments and pull
    requests) and ``listed_issue_reaction`` (all others, those without a parent too). Parents are found by number
    among the landed issues and pull requests and, if given, among the ``stored`` ones.
    """
    numbered = {}
    for kind in ("issue", "pull_request"):
        known = [df.select(REPO, "number", "id") for df in (raw.get(kind), (stored or {}).get(kind)) if df is not None]
        if known:
            numbered[kind] = reduce(DataFrame.unionByName, known)
    out = {entity: df for entity, df in raw.items() if entity not in LISTED_UNDER}
    if "review" in raw:
        # a review can only be under a pull request, whatever its listing says
        under = F.struct(F.lit("pull_request").alias("kind"), F.col("parent.id").alias("id"), F.col("parent.url").alias("url"))
        out["listed_review"] = with_parents(raw["review"].withColumn("parent", under), numbered)
    if "reaction" in raw:
        pull = parent_kind(F.col("parent")).isin(REVIEW_COMMENT, "pull_request")
        for entity, mine in (("listed_issue_reaction", ~F.coalesce(pull, F.lit(False))), ("listed_pull_reaction", pull)):
            out[entity] = with_parents(raw["reaction"].where(mine), numbered)
    return out


# Table of nested records -> raw entities they are nested in, by the name of the parent -> raw entity of the listing.
_CHILD_TABLES = {
    "issue_reactions": ({ISSUE: "issue", COMMENT: "issue_comment"}, "listed_issue_reaction"),
    "pull_request_reactions": ({REVIEW_COMMENT: "review_comment"}, "listed_pull_reaction"),
    "reviews": ({"pull_request": "pull_request"}, "listed_review"),
}


def child_table(name: str, raw: dict[str, DataFrame], people: People = People()) -> DataFrame | None:
    """Reactions or reviews, from under their parents and from listings of their own; each once, the listed one if there
    are both. None if nothing they come from is in ``raw``."""
    hosts, listing = _CHILD_TABLES[name]
    columns = TABLES[name].columns
    parts = {label: raw[entity] for label, entity in hosts.items() if entity in raw}
    nested = listed = None
    if parts and name == "reviews":
        nested = projections.reviews(raw["pull_request"], people)
    elif parts:
        found = {label: projections.reactions(df, label, people).drop("parent_name") for label, df in parts.items()}
        nested = union_tagged(found).select(*columns)
    if listing in raw:
        project = projections.listed_reviews if name == "reviews" else projections.listed_reactions
        listed = project(raw[listing], people)
    if nested is None or listed is None:
        return nested if listed is None else listed
    key = key_of(name)
    return overflow_union(listed, nested, key, [column for column in columns if column not in key])


# Counted listing of the repository summary -> raw entity.
_COUNTED = {
    "issues": "issue", "issue_comments": "issue_comment", "pull_requests": "pull_request",
    "review_comments": "review_comment", "releases": "release", "workflows": "workflow", "tags": "tag",
    "labels": "label", "milestones": "milestone", "contributors": "contributor", "commit_comments": "commit_comment",
}


def summary_sources(raw: dict[str, DataFrame], mined_commits: DataFrame | None = None) -> dict[str, DataFrame]:
    """What the repository summary counts: all that was landed, whatever tables are selected."""
    sources = {name: raw[entity] for name, entity in _COUNTED.items() if entity in raw}
    if mined_commits is not None:
        sources["commits"] = mined_commits
        sources["branches"] = branch_names(mined_commits)
    return sources


def build_tables(
    raw: dict[str, DataFrame], selection: TableSelection | None = None, people: People = People(),
    mined_commits: DataFrame | None = None, mined_edits: DataFrame | None = None, users: DataFrame | None = None,
    counted: dict[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """The selected tables as lazy DataFrames.

    ``raw`` holds raw records by entity name; an entity that is absent gives no table. Events may be landed as
    a flat listing, under their issues, or both, as may reviews and reactions. ``users`` are stored users (their aliases
    resolve commits); ``counted`` are the listings of the repository summary if they are more than ``raw``.
    """
    if any(entity in raw for entity in LISTED_UNDER):
        raw = attach_parents(raw)
    selection = selection or TableSelection()
    wanted = selection.tables()
    pulls = selection.pull_requests
    tables: dict[str, DataFrame] = {}

    def build(table: str, entity: str, make) -> None:
        if table in wanted and entity in raw:
            tables[table] = make(raw[entity])

    known = [entity for entity in raw if entity in _USER_FIELDS]
    if known:
        tables["users"] = projections.users(met_users({entity: raw[entity] for entity in known}), people, MET)
    build("releases", "release", lambda df: projections.releases(df, people))
    build("issues", "issue", lambda df: projections.issues(df, people))
    build("issue_comments", "issue_comment", lambda df: projections.issue_comments(df, people))
    if "issue_events" in wanted:
        listed = projections.issue_events(raw["issue_event"], people) if "issue_event" in raw else None
        under = projections.nested_issue_events(raw["issue"], people) if "issue" in raw else None
        if listed is not None and under is not None:
            tables["issue_events"] = overflow_union(listed, under, order=("issue_id",))
        elif listed is not None or under is not None:
            tables["issue_events"] = listed if under is None else under
    for name in _CHILD_TABLES:
        table = child_table(name, raw, people) if name in wanted else None
        if table is not None:
            tables[name] = table
    build(
        "pull_requests", "pull_request",
        lambda df: projections.pull_requests(df, people, pulls.deep, pulls.review_requests, pulls.commits),
    )
    build("review_comments", "review_comment", lambda df: projections.review_comments(df, people))
    build("workflows", "workflow", projections.workflows)
    build("workflow_runs", "workflow_run", projections.workflow_runs)

    if "commits" in wanted and mined_commits is not None and mined_edits is not None:
        accounts = projections.commit_accounts(raw["commit_account"], people)
        resolving = users if users is not None else tables["users"]
        tables.update(
            version_tables(mined_commits, mined_edits, accounts, resolving, projections.tags(raw["tag"]))
        )
    if "repository" in wanted and "repository" in raw:
        sources = summary_sources(raw, mined_commits) if counted is None else counted
        log = projections.commit_log(mined_commits) if mined_commits is not None else None
        edits = projections.edits(mined_edits) if mined_edits is not None else None
        tables["repository"] = repository_summary(
            raw["repository"], sources, log, edits, selection.repository.contributor_companies
        )
    return tables


# Tables whose records carry an update time, so a refresh can be laid over what is stored.
_UPDATED = {
    "issues": "updated_at", "issue_comments": "updated_at", "pull_requests": "updated_at",
    "review_comments": "updated_at", "workflows": "updated_at", "workflow_runs": "updated_at",
}


def save_all(tables: dict[str, DataFrame], root: str) -> None:
    """Replace the stored tables of the repositories at hand; add the users not known yet."""
    for name, df in tables.items():
        if name == "users":
            append_users(df, root)
        else:
            save_table(df, root, name)


# Tables whose rows are told apart by other columns than their key alone.
_KEYS = {
    "issue_reactions": ("parent_name", "parent_id", "id"), "pull_request_reactions": ("parent_name", "parent_id", "id"),
}
# Tables that a part of a landing cannot be laid over.
_WHOLE = ("users", "commits", "edits", "branches", "repository")


def key_of(table: str) -> tuple[str, ...]:
    """The columns that tell the records of a table apart."""
    return (REPO, *_KEYS.get(table, (TABLES[table].key,)))


def updated_column(table: str) -> str | None:
    """The column with the update time of a table's records, if they have one."""
    return _UPDATED.get(table)


def merge_table(landed: DataFrame, root: str, table: str) -> None:
    """Lay ``landed`` rows of a table over the stored ones. Only the buckets of their repositories are read and written;
    doing it twice gives the same table."""
    spark = landed.sparkSession
    landed = settled(landed.select(*TABLES[table].columns), f"merge-{table}")
    touched = landed.select(REPO).distinct()
    stored = read_table(spark, root, table, buckets=buckets_of(touched))
    save_table(refresh(table, known_only(stored, touched, [REPO]), landed), root, table, touched)
    discard(landed)


def refresh(table: str, stored: DataFrame, landed: DataFrame) -> DataFrame:
    """Stored rows with a partial landing laid over them: the newest version of each record, or the landed one of
    records that have no update time."""
    if table in _WHOLE:
        raise ValueError(f"{table} is built from whole landings")
    key = key_of(table)
    if table in _KEYS:
        # a reaction that came before its parent was known has found it now
        lost = F.col("parent_id").isNull()
        found = landed.where(~lost)
        stored = stored.where(~lost).unionByName(unknown_only(stored.where(lost), found, [REPO, "parent_name", "id"]))
    if table in _UPDATED:
        return upsert(stored, landed, key, _UPDATED[table])
    both = stored.withColumn("_is_new", F.lit(0)).unionByName(landed.withColumn("_is_new", F.lit(1)), True)
    order = [F.col("_is_new").desc(), F.xxhash64(*landed.columns)]
    return first_per_key(both, key, order).drop("_is_new")


def cursors(table: str, stored: DataFrame) -> DataFrame:
    """Per repository the last update time and id of a stored table: where paging by cursor goes on."""
    time, key = _UPDATED[table], TABLES[table].key
    last = stored.groupBy(REPO).agg(F.max(F.struct(time, key)).alias("_last"))
    return last.select(REPO, F.col(f"_last.{time}").alias("updated_at"), F.col(f"_last.{key}").alias("id"))
