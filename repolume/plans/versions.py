"""Commits, edits and branches out of the mined logs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repolume.functions.ranking import first_per_key, with_position
from repolume.operators import projections
from repolume.operators.enrich import add_tags, branch_dictionary, branch_names, encode_branches
from repolume.operators.identity import assign_unknown_users, resolve, resolve_commits
from repolume.operators.lookups import known_only, lookup, unknown_only
from repolume.schemas import LONG, REPO, STRING, TABLES, struct
from repolume.session import discard, settled
from repolume.sinks.tables import buckets_of, save_state, save_together
from repolume.sources.tables import read_bucketed, read_table


def version_tables(
    mined_commits: DataFrame, mined_edits: DataFrame, accounts: DataFrame, users: DataFrame, tags: DataFrame,
    scope: Sequence[str] = (REPO,), mode: str = "representative",
) -> dict[str, DataFrame]:
    """Shape, resolve identities, add tags, encode branches.

    Everything is worked out on a slim frame of the commits. The full rows, messages included, are shuffled
    once, by their unique sha, to take up the result.
    """
    scope = list(scope)
    commits = projections.commits(mined_commits)
    slim = commits.select(*scope, "commit_sha", "seq", "committer_name", "branches")
    # tags and accounts are both found by sha: one shuffle serves them
    resolved = resolve_commits(add_tags(slim, tags, scope), accounts, users, scope, mode=mode)
    branches = branch_dictionary(slim, "branches", scope)
    found = encode_branches(resolved, branches, "branches", "branch_ids", scope)
    added = ["author", "committer", "unknown_user", "tag", "branch_ids"]
    full = lookup(commits, found, {c: c for c in [*scope, "commit_sha"]}, {c: c for c in added})
    return {
        "commits": full.select(*TABLES["commits"].columns),
        "edits": projections.edits(mined_edits),
        "branches": branches,
    }


# What is kept of every commit beside the tables, so that a later part of a log can be resolved together with it.
COMMIT_STATE = struct(
    repo_full_name=STRING, commit_sha=STRING, seq=LONG, committer_name=STRING, branches=STRING, author=STRING,
    committer=STRING, tag=STRING,
)


def state_path(root: str) -> str:
    return f"{root.rstrip('/')}/{TABLES['commits'].folder}/commit_state"


def commit_state(mined_commits: DataFrame, accounts: DataFrame, tags: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """``COMMIT_STATE`` of the mined commits: their own accounts, not yet resolved, and their tag.

    With ``stored`` state, landed commits are laid over it, and accounts and tags that land later reach the commits
    that are stored already; what lands nothing new for a commit leaves it as it is.
    """
    slim = projections.commits(mined_commits).select(REPO, "commit_sha", "seq", "committer_name", "branches")
    if stored is not None:
        own = ("seq", "committer_name", "branches")
        both = stored.withColumn("_new", F.lit(0)).unionByName(slim.withColumn("_new", F.lit(1)), True)
        kept = [F.max(name).alias(f"_{name}") for name in ("author", "committer", "tag")]  # the landed row has none
        newest = F.max_by(F.struct(*own), F.struct("_new", F.col("seq"))).alias("_own")
        slim = both.groupBy(REPO, "commit_sha").agg(newest, *kept).select(REPO, "commit_sha", "_own.*", "_author", "_committer", "_tag")
    else:
        slim = slim.withColumns({name: F.lit(None).cast("string") for name in ("_author", "_committer", "_tag")})
    on = {REPO: REPO, "commit_sha": "sha"}
    take = {"author": "author", "committer": "committer", "_landed": "_landed"}
    found = lookup(slim, accounts.withColumn("_landed", F.lit(True)), on, take)
    found = add_tags(found, tags.where(F.col("name").isNotNull()))
    landed = F.col("_landed").isNotNull()
    return found.select(
        REPO, "commit_sha", "seq", "committer_name", "branches",
        *(F.when(landed, F.col(name)).otherwise(F.col(f"_{name}")).alias(name) for name in ("author", "committer")),
        F.when(F.col("tag") != "", F.col("tag")).otherwise(F.col("_tag")).alias("tag"),
    )


def refresh_versions(
    spark: SparkSession, root: str, mined_commits: DataFrame, mined_edits: DataFrame, accounts: DataFrame,
    users: DataFrame, tags: DataFrame, mode: str = "representative",
) -> None:
    """Lay a part of the mined logs over the stored version tables.

    The stored state of the touched repositories and the landed part are resolved together, on slim rows, so a first
    commit that lands late decides for its name as in a whole landing. Branches keep their ids; new ones are numbered
    after those that are stored. Only the buckets of the touched repositories are read and written. The state is saved
    last: if the saving stops half-way, the same landing can be laid over again.
    """
    parts = (mined_commits, mined_edits, accounts, tags)
    touched = settled(reduce(DataFrame.unionByName, [df.select(REPO) for df in parts]).distinct(), "versions-touched")
    buckets = buckets_of(touched)
    here = lambda df: known_only(df, touched, [REPO])
    stored_state = here(read_bucketed(spark, state_path(root), COMMIT_STATE, buckets).select(*COMMIT_STATE.names))
    stored = {name: here(read_table(spark, root, name, buckets=buckets)) for name in ("commits", "edits", "branches")}
    state = settled(commit_state(mined_commits, accounts, tags, stored_state), "versions-state")

    last = stored["branches"].groupBy(REPO).agg(F.max("id").alias("_last"))
    new = unknown_only(branch_names(state), stored["branches"], [REPO, "branch_names"])
    new = lookup(with_position(settled(new, "versions-branches"), ["branch_names"], [REPO], "id"), last, {REPO: REPO}, {"_last": "_last"})
    new = new.select(REPO, (F.col("id") + F.coalesce(F.col("_last") + 1, F.lit(0))).alias("id"), "branch_names")
    branches = settled(stored["branches"].unionByName(new), "versions-dictionary")

    resolved = resolve(state.withColumn("tag", F.coalesce("tag", F.lit(""))), users, mode=mode)
    found = encode_branches(resolved, branches)
    added = ["author", "committer", "unknown_user", "tag", "branch_ids"]
    plain = [name for name in TABLES["commits"].columns if name not in added]
    landed = projections.commits(mined_commits).select(*plain)
    commits = _laid_over(stored["commits"].select(*plain), landed, [REPO, "commit_sha"])
    full = lookup(commits, found, {c: c for c in (REPO, "commit_sha")}, {c: c for c in added})
    edits = _laid_over(stored["edits"], projections.edits(mined_edits), [REPO, "id"])
    save_together({"commits": full, "edits": edits, "branches": branches}, root)
    save_state(state, state_path(root), COMMIT_STATE, touched)
    discard(touched, state, branches)


def _laid_over(stored: DataFrame, landed: DataFrame, key: Sequence[str]) -> DataFrame:
    """Stored rows with landed ones over them; of several landed rows of a key the content decides."""
    both = stored.withColumn("_is_new", F.lit(0)).unionByName(landed.withColumn("_is_new", F.lit(1)))
    return first_per_key(both, key, [F.col("_is_new").desc(), F.xxhash64(*landed.columns)]).drop("_is_new")


def repair_identities(spark: SparkSession, root: str, mapping: DataFrame, salt: str = "") -> None:
    """Give unknown names of the stored commits to users, and store both tables."""
    commits, users = read_table(spark, root, "commits"), read_table(spark, root, "users")
    new_commits, new_users = assign_unknown_users(commits, users, mapping, (REPO,), salt)
    save_together({"commits": new_commits, "users": new_users}, root)
