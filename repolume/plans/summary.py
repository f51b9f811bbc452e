"""The repository summary, kept up to date by partial landings.

What the summary counts is kept beside it as keys: repository, what is counted, and the key of the record; of commits
their dates too, and of edits those of community files only. Landed keys are laid over the stored ones as a set, so a
record that lands again, or a landing that is repeated after a failure, counts once, and an edit finds its commit in
whichever order the two land.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repolume.fixed_values import COMMUNITY_FILES
from repolume.operators.aggregates import SUMMARY_COUNTS
from repolume.operators.lookups import known_only, lookup, unknown_only
from repolume.schemas import REPO, STRING, TABLES, TS, struct
from repolume.session import discard, settled
from repolume.sinks.tables import buckets_of, save_buckets, save_table
from repolume.sources.tables import read_bucketed, read_table

SUMMARY_KEYS = struct(repo_full_name=STRING, counted=STRING, key=STRING, filename=STRING, author_date=TS, committed_at=TS)
_COMMITS, _EDITS = "commit_count", "edit"
# Counted listing -> the column that tells its records apart, where that is not the id.
_KEY_OF = {"commits": "hash", "tags": "name", "branches": "branch_names"}
# Columns of the summary that come from the keys.
_DERIVED = (*SUMMARY_COUNTS, "last_commit_date", *COMMUNITY_FILES)


def keys_path(root: str) -> str:
    return f"{root.rstrip('/')}/{TABLES['repository'].folder}/summary_keys"


def distinct_keys(keys: DataFrame) -> DataFrame:
    """``SUMMARY_KEYS`` with each key once."""
    dates = [F.max(name).alias(name) for name in ("author_date", "committed_at")]
    return keys.groupBy(REPO, "counted", "key", "filename").agg(*dates).select(*SUMMARY_KEYS.names)


def summary_keys(sources: dict[str, DataFrame], log: DataFrame, edits: DataFrame) -> DataFrame:
    """``SUMMARY_KEYS`` of the listings ``sources`` (names of ``SUMMARY_COUNTS`` values), the commit log with its dates and
    the edits, as often as they are there: ``distinct_keys`` has each once, also the records of a listing that have no key;
    ``refresh_summary`` makes them distinct together with the stored ones."""
    none = lambda *names: [F.lit(None).cast(SUMMARY_KEYS[name].dataType).alias(name) for name in names]
    parts = [
        sources[source].select(
            REPO, F.lit(name).alias("counted"), F.col(_KEY_OF.get(source, "id")).cast("string").alias("key"),
            *none("filename", "author_date", "committed_at"),
        )
        for name, source in SUMMARY_COUNTS.items()
        if source in sources and name != _COMMITS
    ]
    sha = F.col("commit_sha").cast("string").alias("key")
    dates = [F.col(name).cast("timestamp").alias(name) for name in ("author_date", "committed_at")]
    parts.append(log.select(REPO, F.lit(_COMMITS).alias("counted"), sha, *none("filename"), *dates))
    touching = edits.where(F.col("filename").isin(*COMMUNITY_FILES.values()))
    parts.append(touching.select(REPO, F.lit(_EDITS).alias("counted"), sha, "filename", *none("author_date", "committed_at")))
    return reduce(DataFrame.unionByName, parts)


def counts_and_dates(keys: DataFrame) -> DataFrame:
    """The columns of the summary that come from ``SUMMARY_KEYS``, per repository."""
    counts = [F.count_if(F.col("counted") == name).alias(name) for name in SUMMARY_COUNTS]
    per_repository = keys.groupBy(REPO).agg(*counts, F.max("committed_at").alias("last_commit_date"))
    return lookup(per_repository, _first_dates(keys), {REPO: REPO}, {name: name for name in COMMUNITY_FILES})


def _first_dates(keys: DataFrame) -> DataFrame:
    """``first_appearances`` out of ``SUMMARY_KEYS``: a commit and its edits are rows of one key, so they need no join."""
    own = keys.where(F.col("counted").isin(_COMMITS, _EDITS) & F.col(REPO).isNotNull() & F.col("key").isNotNull())
    flags = [F.bool_or(F.col("filename") == name).alias(target) for target, name in COMMUNITY_FILES.items()]
    dates = [F.max(name).alias(name) for name in ("author_date", "committed_at")]
    known = F.bool_or(F.col("counted") == _COMMITS).alias("_known")
    commits = own.groupBy(REPO, "key").agg(known, *dates, *flags).where("_known")
    order = F.struct("committed_at", "author_date")
    first = [F.min_by("author_date", F.when(F.col(target), order)).alias(target) for target in COMMUNITY_FILES]
    return commits.groupBy(REPO).agg(*first)


def refresh_summary(spark: SparkSession, root: str, keys: DataFrame, repositories: DataFrame) -> None:
    """Lay landed ``keys`` and landed rows of the summary (their counts do not matter) over what is stored.

    Only the buckets of touched repositories are read and written. All keys in them are laid together, those of their
    other repositories as well: these are distinct already, and telling them apart would take a shuffle of all keys. The
    keys are saved last: if the saving stops half-way, the same landing can be laid over again.
    """
    landed = settled(keys.select(*SUMMARY_KEYS.names), "summary-landed")
    touched = settled(landed.select(REPO).union(repositories.select(REPO)).distinct(), "summary-touched")
    buckets = buckets_of(touched)
    stored = read_bucketed(spark, keys_path(root), SUMMARY_KEYS, buckets).select(*SUMMARY_KEYS.names)
    both = settled(distinct_keys(stored.unionByName(landed)), "summary-keys")
    here = known_only(read_table(spark, root, "repository", buckets=buckets), touched, [REPO])
    base = unknown_only(here, repositories, [REPO])
    base = base.unionByName(repositories.select(*base.columns)).drop(*_DERIVED)
    full = lookup(base, counts_and_dates(both), {REPO: REPO}, {name: name for name in _DERIVED})
    full = full.withColumns({name: F.coalesce(name, F.lit(0).cast("long")) for name in SUMMARY_COUNTS})
    save_table(full, root, "repository", touched)
    save_buckets(both, keys_path(root))
    discard(landed, touched, both)
