"""Issues that pull requests need and that have not landed: a ledger kept over all runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from repolume.operators.lookups import known_only
from repolume.operators.relations import missing_issues
from repolume.schemas import LONG, REPO, STRING, TABLES, struct
from repolume.sinks.tables import buckets_of, save_state
from repolume.sources.tables import read_bucketed, read_table

WANTED_ISSUES = struct(repo_full_name=STRING, number=LONG, pull_request_id=LONG)


def wanted_path(root: str) -> str:
    return f"{root.rstrip('/')}/{TABLES['issues'].folder}/wanted_issues"


def read_wanted_issues(spark: SparkSession, root: str) -> DataFrame:
    return read_bucketed(spark, wanted_path(root), WANTED_ISSUES).select(*WANTED_ISSUES.names)


def settle_wanted_issues(spark: SparkSession, root: str, repositories: DataFrame) -> None:
    """Write anew what the ledger says of ``repositories``: their stored pull requests without a stored issue.

    What landed since goes, new wants come, wants of the other repositories stay. Only the buckets of
    ``repositories`` are read and written; doing it twice gives the same ledger.
    """
    touched = repositories.select(REPO).distinct()
    buckets = buckets_of(touched)
    here = {name: known_only(read_table(spark, root, name, buckets=buckets), touched, [REPO]) for name in ("issues", "pull_requests")}
    wanted = missing_issues(here["pull_requests"], here["issues"]).withColumnRenamed("id", "pull_request_id")
    save_state(wanted, wanted_path(root), WANTED_ISSUES, touched)
