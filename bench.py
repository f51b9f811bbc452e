"""Time queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]`` and print one JSON line.

Each query runs once to warm up and then three times; its time is the median. Results are written to the no-op
sink, so every row and column is produced. ``BENCH_QUERIES=name,name`` restricts the run, ``BENCH_QUERIES=all``
times every query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from repolume.queries import QUERIES
from repolume.session import build_session

HEADLINE = (
    "share_changed_lines", "share_changed_lines_by_repository", "share_edit_distance", "resolve_identities",
    "version_tables", "assign_unknown_users", "project_issues", "project_pull_requests_deep", "project_review_comments",
    "project_users", "rename_fill_cast", "user_lookup", "assignee_lookup", "array_lookup_ordered", "tag_enrichment",
    "fk_audit", "run_parent", "repository_summary", "first_appearance_pivot", "latest_per_id", "upsert_refresh",
    "change_classes", "cursor_pages", "cap_modifications", "request_maximum_per_parent", "stored_table_replace",
    "stream_cursor_ingest", "log_archive_members", "log_archive_lines",
)


def measure(spark, folder: str, name: str, repeats: int = 3) -> float:
    times = []
    for _ in range(repeats + 1):
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times[1:]), 4)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = tuple(QUERIES) if wanted == "all" else tuple(filter(None, wanted.split(","))) or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", spark_sql_shuffle_partitions=cpus, spark_ui_enabled="false", spark_driver_memory="8g",
        spark_ui_showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        seconds[name] = measure(spark, folder, name)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the queries (warm, median of 3)",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
