import json

from repolume.operators import incremental, projections
from repolume.schemas import RAW, TABLES
from repolume.sources.pages import page_schema, records_of
from repolume.streaming.ingest import append_versions, current_state, stream_pages
from tests.conftest import rows


def land(folder, name, page, *records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps({"repo_full_name": "o/r", "page": page, "items": list(records)}))


def comment(i, day, body):
    return {"id": i, "body": body, "updated_at": f"2024-01-{day:02d}T00:00:00.000Z"}


def test_newest_version_survives_restarts_and_late_pages(spark, tmp_path):
    pages, log, check = tmp_path / "pages", str(tmp_path / "log"), str(tmp_path / "check")
    schema = TABLES["issue_comments"].schema

    def run():
        stream = stream_pages(spark, str(pages), "issue_comment", max_files=1)
        append_versions(stream, log, check, projections.issue_comments).awaitTermination()
        return rows(current_state(spark, log, schema), "id", "body")

    land(pages, "a.json", 0, comment(1, 10, "one"), comment(2, 11, "two"))
    assert run() == [(1, "one"), (2, "two")]
    # the window overlaps, one record is newer, one is far older than all seen
    land(pages, "b.json", 1, comment(2, 11, "two"), comment(1, 12, "one, edited"), comment(3, 1, "late"))
    assert run() == [(1, "one, edited"), (2, "two"), (3, "late")]
    assert run() == [(1, "one, edited"), (2, "two"), (3, "late")]
    assert spark.read.parquet(log).count() == 5


def test_stream_and_batch_agree_on_changed_rows(spark, tmp_path):
    pages, log, check = tmp_path / "pages", str(tmp_path / "log"), str(tmp_path / "check")
    land(pages, "a.json", 0, comment(1, 10, "old"), comment(2, 9, "kept"))
    land(pages, "b.json", 1, comment(1, 12, "new"))
    schema = TABLES["issue_comments"].schema
    append_versions(stream_pages(spark, str(pages), "issue_comment", 1), log, check, projections.issue_comments).awaitTermination()
    batch = incremental.latest_per_id(projections.issue_comments(records_of(spark.read.schema(page_schema(RAW["issue_comment"])).json(str(pages)))))
    assert rows(current_state(spark, log, schema), "id", "body") == rows(batch, "id", "body") == [(1, "new"), (2, "kept")]


def test_the_store_keeps_up_with_the_stream(spark, tmp_path):
    """Late, repeated and re-run batches give the table that a batch upsert gives; other buckets are not rewritten."""
    from repolume.plans.activity import merge_table
    from repolume.sources.tables import read_table
    from repolume.streaming.ingest import stream_into_store

    pages, root = tmp_path / "pages", str(tmp_path / "store")
    other = lambda i, body: {"repo_full_name": "o/other", "id": i, "body": body}
    kept = spark.createDataFrame([other(1, "stored")], TABLES["issue_comments"].schema)
    merge_table(kept, root, "issue_comments")
    files = sorted(str(f) for f in (tmp_path / "store").rglob("*.parquet"))

    def run(check="check"):
        stream = stream_pages(spark, str(pages), "issue_comment", max_files=1)
        stream_into_store(stream, root, "issue_comments", str(tmp_path / check), projections.issue_comments).awaitTermination()
        return rows(read_table(spark, root, "issue_comments"), "id", "body")

    untimed = {"id": 9, "body": "no time"}
    land(pages, "a.json", 0, comment(1, 10, "one"), comment(2, 11, "two"), untimed)
    assert run() == [(1, "one"), (1, "stored"), (2, "two"), (9, "no time")]
    land(pages, "b.json", 1, comment(2, 5, "late"), comment(1, 12, "one, edited"), comment(3, 1, "new"))
    want = [(1, "one, edited"), (1, "stored"), (2, "two"), (3, "new"), (9, "no time")]
    assert run() == want and run() == want
    # all batches once more, as after a lost checkpoint, and a stale landing laid over directly
    assert run("check2") == want
    batch = projections.issue_comments(records_of(spark.read.schema(page_schema(RAW["issue_comment"])).json(str(pages))))
    merge_table(batch, root, "issue_comments")
    assert rows(read_table(spark, root, "issue_comments"), "id", "body") == want
    assert set(files) <= {str(f) for f in (tmp_path / "store").rglob("*.parquet")}
