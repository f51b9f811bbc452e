import io
import json
import zipfile
from datetime import datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from repolume.functions.people import People
from repolume.operators import projections
from repolume.operators.identity import attribute_index
from repolume.plans.activity import MET, met_users
from repolume.schemas import RAW, REPO, TABLES, raw_frame_schema, tables_by_folder
from repolume.session import scratch_dir
from repolume.sinks import tables as W
from repolume.sources import archives as Z
from repolume.sources.mined import read_mined_commits, read_mined_edits
from repolume.sources.pages import read_pages
from repolume.sources.tables import read_registry, read_table, table_path
from tests.conftest import rows

T1 = datetime(2024, 1, 1)


def workflow(repo, i, name="w"):
    return {"repo_full_name": repo, "id": i, "name": name, "created_at": T1}


def test_missing_paths_read_as_empty_tables(spark, tmp_path):
    for name, spec in TABLES.items():
        df = read_table(spark, str(tmp_path / "none"), name)
        assert df.schema.names == spec.schema.names and df.count() == 0
    assert read_registry(spark, str(tmp_path / "none.json")).count() == 0
    assert read_pages(spark, str(tmp_path / "none"), "issue").count() == 0
    assert read_mined_commits(spark, str(tmp_path / "none")).count() == 0
    assert "commit_hash" in read_mined_edits(spark, str(tmp_path / "none"), "json").columns


def test_other_read_errors_are_raised(spark, tmp_path):
    (tmp_path / "bad.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        W.read_or_empty(spark, str(tmp_path / "bad.parquet"), TABLES["workflows"].schema).collect()


def test_save_replaces_the_repositories_at_hand(spark, frame, tmp_path):
    root, schema = str(tmp_path), TABLES["workflows"].schema
    W.save_table(frame(schema, workflow("a", 1), workflow("a", 2), workflow("b", 3)), root, "workflows")
    W.save_table(frame(schema, workflow("a", 4)), root, "workflows")
    assert rows(read_table(spark, root, "workflows"), REPO, "id") == [("a", 4), ("b", 3)]
    # from the stored table onto itself
    W.save_table(read_table(spark, root, "workflows").withColumn("name", F.lit("x")), root, "workflows")
    assert rows(read_table(spark, root, "workflows", ["b"]), "id", "name") == [(3, "x")]
    assert W.save_if_any(frame(schema), root, "workflows") is False
    W.save_table(frame(schema), root, "workflows")
    assert read_table(spark, root, "workflows").count() == 2


def test_users_are_added_once(spark, frame, tmp_path):
    root, schema = str(tmp_path), TABLES["users"].schema
    user = lambda i, name, seq: {"repo_full_name": "r", "id": i, "anonym_uuid": f"P{i}", "name": name, "seq": seq}
    W.append_users(frame(schema, user("1", "first", 0)), root)
    W.append_users(frame(schema, user("1", "other", 0), user("2", "b", 1), user("2", "c", 2)), root)
    assert rows(read_table(spark, root, "users"), "id", "name") == [("1", "first"), ("2", "b")]


def test_registry(spark, frame, tmp_path):
    path = tmp_path / "repos"
    path.mkdir()
    (path / "given.json").write_text(json.dumps({"repos": ["o/a", "o/b"]}))
    names = frame("repo_full_name string", {"repo_full_name": "o/b"}, {"repo_full_name": "o/c"}, {"repo_full_name": "o/c"})
    W.add_repositories(spark, str(path), names)
    W.add_repositories(spark, str(path), names)
    assert rows(read_registry(spark, str(path))) == [("o/a",), ("o/b",), ("o/c",)]


def test_pages_keep_listing_order(spark, tmp_path):
    page = lambda n, ids: json.dumps({"repo_full_name": "o/r", "page": n, "items": [{"id": i} for i in ids]})
    (tmp_path / "1.json").write_text(page(1, [7, 6]))
    (tmp_path / "0.json").write_text(page(0, [9, 8]))
    df = read_pages(spark, str(tmp_path), "workflow")
    assert df.columns == [REPO, "seq", *RAW["workflow"].names]
    assert [r["id"] for r in df.orderBy("seq").collect()] == [9, 8, 7, 6]


@pytest.mark.parametrize("source", ["csv", "json"])
def test_export(spark, frame, tmp_path, source):
    schema = TABLES["workflow_runs"].schema
    df = frame(schema, {"repo_full_name": "o/r", "id": 1, "pull_requests": [1, 2], "event": 'a "quoted"\nline, with comma'},
               {"repo_full_name": "o/r", "id": 2, "pull_requests": [], "event": ""}, {"repo_full_name": "o/r", "id": 3})
    W.export_tables({"workflow_runs": df}, str(tmp_path / "x"), source)
    back = W.read_export(spark, str(tmp_path / "x"), "workflow_runs", schema, source)
    assert rows(back, "id", "event", "pull_requests", "conclusion") == [
        (1, 'a "quoted"\nline, with comma', "[1,2]", None), (2, "", "[]", None), (3, None, None, None),
    ]


def test_catalog(spark, frame, tmp_path):
    root = str(tmp_path)
    W.save_table(frame(TABLES["workflows"].schema, workflow("a", 1)), root, "workflows")
    got = {r["table"]: (r["folder"], r["columns"], r["rows"]) for r in W.catalog(spark, root).collect()}
    assert len(got) == 16 and got["workflows"] == ("Workflows", 6, 1) and got["issues"][2] == 0
    assert tables_by_folder()["Versions"] == ["commits", "edits", "branches"]
    assert table_path(root, "users").endswith("/users")


def archive(**members):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as target:
        for name, text in members.items():
            target.writestr(name, text)
    return buffer.getvalue()


def test_archives(spark, tmp_path):
    (tmp_path / "11.zip").write_bytes(archive(a="x\ny\n", b=""))
    (tmp_path / "12.zip").write_bytes(b"no archive")
    (tmp_path / "13.zip").write_bytes(archive())
    df = Z.read_archives(spark, str(tmp_path))
    assert rows(Z.count_members(df)) == [(11, 2), (12, None), (13, 0)]
    assert rows(Z.archive_lines(df)) == [(11, "a", 1, "x"), (11, "a", 2, "y")]


def test_long_members_come_in_batches(spark, monkeypatch):
    text = "\n".join(str(i) for i in range(3 * Z.ROWS_PER_BATCH + 5))
    df = spark.createDataFrame([(1, bytearray(archive(a=text)))], "run_id long, payload binary")
    assert Z.archive_lines(df).agg(F.count("*"), F.max("line_no")).first() == (3 * Z.ROWS_PER_BATCH + 5,) * 2


def test_scratch_folder_is_shared(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir", "/tmp"))
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_users_of_a_later_landing_come_after_the_stored_ones(spark, frame, tmp_path):
    schema, root = TABLES["users"].schema, str(tmp_path)
    old = {"repo_full_name": "r", "seq": 1 << 20, "anonym_uuid": "OLD", "id": "1", "name": "x"}
    new = {"repo_full_name": "r", "seq": 0, "anonym_uuid": "NEW", "id": "2", "name": "x"}
    W.append_users(frame(schema, old), root)
    W.append_users(frame(schema, new, {**old, "seq": 7}), root)
    stored = read_table(spark, root, "users")
    assert [r["anonym_uuid"] for r in stored.orderBy("seq").collect()] == ["OLD", "NEW"]
    index = attribute_index(stored)
    assert rows(index.where("key = 'x'"), "anonym_uuid") == [("OLD",)]


def test_users_met_in_one_record_have_an_order_of_their_own(frame):
    issue = {"repo_full_name": "r", "seq": 0, "id": 1, "user": {"node_id": "b", "name": "x"}, "closed_by": {"node_id": "a", "name": "x"}}
    comment = {"repo_full_name": "r", "seq": 0, "id": 2, "user": {"node_id": "c", "name": "x"}}
    raw = {name: frame(raw_frame_schema(RAW[name]), row) for name, row in (("issue_comment", comment), ("issue", issue))}
    users = projections.users(met_users(raw), People(raw_ids=True), MET)
    assert rows(users, "seq", "id") == [(0, "b"), (1, "a"), (2, "c")]


def test_archives_are_unpacked_one_at_a_time():
    """A batch of archives is neither held as Python objects nor handed on as one batch."""
    payload = archive(a="x" * 3_000_000)
    schema = pa.schema({"run_id": pa.int64(), "payload": pa.binary()})
    opened = []

    def counted(payload):
        opened.append(len(payload))
        return Z.zipfile.ZipFile(Z.io.BytesIO(payload))

    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array([payload] * 6)], schema=schema)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(Z, "_open", counted)
        sizes = [(len(opened), found.num_rows, found.nbytes) for found in Z._lines(iter([batch]))]
    assert [(at, n) for at, n, _ in sizes] == [(2, 2), (4, 2), (6, 2)] and max(size for *_, size in sizes) < 7_000_000
