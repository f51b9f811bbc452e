from datetime import datetime, timedelta

import pytest

from repolume.functions.people import People
from repolume.plans.activity import build_tables, refresh, save_all
from repolume.plans.selection import IssueSelection, PullRequestSelection, RepositorySelection, TableSelection, WorkflowSelection
from repolume.plans.versions import repair_identities
from repolume.schemas import MINED_COMMITS, MINED_EDITS, RAW, TABLES, raw_frame_schema
from repolume.sinks.tables import save_table
from repolume.sources.tables import read_table
from tests.conftest import rows

T1 = datetime(2024, 1, 1)
U1 = {"node_id": "n1", "name": "Ann", "login": "ann"}
U2 = {"node_id": "n2", "login": "bob", "email": "b@x"}


def test_switches():
    s = TableSelection()
    assert s.has_true() and not s.has_false() and s.issues.has_false()
    s.all_false()
    assert not s.issues.has_true() and s.tables() == {"users"}
    s.all_true(parts=False)
    assert s.releases and not s.issues.issues
    assert s.reset().issues.events and not s.pull_requests.deep
    assert s.all_true().pull_requests.issues.reactions
    assert s.tables() == set(TABLES)


def test_implications():
    assert IssueSelection(False, True, False, False).tables() == {"issues", "issue_reactions"}
    plain, all_issues = IssueSelection(False, False, False, False), IssueSelection(True, True, True, True)
    for switch in ("deep", "commits", "review_requests"):
        s = PullRequestSelection(pull_requests=False, review_comments=False, issues=plain, **{switch: True})
        assert s.tables() == {"pull_requests", "issues"}
    s = PullRequestSelection(False, review_comments=False, reviews=True, issues=all_issues)
    assert s.tables() == {"pull_requests", "reviews", *all_issues.tables()}
    assert PullRequestSelection(False, review_comments=True, issues=all_issues).tables() == {"review_comments"}
    assert RepositorySelection(contributor_companies=False).tables() == {"repository"}
    assert RepositorySelection(False, False).tables() == set()
    assert WorkflowSelection(runs=False).tables() == {"workflows"}


@pytest.fixture
def sources(frame):
    def raw(entity, *records):
        filled = [{"repo_full_name": "o/r", "seq": i, **record} for i, record in enumerate(records)]
        return frame(raw_frame_schema(RAW[entity]), *filled)

    reaction = {"id": 1, "content": "+1", "user": U2}
    return {
        "issue": raw("issue", {"id": 1, "number": 1, "user": U1, "reactions": [reaction], "updated_at": T1,
                               "events": [{"id": 70, "event": "closed", "actor": U2}]},
                     {"id": 2, "number": 2, "pull_request": {"url": "u"}, "updated_at": T1}),
        "issue_comment": raw("issue_comment", {"id": 5, "user": U2, "reactions": [{**reaction, "id": 2}]}),
        "issue_event": raw("issue_event", {"id": 70, "event": "closed", "issue": {"id": 1}, "actor": U2}, {"id": 71, "event": "x"}),
        "pull_request": raw("pull_request", {"id": 9, "number": 2, "reviews": [{"id": 3, "user": U1}], "additions": 4}),
        "review_comment": raw("review_comment", {"id": 4, "user": U1, "reactions": [{**reaction, "id": 3}]}),
        "release": raw("release", {"id": 1, "tag_name": "v1"}),
        "workflow": raw("workflow", {"id": 1}),
        "workflow_run": raw("workflow_run", {"id": 1, "workflow_id": 1}),
        "tag": raw("tag", {"name": "v1", "commit": {"sha": "a"}}),
        "commit_account": raw("commit_account", {"sha": "a", "author": U1}),
        "repository": raw("repository", {"name": "r", "full_name": "o/r"}),
        "label": raw("label", {"id": 1}, {"id": 2}, {"id": 3}),
    }


@pytest.fixture
def mined(frame):
    commit = lambda i, sha, name: {"repo_full_name": "o/r", "seq": i, "hash": sha, "committer_name": name, "branches": "main,dev",
                                   "author_date": "2024-01-01 00:00:00", "committer_date": "2024-01-02 00:00:00", "commit_message": sha}
    commits = frame(MINED_COMMITS, commit(1, "a", "Ann"), commit(2, "b", "Ann"), commit(3, "c", "b@x"), commit(4, "d", "nobody"))
    edits = frame(MINED_EDITS, {"repo_full_name": "o/r", "id": 1, "commit_hash": "a", "filename": "README.md", "total_added_lines": 2})
    return commits, edits


def test_everything(sources, mined):
    tables = build_tables(sources, TableSelection().all_true(), People(raw_ids=True), *mined)
    assert set(tables) == set(TABLES)
    for name, df in tables.items():
        assert df.columns == TABLES[name].columns, name
    counts = {name: df.count() for name, df in tables.items()}
    assert counts == {
        "users": 2, "releases": 1, "issues": 2, "issue_comments": 1, "issue_events": 2, "issue_reactions": 2, "pull_requests": 1,
        "reviews": 1, "review_comments": 1, "pull_request_reactions": 1, "workflows": 1, "workflow_runs": 1, "commits": 4, "edits": 1,
        "branches": 2, "repository": 1,
    }
    assert rows(tables["commits"], "commit_sha", "author", "committer", "unknown_user", "tag", "branch_ids", "commit_message") == [
        ("a", "n1", None, None, "v1", [1, 0], "a"), ("b", "n1", None, None, "", [1, 0], "b"),
        ("c", "n2", "n2", None, "", [1, 0], "c"), ("d", None, None, "nobody", "", [1, 0], "d"),
    ]
    summary = tables["repository"].first()
    assert (summary["commit_count"], summary["tag_count"], summary["issues_count"], summary["branch_count"]) == (4, 1, 2, 2)
    assert (summary["labels_count"], summary["pullrequest_review_count"], summary["milestone_count"]) == (3, 1, 0)
    assert summary["file_readme"] == T1 and summary["last_commit_date"] == T1 + timedelta(days=1)


def test_defaults_leave_reactions_and_reviews_out(sources, mined):
    tables = build_tables(sources, None, People(), *mined)
    assert set(TABLES) - set(tables) == {"issue_reactions", "pull_request_reactions", "reviews"}
    assert rows(tables["pull_requests"], "additions") == [(None,)]


def test_events_from_one_shape_only(sources):
    only = TableSelection().all_false()
    only.issues.events = True
    listed = build_tables({"issue_event": sources["issue_event"]}, only)["issue_events"]
    under = build_tables({"issue": sources["issue"]}, only)["issue_events"]
    assert rows(listed, "id") == [(70,), (71,)] and rows(under, "id", "issue_id") == [(70, 1)]


def test_store_repair_and_refresh(spark, frame, sources, mined, tmp_path):
    root = str(tmp_path)
    save_all(build_tables(sources, TableSelection().all_true(), People(raw_ids=True), *mined), root)
    mapping = frame("repo_full_name string, seq long, unknown_user string, uuid string, new_user boolean",
                    {"repo_full_name": "o/r", "seq": 0, "unknown_user": "nobody", "uuid": "n1", "new_user": False})
    repair_identities(spark, root, mapping)
    assert rows(read_table(spark, root, "commits").where("unknown_user is not null")) == []
    assert rows(read_table(spark, root, "users"), "id", "alias") == [("n1", ["nobody"]), ("n2", None)]
    stored = read_table(spark, root, "issues")
    landed = frame(TABLES["issues"].schema, {"repo_full_name": "o/r", "id": 2, "title": "new", "updated_at": T1 + timedelta(days=1)})
    save_table(refresh("issues", stored, landed), root, "issues")
    assert rows(read_table(spark, root, "issues"), "id", "title") == [(1, None), (2, "new")]
    with pytest.raises(ValueError):
        refresh("edits", stored, landed)
