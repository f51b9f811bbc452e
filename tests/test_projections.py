from datetime import datetime

import pytest

from repolume.functions.people import People, pseudonym, real_user_id
from repolume.operators import projections as P
from repolume.plans.activity import met_users
from repolume.schemas import MINED_COMMITS, MINED_EDITS, RAW, TABLES, raw_frame_schema
from tests.conftest import rows

T1, T2 = datetime(2024, 1, 1, 10), datetime(2024, 1, 2, 10)
IDS = People(raw_ids=True)
U1 = {"node_id": "n1", "name": "Ann", "login": "ann"}
U2 = {"node_id": "n2", "login": "bob"}


@pytest.fixture
def raw(frame):
    def make(entity, *records):
        filled = [{"repo_full_name": "o/r", "seq": i, **record} for i, record in enumerate(records)]
        return frame(raw_frame_schema(RAW[entity]), *filled)

    return make


def test_issues(raw):
    df = P.issues(
        raw(
            "issue",
            {"id": 1, "number": 10, "user": U1, "assignees": [U2, U1], "labels": [{"name": "bug"}, {"name": "ui"}],
             "created_at": T1, "locked": True, "comments": 3},
            {"id": 2, "number": 11, "pull_request": {"url": "u"}},
        ),
        IDS,
    )
    assert df.columns == TABLES["issues"].columns
    assert rows(df, "id", "is_pull_request", "author", "assignees", "labels", "closed_by", "comments") == [
        (1, False, "n1", ["n2", "n1"], ["bug", "ui"], None, 3),
        (2, True, None, [], [], None, None),
    ]


def test_table_schemas_hold(raw):
    made = {
        "issues": P.issues(raw("issue", {"id": 1})),
        "issue_comments": P.issue_comments(raw("issue_comment", {"id": 1})),
        "issue_events": P.issue_events(raw("issue_event", {"id": 1})),
        "issue_reactions": P.reactions(raw("issue", {"id": 1}), "issue"),
        "pull_requests": P.pull_requests(raw("pull_request", {"id": 1}), deep=True, review_requests=True, commits=True),
        "reviews": P.reviews(raw("pull_request", {"id": 1})),
        "review_comments": P.review_comments(raw("review_comment", {"id": 1})),
        "releases": P.releases(raw("release", {"id": 1})),
        "workflows": P.workflows(raw("workflow", {"id": 1})),
        "workflow_runs": P.workflow_runs(raw("workflow_run", {"id": 1})),
    }
    for name, df in made.items():
        assert [(f.name, f.dataType.simpleString()) for f in df.schema] == [
            (f.name, f.dataType.simpleString()) for f in TABLES[name].schema
        ], name


def test_comments_and_review_comments(raw):
    comment = {"id": 5, "issue_url": "x/7", "body": "hi", "created_at": T1, "updated_at": T2, "user": U1}
    assert rows(P.issue_comments(raw("issue_comment", comment), IDS)) == [("o/r", 5, "x/7", "n1", "hi", T1, T2)]
    review = {"id": 6, "commit_id": "c", "original_commit_id": "o", "path": "a.py", "position": 3, "user": U2}
    got = rows(P.review_comments(raw("review_comment", review), IDS), "id", "commit_sha", "original_commit_id", "position", "author")
    assert got == [(6, "c", "o", 3, "n2")]


def test_nested_events_take_the_parent(raw):
    listed = raw("issue_event", {"id": 1, "event": "closed", "issue": {"id": 9}, "commit_id": "s", "label": {"name": "bug"}, "actor": U1})
    assert rows(P.issue_events(listed, IDS), "id", "issue_id", "commit_sha", "label", "author", "assignee") == [
        (1, 9, "s", "bug", "n1", None)
    ]
    issues = raw("issue", {"id": 7, "events": [{"id": 2, "event": "labeled"}, {"id": 3, "event": "closed"}]}, {"id": 8})
    assert rows(P.nested_issue_events(issues, IDS), "id", "issue_id") == [(2, 7), (3, 7)]


def test_reactions(raw):
    issues = raw("issue", {"id": 7, "reactions": [{"id": 1, "content": "+1", "user": U1}, {"id": 2, "content": "eyes"}]})
    assert rows(P.reactions(issues, "issue", IDS), "id", "parent_id", "parent_name", "content", "author") == [
        (1, 7, "issue", "+1", "n1"), (2, 7, "issue", "eyes", None),
    ]


def test_pull_request_columns_on_demand(raw):
    record = {
        "id": 1, "number": 4, "additions": 5, "commits_count": 2, "merged_by": U1, "requested_users": [U2],
        "commits": [{"sha": "a"}, {"sha": "b"}], "reviews": [{"id": 30, "state": "APPROVED", "user": U2, "submitted_at": T1}],
    }
    pulls = raw("pull_request", record)
    picked = ["number", "additions", "commits", "merged_by", "review_requested_users", "commit_shas"]
    assert rows(P.pull_requests(pulls, IDS), *picked) == [(4, None, None, None, None, None)]
    deep = P.pull_requests(pulls, IDS, deep=True, review_requests=True, commits=True)
    assert rows(deep, *picked) == [(4, 5, 2, "n1", ["n2"], ["a", "b"])]
    assert rows(P.reviews(pulls, IDS)) == [("o/r", 30, 1, "n2", None, "APPROVED", T1)]


def test_releases_workflows_runs(raw):
    release = raw("release", {"id": 1, "tag_name": "v1", "draft": False, "author": U1, "published_at": T2})
    assert rows(P.releases(release, IDS), "id", "tag_name", "draft", "author", "published_at") == [(1, "v1", False, "n1", T2)]
    workflow = raw("workflow", {"id": 1, "name": "ci", "state": "active", "created_at": T1, "updated_at": T2})
    assert rows(P.workflows(workflow)) == [("o/r", 1, "ci", "active", T1, T2)]
    runs = raw("workflow_run", {"id": 1, "head_sha": "s", "status": "done", "pull_requests": []}, {"id": 2, "pull_requests": [{"id": 5}]})
    assert rows(P.workflow_runs(runs), "id", "commit_sha", "state", "pull_requests") == [(1, "s", "done", []), (2, None, None, [5])]


def test_placeholder_identity(frame):
    users = frame(
        "user struct<node_id:string,name:string,email:string,login:string>",
        {"user": {"node_id": "a", "login": "invalid-email-address"}},
        {"user": {"node_id": "b", "login": "invalid-email-address", "name": "Ann"}},
        {"user": {"node_id": "c"}},
        {"user": None},
    )
    assert [r[0] for r in users.select(real_user_id(users["user"])).collect()] == [None, "b", "c", None]


def test_users_once_each(raw):
    issues = raw(
        "issue",
        {"id": 1, "user": U1, "assignees": [U2, U1], "events": [{"id": 1, "actor": {"node_id": "n3", "login": "eve"}}]},
        {"id": 2, "user": {**U1, "name": "Later"}, "closed_by": {"node_id": "n4", "login": "invalid-email-address"}},
    )
    users = P.users(met_users({"issue": issues}), IDS)
    assert users.columns == TABLES["users"].columns
    assert rows(users, "id", "name", "login", "alias") == [
        ("n1", "Ann", "ann", None), ("n2", None, "bob", None), ("n3", None, "eve", None),
    ]


def test_pseudonym_is_stable_and_one_to_one(spark):
    df = spark.range(20000).selectExpr("cast(id as string) as id")
    named = df.select("id", pseudonym(df.id).alias("a"), pseudonym(df.id).alias("b"), pseudonym(df.id, "s").alias("salted"))
    assert named.where("a <> b").count() == 0
    assert named.select("a").distinct().count() == 20000
    assert named.where("a = salted").count() == 0
    nothing = spark.sql("select cast(null as string) as id")
    assert nothing.select(pseudonym(nothing.id)).first()[0] is None


def test_mined_commits_and_edits(frame):
    commits = frame(
        MINED_COMMITS,
        {"repo_full_name": "o/r", "seq": 1, "hash": "s", "committer_name": "X", "committer_date": "2024-01-01 10:00:00",
         "author_date": "2024-01-01 09:00:00", "parents": "p", "author_email": "m"},
    )
    df = P.commits(commits)
    assert not set(P.COMMIT_DROPS) & set(df.columns)
    assert rows(df, "commit_sha", "commited_at", "parent_sha", "committer_name") == [("s", T1, "p", "X")]
    edits = frame(MINED_EDITS, {"repo_full_name": "o/r", "id": 1, "commit_hash": "s", "total_removed_lines": 4})
    got = rows(P.edits(edits), "commit_sha", "filename", "total_added_lines", "total_removed_lines", "levenshtein_dist")
    assert got == [("s", None, 0, 4, 0)]
