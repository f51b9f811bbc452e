import datetime
import json

import pytest

from repolume.functions.people import People
from repolume.plans import summary
from repolume.plans.selection import TableSelection
from repolume.plans.workspace import Workspace
from repolume.schemas import MINED_COMMITS, MINED_EDITS, TABLES
from repolume.sources.tables import read_table
from tests.conftest import rows

U1 = {"node_id": "n1", "name": "Ann", "login": "ann"}


@pytest.fixture
def workspace(spark, tmp_path):
    return Workspace(spark, str(tmp_path / "store"), People(raw_ids=True))


@pytest.fixture
def land(tmp_path):
    def put(entity, repo, *records):
        pages(entity, repo, (None, records))

    def pages(entity, repo, *listings):
        """One page for each (parent, records)."""
        folder = tmp_path / "landing" / entity
        folder.mkdir(parents=True, exist_ok=True)
        page = lambda parent, records: {"repo_full_name": repo, "page": 0, "parent": parent, "items": list(records)}
        (folder / f"{repo.replace('/', '-')}.json").write_text("\n".join(json.dumps(page(*listing)) for listing in listings))

    put.pages = pages
    put.folder = str(tmp_path / "landing")
    return put


def issue(i, day, **more):
    return {"id": i, "number": i, "updated_at": f"2024-01-{day:02d}T00:00:00Z", **more}


def test_build_update_and_export(spark, workspace, land, tmp_path):
    land("issue", "o/a", issue(1, 1, user=U1), issue(2, 2))
    land("issue", "o/b", issue(3, 3))
    land("issue_comment", "o/a", {"id": 9, "user": U1})
    land("repository", "o/a", {"name": "a", "full_name": "o/a"})
    workspace.generate(land.folder)
    assert rows(workspace.table("issues"), "repo_full_name", "id") == [("o/a", 1), ("o/a", 2), ("o/b", 3)]
    assert rows(workspace.table("users"), "id") == [("n1",)]
    assert workspace.table("repository").first()["issues_count"] == 2

    # o/a gets a new issue and loses its comments; o/b changes nothing that the check sees
    land("issue", "o/a", issue(1, 1, user=U1), issue(4, 4))
    land("issue", "o/b", issue(3, 3, title="unseen"))
    land("issue_comment", "o/a")
    workspace.generate(land.folder, check_for_updates=True)
    assert rows(workspace.table("issues"), "repo_full_name", "id", "title") == [("o/a", 1, None), ("o/a", 4, None), ("o/b", 3, None)]
    assert workspace.table("issue_comments").count() == 0
    assert workspace.table("repository").first()["issues_count"] == 2
    workspace.generate(land.folder, check_for_updates=True)
    assert workspace.table("repository").first()["issues_count"] == 2, "counts do not depend on the check"
    workspace.generate(land.folder)
    assert rows(workspace.table("issues", ["o/b"]), "id", "title") == [(3, "unseen")]

    workspace.export(str(tmp_path / "out"), "json", ["o/a"])
    assert spark.read.json(str(tmp_path / "out" / "issues")).count() == 2
    assert {r["table"]: r["rows"] for r in workspace.catalog().collect()}["issues"] == 3


def test_identities(spark, frame, workspace, land):
    land("commit_account", "o/a", {"sha": "s1", "author": U1})
    commit = lambda i, name: {"repo_full_name": "o/a", "seq": i, "hash": f"s{i}", "committer_name": name, "branches": "main",
                              "committer_date": "2024-01-01 00:00:00"}
    frame(MINED_COMMITS, commit(1, "Ann"), commit(2, "X"), commit(3, "Y")).write.parquet(f"{land.folder}/mined_commits")
    frame(MINED_EDITS, {"repo_full_name": "o/a", "id": 1, "commit_hash": "s1"}).write.parquet(f"{land.folder}/mined_edits")
    only = TableSelection().all_false()
    only.versions = True
    workspace.generate(land.folder, only)
    assert rows(workspace.unknown_users()) == [("o/a", "X", 1), ("o/a", "Y", 1)]
    workspace.assign_unknown_user("o/a", "X", "n1")
    workspace.assign_unknown_user("o/a", "Y", "new")
    assert rows(workspace.unknown_users()) == []
    assert rows(workspace.table("users"), "anonym_uuid", "name", "alias") == [("n1", "Ann", ["X"]), ("new", "Y", None)]
    assert rows(workspace.table("commits"), "commit_sha", "author") == [("s1", "n1"), ("s2", "n1"), ("s3", "new")]
    # a rebuild finds X by its alias and Y by the name of the new user
    workspace.generate(land.folder, only)
    assert rows(workspace.table("commits"), "commit_sha", "author") == [("s1", "n1"), ("s2", "n1"), ("s3", "new")]


def test_registry_and_patterns(frame, workspace):
    workspace.register(frame("repo_full_name string", *[{"repo_full_name": n} for n in ("o/ab", "o/bc", "o/bc")]))
    assert rows(workspace.repositories(["b"], ["c"])) == [("o/ab",)]
    assert len(rows(workspace.repositories())) == 2
    assert workspace.table("issues").columns == TABLES["issues"].columns


def test_partial_landings_add_up_to_a_whole_one(spark, workspace, land, tmp_path):
    def put(folder, day_of_1, *more):
        (tmp_path / folder).mkdir()
        land("issue", "o/a", issue(1, day_of_1, user=U1, title=f"day {day_of_1}"), *more)
        land("issue_comment", "o/a", {"id": 9, "user": {"node_id": f"n{day_of_1}"}, "body": folder})
        land("release", "o/a", {"id": 5, "title": folder}, {"id": 6, "title": "r", "published_at": "2024-01-01T00:00:00Z", "body": folder})

    put("first", 1, issue(2, 2))
    workspace.generate(land.folder)
    put("second", 3, issue(3, 4))
    land("issue_event", "o/a", {"id": 70, "event": "closed", "issue": {"id": 1}})
    workspace.refresh(land.folder)
    assert rows(workspace.table("issues"), "id", "title") == [(1, "day 3"), (2, None), (3, None)]
    assert rows(workspace.table("issue_comments"), "id", "body") == [(9, "second")]
    assert rows(workspace.table("releases"), "id", "title", "body") == [(5, "second", None), (6, "r", "second")]
    assert rows(workspace.table("issue_events"), "id") == [(70,)]
    assert [r["id"] for r in workspace.table("users").orderBy("seq").collect()] == ["n1", "n3"]
    assert [r["id"] for r in workspace.cursors("issues").collect()] == [3]
    again = {name: rows(workspace.table(name)) for name in ("issues", "issue_comments", "releases", "users")}
    workspace.refresh(land.folder)
    assert again == {name: rows(workspace.table(name)) for name in again}


def test_edited_releases_and_drafts_are_updates(workspace, land):
    release = lambda i, body, **more: {"id": i, "tag_name": f"v{i}", "body": body, **more}
    published = {"published_at": "2024-01-01T00:00:00Z"}
    land("release", "o/a", release(1, "a", **published))
    land("release", "o/b", release(2, "b", **published))
    workspace.generate(land.folder)
    land("release", "o/a", release(1, "edited", **published), release(3, "draft"))
    workspace.generate(land.folder, check_for_updates=True)
    assert rows(workspace.table("releases"), "id", "body") == [(1, "edited"), (2, "b"), (3, "draft")]


def test_scratch_folders_go_with_the_saves(spark, workspace, land, tmp_path, monkeypatch):
    from repolume.plans import workspace as module
    from repolume.sinks import tables

    for place in (module, tables):
        monkeypatch.setattr(place, "scratch_dir", lambda spark, label: f"{tmp_path}/scratch/{label}")
    land("issue", "o/a", issue(1, 1, user=U1))
    workspace.generate(land.folder, check_for_updates=True)
    assert workspace.table("issues").count() == 1
    assert [p for p in (tmp_path / "scratch").rglob("*.parquet")] == []


def test_parts_of_the_mined_logs_add_up_to_a_whole_one(spark, frame, workspace, land, tmp_path):
    commit = lambda i, name, branches="main": {"repo_full_name": "o/a", "seq": i, "hash": f"s{i}", "committer_name": name,
                                               "branches": branches, "committer_date": "2024-01-01 00:00:00"}
    edit = lambda i, sha: {"repo_full_name": "o/a", "id": i, "commit_hash": sha}
    account = lambda i, who: {"sha": f"s{i}", "author": {"node_id": who, "name": who}}
    only = TableSelection().all_false()
    only.versions = True

    def part(number, commits, edits, accounts, tags=()):
        place = tmp_path / f"part{number}"
        for entity, records in (("commit_account", accounts), ("tag", tags)):
            (place / entity).mkdir(parents=True)
            (place / entity / "p.json").write_text(json.dumps({"repo_full_name": "o/a", "page": 0, "items": list(records)}))
        frame(MINED_COMMITS, *commits).write.parquet(f"{place}/mined_commits")
        frame(MINED_EDITS, *edits).write.parquet(f"{place}/mined_edits")
        return str(place)

    second = [commit(5, "Ann", "main,dev"), commit(6, "Bob"), commit(7, "Cy")]
    workspace.generate(part(1, second, [edit(2, "s5")], [account(5, "n5"), account(6, "n6")]), only)
    assert rows(workspace.table("commits"), "commit_sha", "author", "unknown_user") == [
        ("s5", "n5", None), ("s6", "n6", None), ("s7", None, "Cy")]
    ids = dict(rows(workspace.table("branches"), "branch_names", "id"))
    # the first commits of Ann and Bob land late, with a branch that sorts first, the account of s7 and a tag of s5
    first = [commit(1, "Ann", "alpha,main"), commit(2, "Bob")]
    late = part(2, first, [edit(1, "s1")], [account(1, "n1"), account(7, "n7")], [{"name": "v1", "commit": {"sha": "s5"}}])
    for _ in range(2):  # laid over twice, it is the same
        workspace.refresh(late, only)
        assert rows(workspace.table("commits"), "commit_sha", "author", "unknown_user", "tag") == [
            ("s1", "n1", None, ""), ("s2", None, "Bob", ""), ("s5", "n1", None, "v1"), ("s6", None, "Bob", ""), ("s7", "n7", None, "")]
        assert rows(workspace.table("edits"), "id") == [(1,), (2,)]
        now = dict(rows(workspace.table("branches"), "branch_names", "id"))
        assert {name: now[name] for name in ids} == ids and now["alpha"] == max(ids.values()) + 1
        named = {i: name for name, i in now.items()}
        lists = {r["commit_sha"]: [named[i] for i in r["branch_ids"]] for r in workspace.table("commits").collect()}
        assert lists["s1"] == ["alpha", "main"] and lists["s5"] == ["main", "dev"]


def reaction(i, content="+1", who="n1"):
    return {"id": i, "content": content, "user": {"node_id": who}}


API = "https://host/repos/o/a"


def test_listed_reviews_and_reactions_find_their_parents(workspace, land):
    land("issue", "o/a", issue(100, 1) | {"number": 5, "reactions": [reaction(1), reaction(2)]})
    land("issue_comment", "o/a", {"id": 7, "reactions": [reaction(1, "eyes")]})
    land("pull_request", "o/a", {"id": 200, "number": 6, "reviews": [{"id": 1, "state": "COMMENTED"}]})
    land("review_comment", "o/a", {"id": 9})
    land.pages(
        "review", "o/a", ({"url": f"{API}/pulls/6"}, [{"id": 2, "user": {"node_id": "n7"}}]),
        ({"id": 200}, [{"id": 1, "state": "APPROVED"}]), ({"url": f"{API}/pulls/77"}, [{"id": 3}]), (None, [{"id": 4}]),
    )
    land.pages(
        "reaction", "o/a", ({"kind": "issue", "url": f"{API}/issues/5"}, [reaction(2, "again"), reaction(3, who="n8")]),
        ({"url": f"{API}/issues/comments/7"}, [reaction(4)]), ({"kind": "issue_comment", "id": 7}, [reaction(5)]),
        ({"url": f"{API}/pulls/comments/9"}, [reaction(6)]), ({"url": f"{API}/pulls/6"}, [reaction(7)]),
        ({"url": f"{API}/issues/55"}, [reaction(8)]), (None, [reaction(9)]),
    )
    everything = TableSelection().all_true()
    for build in (lambda: workspace.generate(land.folder, everything), lambda: workspace.refresh(land.folder, everything)):
        build()
        assert rows(workspace.table("reviews"), "id", "pull_request_id", "state") == [
            (1, 200, "APPROVED"), (2, 200, None), (3, None, None), (4, None, None)]
        assert rows(workspace.table("issue_reactions"), "id", "parent_name", "parent_id", "content") == [
            (1, "comment", 7, "eyes"), (1, "issue", 100, "+1"), (2, "issue", 100, "again"), (3, "issue", 100, "+1"),
            (4, "comment", 7, "+1"), (5, "comment", 7, "+1"), (8, "issue", None, "+1"), (9, None, None, "+1")]
        assert rows(workspace.table("pull_request_reactions"), "id", "parent_name", "parent_id") == [
            (6, "review_comment", 9), (7, "pull_request", 200)]
        assert rows(workspace.table("users"), "id") == [("n1",), ("n7",), ("n8",)]


def test_listings_find_parents_that_are_stored_and_late_ones(workspace, land, tmp_path):
    later = str(tmp_path / "second")
    land("issue", "o/a", issue(100, 1) | {"number": 5})
    land.pages("reaction", "o/a", ({"url": f"{API}/issues/6"}, [reaction(1)]))
    workspace.generate(land.folder, TableSelection().all_true())
    assert rows(workspace.table("issue_reactions"), "id", "parent_id") == [(1, None)]
    pages = [({"url": f"{API}/issues/5"}, [reaction(2)]), ({"url": f"{API}/issues/6"}, [reaction(1)])]
    for entity, lines in (("reaction", pages), ("issue", [(None, [issue(101, 1) | {"number": 6}])])):
        (tmp_path / "second" / entity).mkdir(parents=True)
        page = lambda parent, items: json.dumps({"repo_full_name": "o/a", "page": 0, "parent": parent, "items": items})
        (tmp_path / "second" / entity / "p.json").write_text("\n".join(page(*line) for line in lines))
    workspace.refresh(later, TableSelection().all_true())
    assert rows(workspace.table("issue_reactions"), "id", "parent_id") == [(1, 101), (2, 100)]


def test_a_changed_child_alone_makes_its_repository_an_update(workspace, land):
    everything = TableSelection().all_true()
    for repo in ("o/a", "o/b", "o/c"):
        land("issue", repo, issue(1, 1, title="first", reactions=[reaction(1), reaction(2)]))
        land("pull_request", repo, {"id": 3, "number": 1, "updated_at": "2024-01-01T00:00:00Z", "reviews": [{"id": 4, "state": "COMMENTED"}]})
    workspace.generate(land.folder, everything)
    # titles change unseen: only repositories whose children differ are built anew
    land("issue", "o/a", issue(1, 1, title="new", reactions=[reaction(2), reaction(1)]))
    land("issue", "o/b", issue(1, 1, title="new", reactions=[reaction(1), reaction(2, "eyes")]))
    land("issue", "o/c", issue(1, 1, title="new", reactions=[]))
    land("pull_request", "o/a", {"id": 3, "number": 1, "draft": True, "updated_at": "2024-01-01T00:00:00Z", "reviews": [{"id": 4, "state": "APPROVED"}]})
    land("pull_request", "o/b", {"id": 3, "number": 1, "draft": True, "updated_at": "2024-01-01T00:00:00Z", "reviews": [{"id": 4, "state": "COMMENTED"}]})
    workspace.generate(land.folder, everything, check_for_updates=True)
    assert rows(workspace.table("issues"), "repo_full_name", "title") == [("o/a", "first"), ("o/b", "new"), ("o/c", "new")]
    assert rows(workspace.table("issue_reactions"), "repo_full_name", "id", "content") == [
        ("o/a", 1, "+1"), ("o/a", 2, "+1"), ("o/b", 1, "+1"), ("o/b", 2, "eyes")]
    assert rows(workspace.table("pull_requests"), "repo_full_name", "draft") == [("o/a", True), ("o/b", None), ("o/c", None)]


def test_wanted_issues_are_kept_until_they_land(workspace, land):
    pull = lambda i: {"id": i * 10, "number": i}
    flagged = lambda i: issue(i, 1, pull_request={"url": "u"})
    land("pull_request", "o/a", pull(1), pull(2), pull(3))
    land("pull_request", "o/b", pull(1))
    land("issue", "o/a", flagged(1), issue(2, 1))
    workspace.generate(land.folder)
    assert rows(workspace.wanted_issues()) == [("o/a", 2, 20), ("o/a", 3, 30), ("o/b", 1, 10)]
    land("pull_request", "o/a")
    land("pull_request", "o/b")
    land("issue", "o/a", flagged(3))
    for _ in range(2):
        workspace.refresh(land.folder)
        assert rows(workspace.wanted_issues()) == [("o/a", 2, 20), ("o/b", 1, 10)]


def test_the_summary_of_parts_is_that_of_a_whole_landing(spark, frame, workspace, land, tmp_path):
    def commit(i, day):
        date = f"2024-01-{day:02d} 00:00:00"
        return {"repo_full_name": "o/a", "seq": i, "hash": f"s{i}", "committer_date": date, "author_date": date, "branches": f"main,b{i}"}

    def edit(i, sha, filename):
        return {"repo_full_name": "o/a", "id": i, "commit_hash": sha, "filename": filename}

    def put(issues, labels, commits, edits):
        land("issue", "o/a", *issues)
        land("label", "o/a", *({"id": i} for i in labels))
        frame(MINED_COMMITS, *commits).write.mode("overwrite").parquet(f"{land.folder}/mined_commits")
        frame(MINED_EDITS, *edits).write.mode("overwrite").parquet(f"{land.folder}/mined_edits")

    first = [issue(1, 1), issue(2, 2)], [1, 2], [commit(2, 5)], [edit(1, "s2", "README.md"), edit(2, "s1", "SECURITY.md")]
    second = [issue(2, 4), issue(3, 4)], [2, 3], [commit(1, 2)], [edit(3, "s1", "README.md"), edit(4, "s2", "SUPPORT.md")]
    land("repository", "o/a", {"name": "a", "full_name": "o/a", "stargazers_count": 3})
    land("issue", "o/b", issue(7, 1))
    land("repository", "o/b", {"name": "b", "full_name": "o/b"})
    put(*first)
    only = TableSelection().all_false()
    only.repository.summary = True
    workspace.generate(land.folder, only)
    land("repository", "o/a")
    land("repository", "o/b")
    land("issue", "o/b")
    put(*second)
    workspace.refresh(land.folder, only)
    found = rows(workspace.table("repository"))
    workspace.refresh(land.folder, only)
    assert rows(workspace.table("repository")) == found, "what lands again counts once"
    whole = Workspace(spark, str(tmp_path / "whole"), workspace.people)
    land("repository", "o/a", {"name": "a", "full_name": "o/a", "stargazers_count": 3})
    land("issue", "o/b", issue(7, 1))
    land("repository", "o/b", {"name": "b", "full_name": "o/b"})
    put([issue(1, 1), issue(2, 4), issue(3, 4)], [1, 2, 3], first[2] + second[2], first[3] + second[3])
    whole.generate(land.folder, only)
    assert found == rows(whole.table("repository"))
    a = workspace.table("repository").where("repo_name = 'a'").first()
    assert (a["issues_count"], a["labels_count"], a["commit_count"], a["branch_count"], a["stars"]) == (3, 3, 2, 3, 3)
    assert a["file_readme"].day == 2 and a["file_security"].day == 2 and a["file_support"].day == 5 and a["last_commit_date"].day == 5


def test_keys_of_a_repeated_landing_are_stored_once(spark, frame, tmp_path):
    root, at = str(tmp_path / "store"), datetime.datetime(2024, 1, 2)
    key = {"repo_full_name": "o/a", "counted": "commit_count", "key": "s1", "author_date": at, "committed_at": at}
    edit = {"repo_full_name": "o/a", "counted": "edit", "key": "s1", "filename": "README.md"}
    early, nobody = {**edit, "key": "s2"}, {**key, "repo_full_name": None}
    keys = frame(summary.SUMMARY_KEYS, key, key, edit, early, nobody)
    described = frame(TABLES["repository"].schema, {"repo_full_name": "o/a"})
    for _ in range(3):
        summary.refresh_summary(spark, root, keys, described)
    stored = spark.read.parquet(summary.keys_path(root))
    assert sorted((r.repo_full_name or "", r.counted, r.key) for r in stored.collect()) == [
        ("", "commit_count", "s1"), ("o/a", "commit_count", "s1"), ("o/a", "edit", "s1"), ("o/a", "edit", "s2")
    ]
    shown = read_table(spark, root, "repository").collect()
    assert [(r.commit_count, r.last_commit_date, r.file_readme, r.file_security) for r in shown] == [(1, at, at, None)]
