from repolume.operators import enrich as E
from repolume.operators import relations as R
from tests.conftest import rows

REPO = "repo_full_name string"


def test_last_tag_wins(frame):
    commits = frame(f"{REPO}, commit_sha string", {"repo_full_name": "r", "commit_sha": "a"}, {"repo_full_name": "r", "commit_sha": "b"})
    tags = frame(f"{REPO}, seq long, sha string, name string",
                 {"repo_full_name": "r", "seq": 1, "sha": "a", "name": "v1"}, {"repo_full_name": "r", "seq": 2, "sha": "a", "name": "v2"},
                 {"repo_full_name": "other", "seq": 3, "sha": "b", "name": "v3"})
    assert rows(E.add_tags(commits, tags), "commit_sha", "tag") == [("a", "v2"), ("b", "")]


def test_branches(frame):
    commits = frame(f"{REPO}, id long, branches string", {"repo_full_name": "r", "id": 1, "branches": "main,dev"},
                    {"repo_full_name": "r", "id": 2, "branches": "dev"}, {"repo_full_name": "s", "id": 3, "branches": "main"},
                    {"repo_full_name": "s", "id": 4})
    dictionary = E.branch_dictionary(commits)
    assert rows(dictionary) == [("r", 0, "dev"), ("r", 1, "main"), ("s", 0, "main")]
    assert rows(E.encode_branches(commits, dictionary), "id", "branch_ids") == [(1, [1, 0]), (2, [0]), (3, [0]), (4, [])]


def test_pull_requests_and_issues(frame):
    pulls = frame(f"{REPO}, id long, number long", *[{"repo_full_name": "r", "id": i, "number": i} for i in (1, 2, 3)])
    issues = frame(f"{REPO}, number long, is_pull_request boolean, title string",
                   {"repo_full_name": "r", "number": 1, "is_pull_request": True, "title": "one"},
                   {"repo_full_name": "r", "number": 2, "is_pull_request": False, "title": "two"},
                   {"repo_full_name": "s", "number": 3, "is_pull_request": True, "title": "three"})
    assert rows(R.flagged_pull_requests(pulls, issues), "number") == [(1,)]
    assert rows(R.missing_issues(pulls, issues), "number") == [(2,), (3,)]
    assert rows(R.issues_complete(pulls, issues)) == [(2, 3, False)]
    assert rows(R.complete_pull_requests(pulls, issues, ["title"]), "number", "title") == [(1, "one")]


def test_children_keep_their_number(frame):
    comments = frame(f"{REPO}, id long, issue_url string", {"repo_full_name": "r", "id": 1, "issue_url": "u1"}, {"repo_full_name": "r", "id": 2, "issue_url": "gone"})
    issues = frame(f"{REPO}, url string, title string", {"repo_full_name": "r", "url": "u1", "title": "t"})
    assert rows(R.comments_with_issue(comments, issues, {"title": "issue_title"}), "id", "issue_title") == [(1, "t"), (2, None)]


def test_reactions_find_any_parent(frame):
    reactions = frame(f"{REPO}, id long, parent_name string, parent_id long",
                      *[{"repo_full_name": "r", "id": i, "parent_name": n, "parent_id": 1} for i, n in enumerate(["issue", "comment", "review_comment"])])
    parent = lambda text: frame(f"{REPO}, id long, body string", {"repo_full_name": "r", "id": 1, "body": text})
    found = R.reactions_with_parent(reactions, {"issue": parent("i"), "comment": parent("c")}, {"body": "parent_body"})
    assert rows(found, "id", "parent_body") == [(0, "i"), (1, "c"), (2, None)]


def test_join_by_array(frame):
    pulls = frame(f"{REPO}, id long, commit_shas array<string>", {"repo_full_name": "r", "id": 1, "commit_shas": ["a", "b", "gone"]}, {"repo_full_name": "r", "id": 2, "commit_shas": []})
    commits = frame(f"{REPO}, commit_sha string, author string", *[{"repo_full_name": "r", "commit_sha": s, "author": s.upper()} for s in "ab"])
    got = R.join_by_array(pulls, commits, "commit_shas", "commit_sha", {"author": "author"}, "sha")
    assert rows(got, "id", "sha", "author") == [(1, "a", "A"), (1, "b", "B")]


def test_audit_counts_orphans(frame):
    tables = {
        "issues": frame(f"{REPO}, id long, url string, assignees array<string>", {"repo_full_name": "r", "id": 1, "url": "u", "assignees": ["P1", "P9"]}),
        "issue_events": frame(f"{REPO}, id long, issue_id long", *[{"repo_full_name": "r", "id": i, "issue_id": p} for i, p in enumerate([1, 1, 2, None])]),
        "issue_reactions": frame(f"{REPO}, parent_name string, parent_id long",
                                 {"repo_full_name": "r", "parent_name": "issue", "parent_id": 5}, {"repo_full_name": "r", "parent_name": "comment", "parent_id": 1}),
        "users": frame(f"{REPO}, anonym_uuid string", {"repo_full_name": "r", "anonym_uuid": "P1"}),
    }
    wanted = [r for r in R.RELATIONS if (r.child, r.column, r.parent) in {
        ("issue_events", "issue_id", "issues"), ("issue_reactions", "parent_id", "issues"), ("issues", "assignees", "users")}]
    assert rows(R.audit(tables, wanted)) == [
        ("issue_events.issue_id->issues.id", 3, 1), ("issue_reactions.parent_id->issues.id", 1, 1),
        ("issues.assignees->users.anonym_uuid", 2, 1),
    ]


def test_url_key(frame):
    df = frame("url string", {"url": "https://api/repos/o/r/pulls/7"})
    assert rows(R.with_url_key(df, "url", repository="repo"), "parent_number", "repo") == [(7, "o/r")]
