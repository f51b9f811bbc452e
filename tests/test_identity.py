import random

import pytest

from repolume.functions.people import pseudonym
from repolume.operators import identity as I
from repolume.operators import lookups as L
from tests.conftest import rows

COMMITS = "repo_full_name string, seq long, commit_sha string, committer_name string, author string, committer string"
USERS = (
    "repo_full_name string, seq long, anonym_uuid string, id string, name string, email string, login string, "
    "alias array<string>"
)


def commit(seq, name, author=None, committer=None, repo="r"):
    return {"repo_full_name": repo, "seq": seq, "commit_sha": f"{repo}-{seq}", "committer_name": name, "author": author, "committer": committer}


def user(seq, uuid, repo="r", **fields):
    return {"repo_full_name": repo, "seq": seq, "anonym_uuid": uuid, "id": uuid.lower(), **fields}


def resolved(frame, commits, users, mode="representative"):
    df = I.resolve(frame(COMMITS, *commits), frame(USERS, *users), mode=mode)
    return {r["commit_sha"]: (r["author"], r["committer"], r["unknown_user"]) for r in df.collect()}


def test_representative_against_per_commit(frame):
    commits = [commit(1, "X", "P1", "P1"), commit(2, "X", "P2", "P2"), commit(3, "GitHub", "P1"), commit(4, "GitHub", "P2")]
    assert resolved(frame, commits, []) == {
        "r-1": ("P1", "P1", None), "r-2": ("P1", "P1", None), "r-3": ("P1", None, None), "r-4": ("P2", None, None),
    }
    assert resolved(frame, commits, [], "per_commit")["r-2"] == ("P2", "P2", None)


def test_alias_before_attributes(frame):
    users = [user(1, "P1", email="X"), user(3, "P3", alias=["X"]), user(4, "P4", alias=["X"])]
    commits = [commit(1, "X"), commit(2, "Y", "P9", None)]
    assert resolved(frame, commits, users) == {"r-1": ("P3", "P3", None), "r-2": ("P9", None, None)}


def test_attribute_match_first_user(frame):
    users = [user(5, "P5", email="m@x"), user(2, "P2", login="m@x"), user(1, "P1", repo="other", name="m@x")]
    assert resolved(frame, [commit(1, "m@x"), commit(2, "no")], users) == {
        "r-1": ("P2", "P2", None), "r-2": (None, None, "no"),
    }


def test_unresolved_service_commits_report_their_name(frame):
    assert resolved(frame, [commit(1, "GitHub")], [])["r-1"] == (None, None, "GitHub")
    assert resolved(frame, [commit(1, "GitHub")], [user(1, "P1", login="GitHub")])["r-1"] == ("P1", "P1", None)


def test_commits_without_name_keep_their_account(frame):
    assert resolved(frame, [commit(1, None, "P1"), commit(2, None)], [])["r-1"] == ("P1", None, None)


def by_hand(commits, users, mode):
    """The rules, row by row."""
    out = {}
    for row in commits:
        source = row
        if mode == "representative" and row["committer_name"] != "GitHub":
            same = [x for x in commits if x["repo_full_name"] == row["repo_full_name"] and x["committer_name"] == row["committer_name"]]
            source = min(same, key=lambda x: x["seq"])
        author, committer, unknown = source["author"], source["committer"], None
        if author is None and committer is None:
            name = row["committer_name"]
            own = sorted((u for u in users if u["repo_full_name"] == row["repo_full_name"]), key=lambda u: u["seq"])
            hit = next((u for u in own if name in (u.get("alias") or [])), None)
            hit = hit or next((u for u in own if name in (u.get("email"), u.get("name"), u.get("login"))), None)
            if hit:
                author = committer = hit["anonym_uuid"]
            else:
                unknown = name
        out[row["commit_sha"]] = (author, committer, unknown)
    return out


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("mode", ["representative", "per_commit"])
def test_resolution_against_the_rules_row_by_row(frame, seed, mode):
    rng = random.Random(seed)
    names = ["GitHub", "a", "b", "c", "d", "e"]
    pick = lambda values: rng.choice([None, None, *values])
    commits = [commit(i, rng.choice(names), pick(["P1", "P2"]), pick(["P1", "P3"]), rng.choice(["r", "s"])) for i in range(60)]
    users = [
        user(i, f"P{i}", rng.choice(["r", "s"]), email=pick(names), name=pick(names), login=pick(names),
             alias=pick([[rng.choice(names)], [rng.choice(names), "z"]]))
        for i in range(8)
    ]
    assert resolved(frame, commits, users, mode) == by_hand(commits, users, mode)


def test_resolve_commits_looks_accounts_up(frame):
    commits = frame("repo_full_name string, seq long, commit_sha string, committer_name string",
                    *[{"repo_full_name": "r", "seq": i, "commit_sha": s, "committer_name": n}
                      for i, (s, n) in enumerate([("a", "X"), ("b", "X"), ("c", "GitHub"), (None, "Z")])])
    accounts = frame("repo_full_name string, sha string, author string, committer string",
                     {"repo_full_name": "r", "sha": "a", "author": "P1"}, {"repo_full_name": "r", "sha": "c", "committer": "P2"},
                     {"repo_full_name": "s", "sha": "b", "author": "P7"})
    df = I.resolve_commits(commits, accounts, frame(USERS))
    assert rows(df, "seq", "author", "committer", "unknown_user") == [
        (0, "P1", None, None), (1, "P1", None, None), (2, None, "P2", None), (3, None, None, "Z"),
    ]


def test_array_lookup_keeps_order_and_length(frame):
    df = frame("repo_full_name string, id long, assignees array<string>",
               {"repo_full_name": "r", "id": 1, "assignees": ["n2", "gone", "n1"]},
               {"repo_full_name": "r", "id": 2, "assignees": []}, {"repo_full_name": "r", "id": 3},
               {"repo_full_name": "r", "id": 4, "assignees": ["n1", "n1", None]})
    users = frame("repo_full_name string, id string, anonym_uuid string",
                  *[{"repo_full_name": "r", "id": f"n{i}", "anonym_uuid": f"P{i}"} for i in (1, 2)])
    got = rows(L.replace_users(df, users, [], ["assignees"], ["repo_full_name"]), "id", "assignees")
    assert got == [(1, ["P2", None, "P1"]), (2, []), (3, []), (4, ["P1", "P1", None])]


MAPPING = "repo_full_name string, seq long, unknown_user string, uuid string, new_user boolean"


def line(seq, name, uuid, new_user=False):
    return {"repo_full_name": "r", "seq": seq, "unknown_user": name, "uuid": uuid, "new_user": new_user}


@pytest.fixture
def unknown(frame):
    names = ["X", "X", "Y", "Z", "W", "V", None]
    return frame(
        "repo_full_name string, commit_sha string, author string, committer string, unknown_user string",
        *[{"repo_full_name": "r", "commit_sha": str(i), "unknown_user": n, **({} if n else {"author": "P1"})} for i, n in enumerate(names)],
    )


def test_known_user_gets_one_alias(frame, unknown):
    users = frame(USERS, user(1, "P1"))
    commits, after = I.assign_unknown_users(unknown, users, frame(MAPPING, line(1, "X", "P1"), line(2, "X", "P1")))
    assert rows(after, "anonym_uuid", "alias") == [("P1", ["X"])]
    assert rows(commits.where("commit_sha < 2"), "author", "committer", "unknown_user") == [("P1", "P1", None)] * 2
    assert rows(commits.where("commit_sha = 3"), "author", "unknown_user") == [(None, "Z")]
    again, users2 = I.assign_unknown_users(commits, after, frame(MAPPING, line(1, "X", "P1")))
    assert rows(users2, "alias") == [(["X"],)] and rows(again) == rows(commits)


@pytest.mark.parametrize("new_user", [False, True])
def test_new_user(spark, frame, unknown, new_user):
    commits, users = I.assign_unknown_users(unknown, frame(USERS, user(1, "P1")), frame(MAPPING, line(1, "Y", "new-1", new_user)))
    uuid = "new-1"
    if new_user:
        one = spark.sql("select 'new-1' as id")
        uuid = one.select(pseudonym(one.id)).first()[0]
    assert rows(users.where("seq > 1"), "anonym_uuid", "id", "name") == [(uuid, "new-1", "Y")]
    assert rows(commits.where("commit_sha = 2"), "author", "committer", "unknown_user") == [(uuid, uuid, None)]


def test_many_lines_at_once(frame, unknown):
    """Two names for one new user, a name nobody waits for, and a uuid that is a stored source id."""
    lines = [line(1, "X", "new"), line(2, "Y", "new"), line(3, "nobody", "P1"), line(4, "Z", "p1", True), line(5, "W", "P1")]
    commits, users = I.assign_unknown_users(unknown, frame(USERS, user(1, "P1", alias=["A"])), frame(MAPPING, *lines))
    assert rows(users, "anonym_uuid", "name", "alias") == [("P1", None, ["A", "W"]), ("new", "X", ["Y"])]
    got = {r["commit_sha"]: (r["author"], r["unknown_user"]) for r in commits.collect()}
    assert got == {"0": ("new", None), "1": ("new", None), "2": ("new", None), "3": ("P1", None), "4": ("P1", None),
                   "5": (None, "V"), "6": ("P1", None)}


def test_unknown_users_report(unknown):
    assert rows(I.unknown_users(unknown))[-2:] == [("r", "Y", 1), ("r", "Z", 1)]
