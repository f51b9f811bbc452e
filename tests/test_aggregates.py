from datetime import datetime, timedelta

from pyspark.sql import functions as F

from repolume.operators import aggregates as A
from repolume.schemas import RAW, TABLES
from tests.conftest import rows

REPO = "repo_full_name string"
T1 = datetime(2024, 1, 1)
T2 = T1 + timedelta(days=1)


def test_shares_sum_to_one(frame):
    edits = frame(f"{REPO}, commit_sha string, total_added_lines long, total_removed_lines long, levenshtein_dist long",
                  {"repo_full_name": "r", "commit_sha": "a", "total_added_lines": 3, "total_removed_lines": 1, "levenshtein_dist": 9},
                  {"repo_full_name": "r", "commit_sha": "b", "total_added_lines": 4, "levenshtein_dist": 3},
                  {"repo_full_name": "z", "commit_sha": "c", "total_added_lines": 0})
    commits = frame(f"{REPO}, commit_sha string, author string", {"repo_full_name": "r", "commit_sha": "a", "author": "A"},
                    {"repo_full_name": "r", "commit_sha": "b", "author": "B"}, {"repo_full_name": "z", "commit_sha": "c", "author": "C"})
    assert rows(A.share_changed_lines(edits, commits)) == [("r", "A", 4, 0.5), ("r", "B", 4, 0.5), ("z", "C", 0, None)]
    assert rows(A.share_edit_distance(edits, commits), "author", "share") == [("A", 0.75), ("B", 0.25), ("C", None)]


def test_first_appearances(frame):
    commits = frame(f"{REPO}, commit_sha string, author_date timestamp, committed_at timestamp",
                    {"repo_full_name": "r", "commit_sha": "a", "author_date": T2, "committed_at": T2},
                    {"repo_full_name": "r", "commit_sha": "b", "author_date": T1, "committed_at": T1})
    edits = frame(f"{REPO}, commit_sha string, filename string", *[{"repo_full_name": "r", "commit_sha": s, "filename": "README.md"} for s in "aab"])
    assert rows(A.first_appearances(edits, commits), "file_readme", "file_funding") == [(T1, None)]


def test_companies_are_ordered_and_whole(frame):
    schema = "contributors array<struct<company: string>>"
    listed = lambda *names: frame(schema, {"contributors": [{"company": name} for name in names]})
    companies = lambda df: df.select(A.contributor_companies(F.col("contributors"))).first()[0]
    assert companies(listed("y", None, "x", "y")) == ["y", "x", "y"]
    assert len(companies(listed(*map(str, range(700))))) == 700
    assert companies(frame(schema, {})) == []


def test_children_become_an_ordered_array(frame):
    rows_ = [{"p": p, "k": k, "v": v} for p, k, v in [(1, 2, "b"), (1, 1, "a"), (1, 3, None), (2, 1, "x")]]
    children = frame("p long, k long, v string", *rows_)
    assert rows(A.list_per_parent(children, ["p"], "v", ["k"], 10)) == [(1, 0, ["a", "b", None]), (2, 0, ["x"])]
    assert rows(A.list_per_parent(children, ["p"], "v", ["k"], 2, "vs")) == [(1, 0, ["a", "b"]), (1, 1, [None]), (2, 0, ["x"])]


def test_no_child_of_a_large_parent_is_left_out(spark):
    children = spark.range(45_000).selectExpr("0 AS p", "id AS k", "id AS v")
    listed = A.list_per_parent(children, ["p"], "v", ["k"], 20_000).orderBy("chunk").collect()
    assert [len(row["v"]) for row in listed] == [20_000, 20_000, 5_000]
    assert [v for row in listed for v in row["v"]] == list(range(45_000))


def test_counts(frame):
    df = frame("a string, t timestamp", {"a": "x", "t": T1}, {"t": T2})
    assert A.count_rows(df).first()[0] == 2 and A.count_rows(df.limit(0)).first()[0] == 0
    assert A.count_present(df, "a").first()[0] == 1
    assert A.latest(df, "t").first()[0] == T2
    assert rows(A.distinct_values(df, "a")) == [("x",)]


def test_summary_of_full_and_of_empty_repository(frame):
    repositories = frame(
        RAW["repository"],
        {"name": "r", "full_name": "o/r", "stargazers_count": 3, "has_wiki": True, "readme_content": "abc", "watchers_count": 7,
         "organization": {"name": "O", "type": "Organization"}, "contributors": [{"node_id": "1", "company": "x"}, {"node_id": "2"}]},
        {"name": "e", "full_name": "o/e"},
    )
    one = frame(REPO, {"repo_full_name": "o/r"})
    log = frame(f"{REPO}, commit_sha string, author_date timestamp, committed_at timestamp",
                {"repo_full_name": "o/r", "commit_sha": "a", "author_date": T1, "committed_at": T2})
    edits = frame(f"{REPO}, commit_sha string, filename string", {"repo_full_name": "o/r", "commit_sha": "a", "filename": "SECURITY.md"})
    sources = {"commits": log, "tags": one.union(one), "review_comments": one}
    df = A.repository_summary(repositories, sources, log, edits, companies=True)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in TABLES["repository"].schema]
    assert rows(df, "repo_name", "user_name", "commit_count", "tag_count", "pullrequest_review_count", "release_count", "last_commit_date") == [
        ("e", "o", 0, 0, 0, 0, None), ("r", "o", 1, 2, 1, 0, T2),
    ]
    assert rows(df, "repo_name", "organization_name", "repo_type", "readme_length", "watchers_count", "has_wiki", "contributor_companies") == [
        ("e", "not known", "not known", 0, None, False, []), ("r", "O", "Organization", 3, 7, True, ["x"]),
    ]
    assert rows(df, "repo_name", "file_security", "file_readme") == [("e", None, None), ("r", T1, None)]
