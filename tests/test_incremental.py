from collections import Counter
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from repolume.functions.ranking import slice_by_position, with_position
from repolume.operators import incremental as I
from repolume.operators import ordering as O
from repolume.operators import setops as S
from tests.conftest import rows

T = datetime(2024, 1, 1)
SCHEMA = "repo_full_name string, id long, updated_at timestamp, v string"


def record(i, day, v="", repo="r"):
    return {"repo_full_name": repo, "id": i, "updated_at": T + timedelta(days=day), "v": v}


@pytest.mark.parametrize(
    "new, old, expected",
    [
        ([], [], False), ([(1, 0)], [], True), ([(1, 0), (2, 5)], [(1, 0), (2, 5)], False), ([(1, 0), (2, 6)], [(2, 5)], True),
        ([(1, 0), (3, 6)], [(1, 0)], True), ([], [(1, 0)], False),
    ],
)
def test_has_updates(frame, new, old, expected):
    make = lambda pairs: frame(SCHEMA, *[record(i, day) for i, day in pairs])
    assert I.has_updates(make(new), make(old)).first()[0] is expected


def test_has_updates_without_ids(frame):
    make = lambda day: frame("updated_at timestamp", {"updated_at": T + timedelta(days=day)})
    assert I.has_updates(make(1), make(1)).first()[0] is False
    assert I.has_updates(make(2), make(1)).first()[0] is True


def test_change_classes(frame):
    new = frame(SCHEMA, record(1, 0), record(2, 3), record(3, 0))
    old = frame(SCHEMA, record(1, 0), record(2, 0))
    assert rows(I.change_classes(new, old), "id", "change") == [(1, "same"), (2, "changed"), (3, "new")]


def test_upsert_is_idempotent_and_keeps_newer_rows(frame):
    old = frame(SCHEMA, record(1, 5, "old"), record(2, 0, "old"), record(3, 1, "old"))
    new = frame(SCHEMA, record(1, 4, "late"), record(2, 3, "new"), record(3, 1, "tie"), record(4, 0, "new"))
    once = I.upsert(old, new)
    assert rows(once, "id", "v") == [(1, "old"), (2, "new"), (3, "tie"), (4, "new")]
    assert rows(I.upsert(once, new)) == rows(once)


def test_content_decides_between_equal_times_in_any_input_order(frame):
    new = [record(1, 5, value) for value in "abc"]
    first = I.upsert(frame(SCHEMA, record(1, 1, "old")), frame(SCHEMA, *new))
    assert rows(first) == rows(I.upsert(frame(SCHEMA, record(1, 1, "old")), frame(SCHEMA, *reversed(new))))
    assert rows(I.latest_per_id(frame(SCHEMA, *new))) == rows(I.latest_per_id(frame(SCHEMA, *reversed(new))))


def test_changed_content_is_seen_without_an_update_time(frame):
    stored = frame(SCHEMA, record(1, 0, "a"), record(2, 0, "b"))
    verdict = lambda *listed: I.content_per_repository(frame(SCHEMA, *listed), stored).first()["has_updates"]
    assert not verdict(record(2, 0, "b"), record(1, 0, "a"))
    assert verdict(record(1, 0, "a"), record(2, 0, "edited"))
    assert verdict(record(1, 0, "a"), record(2, 0, "b"), record(3, 0, "draft"))


@pytest.mark.parametrize("without_time", [0, 2, 3])
def test_cursor_over_ties_gives_every_row_once(frame, without_time):
    df = frame(SCHEMA, *[{**record(i, 0), **({"updated_at": None} if i < without_time else {})} for i in range(5)])
    cursor, seen, pages = None, [], 0
    while True:
        page = I.read_since(df, cursor, 2).select("updated_at", "id").collect()
        if not page:
            break
        pages += 1
        seen += [r["id"] for r in page]
        cursor = tuple(page[-1])
    assert (pages, seen) == (3, [0, 1, 2, 3, 4])
    assert rows(I.cursor_pages(df, 2), "id", "page") == [(0, 0), (1, 0), (2, 1), (3, 1), (4, 2)]


def test_stitch_overlapping_windows(frame):
    a = frame(SCHEMA, record(1, 0, "a"), record(2, 1, "a"))
    b = frame(SCHEMA, record(2, 2, "b"), record(3, 3, "b"))
    assert rows(S.stitch([a, b]), "id", "v") == [(1, "a"), (2, "b"), (3, "b")]


def test_overflow_union(frame):
    listed = frame("repo_full_name string, id long, issue_id long", {"repo_full_name": "r", "id": 1, "issue_id": 9})
    nested = frame("repo_full_name string, id long, issue_id long", {"repo_full_name": "r", "id": 1, "issue_id": 8}, {"repo_full_name": "r", "id": 2, "issue_id": 8})
    assert rows(I.overflow_union(listed, nested), "id", "issue_id") == [(1, 9), (2, 8)]


def test_cap(frame):
    edits = frame("repo_full_name string, commit_sha string", *[{"repo_full_name": "r", "commit_sha": s} for s in "aaabb"])
    assert rows(I.cap_modifications(edits, 2), "commit_sha") == [("b",), ("b",)]


def test_user_extraction_and_set_operations(frame):
    df = frame("a long", {"a": 1})
    assert rows(I.extract(df, lambda d, k: d.select((F.col("a") * k).alias("a")), 3)) == [(3,)]
    both = S.concat(df, frame("b string", {"b": "x"}))
    assert rows(both) == [(1, None), (None, "x")]
    assert rows(S.union_tagged({"x": df, "y": df}, "t")) == [(1, "x"), (1, "y")]
    assert rows(S.distinct_items(frame("l array<string>", {"l": ["a", "b"]}, {"l": ["a"]}), "l")) == [("a",), ("b",)]


def test_listings(frame):
    df = frame("id long, updated_at timestamp, state string", *[{"id": i, "updated_at": T + timedelta(days=d), "state": s}
                                                                for i, d, s in [(1, 2, "open"), (2, 1, "closed"), (3, 2, "open")]])
    ids = lambda d: [r["id"] for r in d.collect()]
    assert ids(O.sort_by_update(df)) == [2, 1, 3] and ids(O.sort_by_update(df, ascending=False)) == [3, 1, 2]
    assert ids(O.page(df, 1, 1)) == [1] and ids(O.nth(df, 0)) == [3] and ids(O.nth(df, 0, newest_first=False)) == [2]
    assert ids(O.nth(df, 9)) == []
    assert ids(O.listing(df, "open")) == [1, 3] and ids(O.listing(df)) == [2, 1, 3]


@pytest.fixture(scope="module")
def skewed(spark):
    """Group 0 holds four fifths of the rows; the order key is shuffled and unique."""
    return spark.range(5000).selectExpr("if(id % 5 = 0, id % 7, 0) as g", "(id * 7919) % 5003 as k").repartition(5).cache()


@pytest.mark.parametrize("ascending", [True, False])
@pytest.mark.parametrize("within", [[], ["g"]])
@pytest.mark.parametrize("per_range", [10_000, 700, 20])
def test_positions_match_row_number(skewed, within, ascending, per_range):
    data = [(r["g"], r["k"]) for r in skewed.collect()]
    groups = {}
    for g, k in sorted(data, key=lambda x: x[1], reverse=not ascending):
        groups.setdefault(g if within else None, []).append((g, k))
    want = sorted((g, k, i) for members in groups.values() for i, (g, k) in enumerate(members))
    got = with_position(skewed, ["k"], within, "p", ascending, per_range)
    assert rows(got, "g", "k", "p") == sorted(want, key=repr)
    part = slice_by_position(skewed, ["k"], 40, 300, within, ascending, per_range)
    assert rows(part, "g", "k") == sorted(((g, k) for g, k, p in want if 40 <= p < 340), key=repr)


def test_large_pages_and_parents(skewed):
    df = skewed.select(F.col("k").alias("id"), F.col("k").alias("updated_at"), "g")
    want = sorted(r["id"] for r in df.collect())
    assert [r["id"] for r in O.page(df, 9000, 2000).collect()] == want[2000:]
    ids = sorted(r["id"] for r in df.where("g = 0").collect())
    for n in (999, 1000, 1001, 5000):
        assert [r["id"] for r in O.page(df, n).collect()] == want[:n]
        assert sorted(r["id"] for r in O.first_per_parent(df, ["g"], ["id"], n).where("g = 0").collect()) == ids[:n]
    assert sorted(r["id"] for r in O.first_per_parent(df, ["g"], ["id"], 3, ascending=False).where("g = 0").collect()) == ids[-3:]


def test_positions_with_null_groups_and_an_empty_table(spark, frame):
    df = frame("g string, k long", *[{"g": random.Random(i).choice([None, "a"]), "k": i} for i in range(50)])
    got = with_position(df, ["k"], ["g"], "p", per_range=12)
    assert got.count() == 50 and got.groupBy("g").agg(F.max("p") + 1 == F.count("*")).where("not `((max(p) + 1) = count(1))`").count() == 0
    assert with_position(df.limit(0), ["k"], ["g"]).count() == 0


def test_walking_all_repositories_by_cursors_gives_each_record_once(spark, tmp_path):
    """Repositories of 1 and of many rows in one job, times that repeat or are missing."""
    from repolume.operators.incremental import advance_cursors, next_pages

    listing = spark.sql(
        "SELECT concat('o/', r) AS repo_full_name, i AS id, IF(i % 7 = 0, NULL, timestamp'2024-01-01' + make_interval(0,0,0,i div 5)) AS updated_at "
        "FROM (SELECT 0 AS r, explode(sequence(1, 95)) AS i UNION ALL SELECT 1, 7 UNION ALL SELECT 2, explode(sequence(1, 20)))"
    )
    cursors, read, rounds = listing.limit(0), [], 0
    while True:
        page = next_pages(listing, cursors, 20)
        got = [tuple(row) for row in page.collect()]
        if not got:
            break
        assert max(Counter(row[0] for row in got).values()) <= 20
        read += got
        moved = advance_cursors(cursors, page)
        moved.write.parquet(f"{tmp_path}/cursors{rounds}")
        cursors, rounds = spark.read.parquet(f"{tmp_path}/cursors{rounds}"), rounds + 1
    assert rounds == 5 and sorted(read, key=str) == sorted((tuple(row) for row in listing.collect()), key=str)
    first = sorted(read[:41], key=str)
    want = []
    for repo in ("o/0", "o/1", "o/2"):
        own = [tuple(r) for r in listing.collect() if r[0] == repo]
        want += sorted(own, key=lambda r: (r[2] is not None, r[2], r[1]))[:20]
    assert first == sorted(want, key=str)
