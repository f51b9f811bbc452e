"""Results and plans when one key holds a third of the rows."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from repolume.operators import aggregates, identity, incremental, lookups, relations
from repolume.functions.ranking import with_position


@contextmanager
def settings(spark, **values):
    names = {key.replace("_", "."): value for key, value in values.items()}
    before = {key: spark.conf.get(key, None) for key in names}
    for key, value in names.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def small_thresholds(spark):
    """Thresholds at which the test data count as large, and no broadcast."""
    with settings(
        spark,
        spark_sql_autoBroadcastJoinThreshold="-1",
        spark_sql_adaptive_skewJoin_skewedPartitionThresholdInBytes="64KB",
        spark_sql_adaptive_skewJoin_skewedPartitionFactor="2",
        spark_sql_adaptive_advisoryPartitionSizeInBytes="64KB",
        spark_sql_adaptive_forceOptimizeSkewedJoin="false",
    ):
        yield


@pytest.fixture(scope="module")
def facts(spark):
    """Commits: a third by one committer name, a third without any account."""
    return spark.range(0, 300_000, 1, 8).select(
        F.lit("r").alias("repo_full_name"),
        F.col("id").alias("seq"),
        F.concat(F.lit("sha"), F.col("id")).alias("commit_sha"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("n"), F.col("id") % 1000)).alias("committer_name"),
        F.when(F.col("id") % 3 == 1, F.concat(F.lit("P"), F.col("id") % 50)).alias("author"),
        F.lit(None).cast("string").alias("committer"),
    )


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_lookup_splits_the_hot_key(spark, facts, small_thresholds):
    names = facts.select("repo_full_name", F.col("committer_name").alias("key")).distinct().withColumn("value", F.upper("key"))
    found = lookups.lookup(facts, names, {"repo_full_name": "repo_full_name", "committer_name": "key"}, {"value": "value"})
    assert len(found.where("value = 'HOT'").select("seq", "value").collect()) == 100_000
    found.collect()
    assert "skewed" in final_plan(found)


def test_resolution_splits_the_hot_name(spark, frame, facts, small_thresholds):
    users = frame(
        "repo_full_name string, seq long, anonym_uuid string, name string, email string, login string, alias array<string>",
        {"repo_full_name": "r", "seq": 1, "anonym_uuid": "P0", "alias": ["hot"]},
    )
    df = identity.resolve(facts, users)
    rows = df.collect()
    assert len(rows) == 300_000
    assert sum(r["author"] == "P0" for r in rows if r["committer_name"] == "hot") == 100_000
    assert "skewed" in final_plan(df)


@pytest.mark.parametrize("check", [lookups.known_only, lookups.unknown_only])
def test_membership_splits_the_hot_key(facts, small_thresholds, check):
    known = facts.where("seq % 2 = 0 and committer_name like 'hot'" if check is lookups.known_only else "committer_name <> 'hot'")
    df = check(facts, known, ["repo_full_name", "committer_name"])
    assert len(df.collect()) == 100_000
    assert "skewed" in final_plan(df)


def test_representatives_and_arrays_split_the_hot_key(facts, small_thresholds):
    df = identity.propagate_representative(facts, ["author"])
    assert sum(r["author"] is None for r in df.collect() if r["committer_name"] == "hot") == 100_000
    assert "skewed" in final_plan(df)
    listed = facts.select("repo_full_name", "seq", F.array("committer_name", F.lit("main")).alias("branches"))
    names = facts.select("repo_full_name", F.col("committer_name").alias("id"), F.upper("committer_name").alias("anonym_uuid")).distinct()
    df = lookups.array_lookup(listed, names, "branches", "mapped", ["repo_full_name"])
    assert sum(r["mapped"] == ["HOT", None] for r in df.collect()) == 100_000
    assert "skewed" in final_plan(df)


def test_nothing_is_lost_where_groups_are_cut(facts):
    total = facts.count()
    numbered = with_position(facts.select("committer_name", "seq"), ["seq"], ["committer_name"], "p")
    sizes = numbered.groupBy("committer_name").agg(F.count("*").alias("n"), F.max("p").alias("last"), F.countDistinct("p").alias("d"))
    assert sizes.agg(F.sum("n")).first()[0] == total
    assert sizes.where("last <> n - 1 or d <> n").count() == 0


def test_ranges_of_a_hot_group_are_even_and_bounded_at_any_size(facts):
    from repolume.functions.ranking import _in_ranges

    key = F.struct("committer_name", "seq")
    for rows in (15_000, 300_000):  # twenty times the rows, as many rows in a range
        table = facts.select("committer_name", "seq").where(f"seq < {rows}")
        ranges = rows // 5_000
        sizes = [r["count"] for r in _in_ranges(table, key, ranges, rows).groupBy("_range").count().collect()]
        assert sum(sizes) == rows and len(sizes) > 0.6 * ranges and max(sizes) < 3 * 5_000


def test_counts_before_joins(facts):
    edits = facts.select("repo_full_name", F.lit("sha0").alias("commit_sha"), F.lit(1).alias("total_added_lines"), F.lit(0).alias("total_removed_lines"))
    commits = facts.where("seq < 1000").select("repo_full_name", "commit_sha", F.lit("A").alias("author"))
    assert tuple(aggregates.share_changed_lines(edits, commits).first()) == ("r", "A", 300_000, 1.0)
    tables = {"edits": edits, "commits": commits}
    wanted = [r for r in relations.RELATIONS if r.child == "edits"]
    assert tuple(relations.audit(tables, wanted).first())[1:] == (300_000, 0)
    assert incremental.cap_modifications(edits, 1000).count() == 0


@pytest.mark.parametrize("fan", [4, 7, 1024])
def test_ranges_are_cut_in_levels(spark, facts, monkeypatch, fan):
    """However many ranges, no list of cut points outgrows one level; positions are those of a plain numbering."""
    from repolume.functions import ranking

    monkeypatch.setattr(ranking, "FAN", fan)
    key = F.struct("committer_name", "seq")
    table = facts.select("committer_name", F.when(F.col("seq") % 50 > 0, F.col("seq")).alias("seq")).where("seq < 40000 or seq is null")
    rows = table.count()
    cut = ranking._in_ranges(table, key, 60, rows)
    sizes = [r["count"] for r in cut.groupBy("_range").count().collect()]
    assert sum(sizes) == rows and len(sizes) > 30
    assert cut.groupBy("_range").agg(F.min(key).alias("a"), F.max(key).alias("b")).orderBy("_range").selectExpr(
        "a > lag(b) OVER (ORDER BY _range) AS apart").where("NOT apart").count() == 0
    unique = facts.where("seq < 20000").select("committer_name", "seq")
    for ascending in (True, False):
        numbered = with_position(unique, ["seq"], ["committer_name"], "p", ascending, per_range=500)
        order = "seq" if ascending else "seq DESC"
        plain = unique.selectExpr("*", f"row_number() OVER (PARTITION BY committer_name ORDER BY {order}) - 1 AS q")
        assert numbered.join(plain, ["committer_name", "seq"]).where("p <> q").count() == 0
        assert numbered.count() == 20000


def test_cut_points_are_no_array_of_all_ranges(spark, facts, monkeypatch):
    from repolume.functions import ranking

    monkeypatch.setattr(ranking, "FAN", 16)
    table, most = facts.select("committer_name", "seq"), []
    for rows in (15_000, 300_000):
        part = table.where(f"seq < {rows}").withColumn("_range", F.lit(0).cast("long"))
        key, ranges = F.struct("committer_name", "seq"), rows // 500
        levels = ranking._levels(ranges)
        assert all(parts <= 16 for parts in levels)
        cuts = ranking._cut_points(part, key, levels[0], levels[0] * ranking._SAMPLES / rows)
        most.append(cuts.select(F.size("_cuts")).first()[0])
    assert most[1] <= 15 and most[0] <= 15


def test_slices_of_many_ranges(facts):
    from repolume.functions.ranking import slice_by_position

    unique = facts.where("seq < 20000").select("committer_name", "seq")
    for offset, limit in ((0, 3), (700, 900), (6000, 5000)):
        got = slice_by_position(unique, ["seq"], offset, limit, ["committer_name"], per_range=500)
        plain = unique.selectExpr("*", "row_number() OVER (PARTITION BY committer_name ORDER BY seq) - 1 AS q")
        want = plain.where(f"q >= {offset} AND q < {offset + limit}").select("committer_name", "seq")
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
