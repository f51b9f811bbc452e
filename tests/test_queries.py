"""Every registered query against its SQL, and the shape of the physical plans."""

import re

import pytest

import __spark_entry__
from compare import connect, differences
from repolume.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
WRITES = {
    "stored_table_replace", "registry_roundtrip", "stream_cursor_ingest", "export_roundtrip", "users_insert", "stream_store_ingest", "refresh_versions", "wanted_issues",
    "refresh_summary",
}


@pytest.fixture(scope="module")
def database():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_gives_what_its_sql_gives(spark, database, name):
    problem, _ = differences(spark, database, SF, name)
    assert problem is None


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(ORACLES) == set(QUERIES)
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_plans(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    python = "Python" in plan or "MapInPandas" in plan
    assert python == name.startswith("log_archive"), "Python runs where archives are unpacked, nowhere else"
    assert "CartesianProduct" not in plan
    # a nested loop only against one broadcast row
    for match in re.finditer(r"BroadcastNestedLoopJoin (\w+), (\w+)", plan):
        assert match.group(1) == "BuildRight" and match.group(2) in ("Inner", "LeftOuter")


@pytest.mark.parametrize("name", ["latest_per_id", "upsert_refresh", "stitch_pages", "events_overflow_union", "top_n_per_parent", "project_users", "next_pages"])
def test_groups_are_trimmed_before_the_shuffle(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert re.search(r"Exchange hashpartitioning.*\n.*WindowGroupLimit.*Partial", plan)


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(QUERIES["state_sorted"](spark, SF))
    assert "EqualTo(o_orderstatus,O)" in plan and "o_totalprice" not in plan
    plan = plan_of(QUERIES["cursor_page"](spark, SF))
    assert "GreaterThanOrEqual(ts" in plan and "props" not in plan
    assert "l_extendedprice" not in plan_of(QUERIES["share_changed_lines"](spark, SF))


def test_a_count_of_many_tables_is_one_shuffle(spark):
    from repolume.operators.aggregates import counts_per_key

    tables = {name: spark.read.parquet(f"{SF}/orders.parquet").withColumnRenamed("o_orderstatus", "repo_full_name") for name in "abcd"}
    assert plan_of(counts_per_key(tables)).count("Exchange") == 1
