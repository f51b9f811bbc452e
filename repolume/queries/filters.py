"""Filters on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repolume.functions.people import real_user_id
from repolume.functions.scalars import owner_of, split_list
from repolume.operators.filters import (
    clean_branch_names,
    equal_or_rest,
    present,
    pull_requests_only,
    select_repositories,
)
from repolume.queries.base import Source, as_json, query, user
from repolume.schemas import REPO

c, lit, when = F.col, F.lit, F.when


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderpriority LIKE '1%'")
def pr_only_filter(t: Source) -> DataFrame:
    flagged = t.orders.withColumn("is_pull_request", c("o_orderpriority").startswith("1"))
    return pull_requests_only(flagged).select("o_orderkey", "o_custkey")


@query("SELECT o_orderkey, nullif(o_orderstatus, 'P') AS state FROM orders WHERE nullif(o_orderstatus, 'P') IS NOT NULL")
def not_null_filter(t: Source) -> DataFrame:
    return present(t.orders.select("o_orderkey", F.nullif("o_orderstatus", lit("P")).alias("state")), "state")


@query(
    """
    SELECT o_orderpriority = '1-URGENT' AS is_service, count(*) AS commits, sum(o_custkey)::BIGINT AS total
    FROM orders GROUP BY 1
    """
)
def service_split(t: Source) -> DataFrame:
    split = equal_or_rest(t.orders, "o_orderpriority", "1-URGENT", "is_service")
    return split.groupBy("is_service").agg(F.count("*").alias("commits"), F.sum("o_custkey").alias("total"))


@query(
    """
    SELECT p_partkey, p_name FROM part
    WHERE (contains(p_name, 'red') OR contains(p_name, 'ring') OR contains(p_name, 'old'))
      AND NOT (contains(p_name, 'widget') OR contains(p_name, 'cold'))
    """
)
def whitelist_blacklist(t: Source) -> DataFrame:
    parts = t.part.select("p_partkey", "p_name")
    return select_repositories(parts, ["red", "ring", "old"], ["widget", "cold"], "p_name")


@query(
    """
    SELECT c_custkey, CASE WHEN NOT (c_mktsegment = 'MACHINERY' AND c_nationkey >= 10) THEN c_name END AS node_id
    FROM customer
    """
)
def placeholder_identity(t: Source) -> DataFrame:
    login = when(c("c_mktsegment") == "MACHINERY", "invalid-email-address").otherwise(c("c_name"))
    person = user(c("c_name"), when(c("c_nationkey") < 10, c("c_name")), None, login)
    return t.customer.select("c_custkey", person.alias("user")).select("c_custkey", real_user_id(c("user")).alias("node_id"))


@query(
    """
    WITH hosts AS (
      SELECT DISTINCT split_part(url, '/', 4) AS repo_full_name, split_part(url, '/', 3) AS host,
             starts_with(url, 'https') AS secure
      FROM pages
    ), local AS (SELECT DISTINCT repo_full_name, host FROM hosts WHERE secure)
    SELECT repo_full_name, host AS branch, true AS is_local FROM local
    UNION ALL
    SELECT DISTINCT h.repo_full_name, h.host, false FROM hosts h
    WHERE NOT EXISTS (SELECT 1 FROM local l WHERE l.repo_full_name = h.repo_full_name AND l.host = h.host)
    """
)
def ref_name_cleanup(t: Source) -> DataFrame:
    """Hosts of the pages as branches: every host is a remote ref, secure ones are local refs too."""
    host = F.split_part("url", lit("/"), lit(3))
    refs = t.pages.select(
        F.split_part("url", lit("/"), lit(4)).alias(REPO),
        F.explode(
            F.array(
                F.concat(lit("refs/remotes/origin/"), host),
                when(c("url").startswith("https"), F.concat(lit("refs/heads/"), host)),
                lit("refs/remotes/origin/HEAD"),
                F.concat(lit("refs/tags/"), host),
            )
        ).alias("ref"),
    )
    return clean_branch_names(refs)


@query(
    """
    SELECT p_partkey, split_part(p_name, ' ', 1) AS owner, len(string_split(p_name, ' '))::BIGINT AS n_words,
           to_json(string_split(p_name, ' '))::VARCHAR AS words, concat(p_brand, '/', p_type) AS full_name,
           length(p_name)::BIGINT AS n_chars, replace(p_name, ' ', '_') AS slug
    FROM part
    """
)
def text_functions(t: Source) -> DataFrame:
    words = split_list(c("p_name"), " ")
    df = t.part.select(
        "p_partkey",
        owner_of(F.replace("p_name", lit(" "), lit("/"))).alias("owner"),
        F.size(words).cast("long").alias("n_words"),
        words.alias("words"),
        F.concat_ws("/", "p_brand", "p_type").alias("full_name"),
        F.length("p_name").cast("long").alias("n_chars"),
        F.replace("p_name", lit(" "), lit("_")).alias("slug"),
    )
    return as_json(df, "words")
