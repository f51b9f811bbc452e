"""Counts, summaries and shares on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repolume.functions.scalars import edit_distance
from repolume.operators import aggregates
from repolume.plans.summary import refresh_summary as lay_over
from repolume.plans.summary import summary_keys
from repolume.queries.base import Source, as_json, naive, query, tag, text
from repolume.schemas import REPO
from repolume.session import scratch_dir
from repolume.sources.tables import read_table

c, lit, when = F.col, F.lit, F.when


@query(
    """
    SELECT o_orderstatus AS repo, o_custkey AS author, lines::BIGINT AS changed_lines,
           round(lines::DOUBLE / (sum(lines) OVER (PARTITION BY o_orderstatus))::DOUBLE, 9) AS share
    FROM (
      SELECT o_orderstatus, o_custkey, sum((l_quantity + l_linenumber)::DECIMAL(18, 2)) AS lines
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2
    )
    """
)
def share_changed_lines(t: Source) -> DataFrame:
    """Contribution of every author by changed lines; one repository per order status."""
    # the repository of an edit is the one of its commit, which the test table does not repeat
    edits = t.lineitem.select(
        c("l_orderkey").alias("commit_sha"), c("l_quantity").alias("added"), c("l_linenumber").alias("removed")
    )
    commits = t.orders.select(
        c("o_orderkey").alias("commit_sha"), c("o_orderstatus").alias("repo"), c("o_custkey").alias("author")
    )
    # hundredths of a line as whole numbers: exact sums, and no decimal arithmetic per edit
    lines = F.round((c("added") + c("removed")) * 100).cast("long")
    per_commit = edits.groupBy("commit_sha").agg(F.sum(lines).alias("changed_lines"))
    owned = per_commit.join(commits, "commit_sha")
    shares = aggregates.share_of_total(owned, ["repo", "author"], ["repo"], "changed_lines")
    return shares.withColumn("changed_lines", F.round(c("changed_lines") / 100).cast("long"))


@query(
    """
    SELECT author, distance::BIGINT AS edit_distance, round(distance::DOUBLE / (sum(distance) OVER ())::DOUBLE, 9) AS share
    FROM (
      SELECT o_custkey AS author, sum(levenshtein(p_name, p_type)) AS distance
      FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey GROUP BY 1
    )
    """
)
def share_edit_distance(t: Source) -> DataFrame:
    """Contribution of every author by edit distance: each line of an order edits the name of a part into its type."""
    files = t.part.select("p_partkey", edit_distance(c("p_name"), c("p_type")).cast("long").alias("levenshtein_dist"))
    edits = t.lineitem.join(files, c("l_partkey") == c("p_partkey")).select(
        c("l_orderkey").alias("commit_sha"), "levenshtein_dist"
    )
    commits = t.orders.select(c("o_orderkey").alias("commit_sha"), c("o_custkey").alias("author"))
    return aggregates.share_edit_distance(edits, commits, ())


@query(
    """
    SELECT s_nationkey::VARCHAR AS repo_full_name, o_custkey AS author, sum(l_quantity + l_linenumber)::BIGINT AS changed_lines,
           round(sum(l_quantity + l_linenumber)::DOUBLE
                 / (sum(sum(l_quantity + l_linenumber)) OVER (PARTITION BY s_nationkey))::DOUBLE, 9) AS share
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_nationkey, o_custkey
    """
)
def share_changed_lines_by_repository(t: Source) -> DataFrame:
    """The metric on tables with a repository column: supplier nation as repository, one commit per order in it."""
    nation = t.supplier.select("s_suppkey", text("s_nationkey").alias(REPO))
    edits = t.lineitem.join(nation, c("l_suppkey") == c("s_suppkey")).select(
        REPO, c("l_orderkey").alias("commit_sha"), c("l_quantity").cast("long").alias("total_added_lines"),
        c("l_linenumber").cast("long").alias("total_removed_lines"),
    )
    authors = t.orders.select(c("o_orderkey").alias("commit_sha"), c("o_custkey").alias("author"))
    commits = edits.select(REPO, "commit_sha").distinct().join(authors, "commit_sha")
    return aggregates.share_changed_lines(edits, commits)


@query(
    """
    SELECT (SELECT count(*) FROM events) AS rows, (SELECT count(nullif(event_type, 'view')) FROM events) AS present,
           (SELECT max(ts) FROM events) AS last_update
    """
)
def table_counts(t: Source) -> DataFrame:
    """Rows, values present and newest time of one table."""
    events = t.events.withColumn("kind", F.nullif("event_type", lit("view")))
    return events.agg(
        F.count("*").alias("rows"), F.count("kind").alias("present"), F.max("ts").alias("last_update")
    )


@query("SELECT count(*) AS rows FROM lineitem")
def collection_count(t: Source) -> DataFrame:
    return aggregates.count_rows(t.lineitem)


@query("SELECT count(nullif(l_linestatus, 'O')) AS present FROM lineitem")
def present_count(t: Source) -> DataFrame:
    closed = t.lineitem.select(F.nullif("l_linestatus", lit("O")).alias("status"))
    return aggregates.count_present(closed, "status", "present")


@query("SELECT user_id, max(ts) AS last_update FROM events GROUP BY 1")
def last_update(t: Source) -> DataFrame:
    return aggregates.latest(t.events, "ts", ["user_id"])


@query("SELECT DISTINCT o_orderstatus, nullif(o_orderpriority, '5-LOW') AS name FROM orders WHERE o_orderpriority <> '5-LOW'")
def distinct_names(t: Source) -> DataFrame:
    named = t.orders.select("o_orderstatus", F.nullif("o_orderpriority", lit("5-LOW")).alias("name"))
    return aggregates.distinct_values(named, "name", ["o_orderstatus"])


@query(
    """
    SELECT user_id, min(ts) FILTER (WHERE event_type = 'click') AS first_click,
           min(ts) FILTER (WHERE event_type = 'view') AS first_view, min(ts) FILTER (WHERE event_type = 'error') AS first_error,
           min(ts) FILTER (WHERE event_type = 'signup') AS first_signup,
           min(ts) FILTER (WHERE event_type = 'purchase') AS first_purchase
    FROM events GROUP BY 1
    """
)
def first_appearance_pivot(t: Source) -> DataFrame:
    names = {f"first_{kind}": kind for kind in ("click", "view", "error", "signup", "purchase")}
    return aggregates.first_value_per_name(t.events, names, ["user_id"], "event_type", "ts", ["ts", "event_id"])


@query(
    """
    WITH listed AS (SELECT c_nationkey, c_custkey, nullif(c_mktsegment, 'BUILDING') AS company FROM customer)
    SELECT c_nationkey,
           coalesce(to_json(list(company ORDER BY c_custkey) FILTER (WHERE company IS NOT NULL))::VARCHAR, '[]')
               AS contributor_companies,
           count(company) AS contributor_companies_count
    FROM listed GROUP BY 1
    """
)
def companies_list(t: Source) -> DataFrame:
    """Nations are records that carry their customers as contributors."""
    person = F.struct("c_custkey", F.nullif("c_mktsegment", lit("BUILDING")).alias("company"))
    records = t.customer.groupBy("c_nationkey").agg(F.array_sort(F.collect_list(person)).alias("contributors"))
    companies = aggregates.contributor_companies(c("contributors"))
    listed = records.select("c_nationkey", companies.alias("contributor_companies"))
    counted = listed.withColumn("contributor_companies_count", F.size("contributor_companies").cast("long"))
    return as_json(counted, "contributor_companies")


@query(
    """
    SELECT user_id, pos // 20 AS chunk, to_json(list(event_type ORDER BY ts, event_id))::VARCHAR AS event_types
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos FROM events)
    GROUP BY 1, 2
    """
)
def list_per_parent(t: Source) -> DataFrame:
    """Events of every user as ordered arrays of twenty."""
    listed = aggregates.list_per_parent(t.events, ["user_id"], "event_type", ["ts", "event_id"], 20, "event_types")
    return as_json(listed, "event_types")


def _repository_of(df: DataFrame, column: str) -> DataFrame:
    return df.select(tag("org/", column).alias(REPO))


_SQL_SUMMARY = """
    WITH o AS (SELECT o_custkey, count(*) AS commits, max(o_orderdate) AS last_date FROM orders GROUP BY 1),
    l AS (
      SELECT o_custkey, count(*) AS edits,
             min(CASE WHEN l_linenumber = 1 THEN o_orderdate END) AS readme,
             min(CASE WHEN l_linenumber = 2 THEN o_orderdate END) AS security,
             min(CASE WHEN l_linenumber = 3 THEN o_orderdate END) AS templates
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1
    ),
    e AS (SELECT user_id, count(*) AS events FROM events GROUP BY 1),
    n AS (SELECT s_nationkey, count(*) AS suppliers FROM supplier GROUP BY 1)
    SELECT concat('org/', c_custkey) AS repo_full_name, c_name AS repo_name,
           CASE WHEN c_nationkey < 5 THEN 'not known' ELSE c_mktsegment END AS organization_name,
           CASE WHEN c_nationkey < 5 THEN 'not known' ELSE 'Organization' END AS repo_type,
           'org' AS user_name, c_custkey AS stars, c_nationkey::BIGINT AS size, 0::BIGINT AS contributor_count,
           CASE WHEN c_nationkey < 5 THEN '[]' ELSE to_json([c_mktsegment])::VARCHAR END AS contributor_companies,
           CASE WHEN c_nationkey < 5 THEN 0 ELSE 1 END::BIGINT AS contributor_companies_count,
           0::BIGINT AS branch_count, coalesce(commits, 0) AS commit_count, last_date AS last_commit_date,
           coalesce(edits, 0) AS pullrequest_review_count, coalesce(events, 0) AS issues_count,
           coalesce(commits, 0) AS pullrequest_count, coalesce(suppliers, 0) AS workflow_count,
           CASE WHEN c_nationkey < 10 THEN 0 ELSE length(c_name) END::BIGINT AS readme_length,
           c_acctbal > 0 AS has_wiki, false AS has_pages, readme AS file_readme, security AS file_security,
           templates AS "file_IssuePR_templates", NULL::TIMESTAMP AS file_support
    FROM customer LEFT JOIN o ON o.o_custkey = c_custkey LEFT JOIN l ON l.o_custkey = c_custkey
         LEFT JOIN e ON user_id = c_custkey LEFT JOIN n ON s_nationkey = c_custkey
    """


def _summary_inputs(t: Source) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Customers as repositories, their orders as commits, the lines of the orders as edits."""
    time, words = lit(None).cast("timestamp_ntz"), lit(None).cast("string")
    company = F.struct(tag("C", "c_custkey").alias("node_id"), when(c("c_nationkey") >= 5, c("c_mktsegment")).alias("company"))
    repositories = t.customer.select(
        c("c_name").alias("name"), tag("org/", "c_custkey").alias("full_name"), time.alias("created_at"),
        c("c_custkey").alias("stargazers_count"), c("c_nationkey").cast("long").alias("size"), words.alias("url"),
        words.alias("html_url"), (c("c_acctbal") > 0).alias("has_wiki"), lit(None).cast("boolean").alias("has_pages"),
        lit(True).alias("has_projects"), lit(True).alias("has_downloads"), c("c_custkey").alias("watchers_count"),
        lit(False).alias("fork"), c("c_mktsegment").alias("language"),
        when(
            c("c_nationkey") >= 5, F.struct(c("c_mktsegment").alias("name"), lit("Organization").alias("type"))
        ).alias("organization"),
        when(c("c_nationkey") >= 10, c("c_name")).alias("readme_content"), F.array(company).alias("contributors"),
    )
    owner = t.orders.select("o_orderkey", "o_custkey")
    lines = t.lineitem.select("l_orderkey", "l_linenumber").join(owner, c("l_orderkey") == c("o_orderkey"))
    filename = when(c("l_linenumber") == 1, "README.md").when(c("l_linenumber") == 2, "SECURITY.md").when(
        c("l_linenumber") == 3, ".github/ISSUE_TEMPLATE/config.yml").otherwise("src/main.py")
    edits = lines.select(tag("org/", "o_custkey").alias(REPO), filename.alias("filename"), c("l_orderkey").alias("commit_sha"))
    log = t.orders.select(
        tag("org/", "o_custkey").alias(REPO), c("o_orderkey").alias("commit_sha"), c("o_orderdate").alias("author_date"),
        c("o_orderdate").alias("committed_at"),
    )
    return repositories, log, edits


def _shown_summary(summary: DataFrame) -> DataFrame:
    shown = summary.select(
        REPO, "repo_name", "organization_name", "repo_type", "user_name", "stars", "size", "contributor_count",
        "contributor_companies", "contributor_companies_count", "branch_count", "commit_count", "last_commit_date",
        "pullrequest_review_count", "issues_count", "pullrequest_count", "workflow_count", "readme_length", "has_wiki",
        "has_pages", "file_readme", "file_security", "file_IssuePR_templates", "file_support",
    )
    return as_json(naive(shown), "contributor_companies")


@query(_SQL_SUMMARY)
def repository_summary(t: Source) -> DataFrame:
    """Customers as repositories: their orders, lines and events are what the summary counts."""
    repositories, log, edits = _summary_inputs(t)
    sources = {
        "commits": log, "pull_requests": log, "review_comments": edits,
        "issues": _repository_of(t.events, "user_id"), "workflows": _repository_of(t.supplier, "s_nationkey"),
    }
    summary = aggregates.repository_summary(repositories, sources, log, edits, companies=True)
    return _shown_summary(summary)


@query(_SQL_SUMMARY.replace("coalesce(edits, 0) AS pullrequest_review_count", "0::BIGINT AS pullrequest_review_count"))
def refresh_summary(t: Source) -> DataFrame:
    """The summary of a whole landing, out of two that overlap: edits land before their commits and after them."""
    spark, root = t.spark, scratch_dir(t.spark, "summary")
    repositories, log, edits = _summary_inputs(t)
    described = aggregates.repository_summary(repositories, {}, companies=True)
    events = t.events.select(tag("org/", "user_id").alias(REPO), c("event_id").alias("id"))
    suppliers = t.supplier.select(tag("org/", "s_nationkey").alias(REPO), c("s_suppkey").alias("id"))
    for part, landed in ((0, described), (1, described.limit(0))):
        of = lambda df, number: df.where(number % 3 != part)  # noqa: E731, B023
        commits = of(log, c("commit_sha"))
        sources = {
            "pull_requests": commits.withColumnRenamed("commit_sha", "id"), "issues": of(events, c("id")),
            "workflows": of(suppliers, c("id")),
        }
        keys = summary_keys(sources, commits, of(edits, F.xxhash64("commit_sha", "filename")))
        lay_over(spark, root, keys, landed)
    return _shown_summary(read_table(spark, root, "repository"))


@query("SELECT page_id, levenshtein(url, replace(url, 'example', 'test'))::BIGINT AS distance FROM pages")
def edit_distance_of_versions(t: Source) -> DataFrame:
    """Edit distance of two versions of a text: the url of a page, and the url after an edit."""
    versions = t.pages.select("page_id", c("url").alias("pre_text"), F.replace("url", lit("example"), lit("test")).alias("post_text"))
    return versions.select("page_id", edit_distance(c("pre_text"), c("post_text")).cast("long").alias("distance"))


@query("SELECT doc_id, (least(length(coalesce(text, '')), 20) + 1)::BIGINT AS distance FROM documents")
def edit_distance_of_long_versions(t: Source) -> DataFrame:
    """Edit distance of whole documents and of what an edit makes of them: characters that no text has are put into
    their middle, as many as the text has, but at most twenty, and one more."""
    text = F.coalesce("text", lit(""))
    middle = F.floor(F.length(text) / 2).cast("int")
    mark = F.repeat(lit("\u0001"), F.least(F.length(text), lit(20)) + 1)
    edited = F.concat(F.substring(text, lit(1), middle), mark, F.substring(text, middle + 1, F.length(text)))
    return t.documents.select("doc_id", edit_distance(text, edited).cast("long").alias("distance"))
