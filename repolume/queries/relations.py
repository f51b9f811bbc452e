"""Joins along foreign keys on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repolume.functions.scalars import url_number, url_repository
from repolume.operators import projections, relations
from repolume.operators.lookups import known_only, unknown_only
from repolume.operators.relations import Relation
from repolume.operators.setops import union_tagged
from repolume.queries.base import Source, query, tag
from repolume.queries.records import raw_comments
from repolume.schemas import REPO

c, lit, when = F.col, F.lit, F.when


def _flagged_issues(lineitem: DataFrame) -> DataFrame:
    """Returned lines as issues that are pull requests."""
    return lineitem.select(c("l_orderkey").alias("number"), (c("l_returnflag") == "R").alias("is_pull_request"))


@query(
    "SELECT o_orderkey AS number FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')"
)
def semi_by_number(t: Source) -> DataFrame:
    pulls = t.orders.select(c("o_orderkey").alias("number"))
    return relations.flagged_pull_requests(pulls, _flagged_issues(t.lineitem), ())


@query(
    """
    SELECT o_orderkey AS number FROM orders
    WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
    """
)
def missing_parents(t: Source) -> DataFrame:
    pulls = t.orders.select(c("o_orderkey").alias("number"))
    return relations.missing_issues(pulls, _flagged_issues(t.lineitem), ())


@query(
    """
    SELECT (SELECT count(*) FROM lineitem WHERE l_returnflag = 'R') AS flagged_issues,
           (SELECT count(*) FROM orders) AS pull_requests,
           (SELECT count(*) FROM lineitem WHERE l_returnflag = 'R') >= (SELECT count(*) FROM orders) AS complete
    """
)
def issues_complete(t: Source) -> DataFrame:
    return relations.issues_complete(t.orders.select(c("o_orderkey").alias("number")), _flagged_issues(t.lineitem))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def membership_guard(t: Source) -> DataFrame:
    known = t.customer.where(c("c_acctbal") > 0).select(c("c_custkey").alias("o_custkey"))
    return known_only(t.orders.select("o_orderkey", "o_custkey"), known, ["o_custkey"])


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def unknown_only_insert(t: Source) -> DataFrame:
    """Users to insert: customers that no closed order knows yet."""
    known = t.orders.where(c("o_orderstatus") == "F").select(c("o_custkey").alias("c_custkey"))
    return unknown_only(t.customer.select("c_custkey", "c_name"), known, ["c_custkey"])


_AUDITED = (
    Relation("lineitem", "l_orderkey", "orders", "o_orderkey"),
    Relation("lineitem", "l_partkey", "part", "p_partkey"),
    Relation("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    Relation("orders", "o_custkey", "customer", "c_custkey"),
    Relation("events", "user_id", "customer", "c_custkey"),
    Relation("events", "event_id", "orders", "o_orderkey", when="event_type = 'error'"),
    Relation("customer", "c_nationkey", "nation", "n_nationkey"),
    Relation("nation", "n_regionkey", "region", "r_regionkey"),
    Relation("labels", "doc_id", "documents", "doc_id"),
    Relation("documents", "doc_id", "labels", "doc_id"),
    Relation("pages", "page_id", "supplier", "s_suppkey"),
)


def _sql_audit(relation: Relation) -> str:
    only = f"WHERE {relation.when}" if relation.when else ""
    return f"""
    SELECT '{relation.name}' AS relation, count(*) AS refs,
           count(*) FILTER (WHERE {relation.column} NOT IN (SELECT {relation.key} FROM {relation.parent})) AS orphans
    FROM {relation.child} {only}
    """


@query(" UNION ALL ".join(_sql_audit(relation) for relation in _AUDITED))
def fk_audit(t: Source) -> DataFrame:
    names = {name for relation in _AUDITED for name in (relation.child, relation.parent)}
    return relations.audit({name: getattr(t, name) for name in names}, _AUDITED, ())


@query(
    """
    SELECT l_orderkey AS number, l_linenumber, l_partkey, o_orderpriority AS title, o_orderstatus AS state, o_custkey AS author
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderpriority LIKE '1%'
    """
)
def pr_issue_complete(t: Source) -> DataFrame:
    pulls = t.lineitem.select(c("l_orderkey").alias("number"), "l_linenumber", "l_partkey")
    issues = t.orders.select(
        c("o_orderkey").alias("number"), c("o_orderpriority").alias("title"), c("o_orderstatus").alias("state"),
        c("o_custkey").alias("author"), c("o_orderpriority").startswith("1").alias("is_pull_request"),
    )
    return relations.complete_pull_requests(pulls, issues, ["title", "state", "author"], ())


@query(
    """
    WITH issues AS (SELECT conv_id, text AS title FROM conversations WHERE turn = 0)
    SELECT c.conv_id * 1000 + turn AS id, c.conv_id AS issue, issues.title,
           c.conv_id AS parent_number, 'org/chat' AS parent_repository
    FROM conversations c LEFT JOIN issues ON issues.conv_id = c.conv_id
    """
)
def comment_parent_url(t: Source) -> DataFrame:
    """Comments with their issue (the opening turn), joined by url, and the natural key inside the url."""
    comments = projections.issue_comments(raw_comments(t.conversations))
    issues = t.conversations.where(c("turn") == 0).select(
        lit("org/chat").alias(REPO), tag("https://host/repos/org/chat/issues/", "conv_id").alias("url"),
        c("text").alias("title"),
    )
    found = relations.comments_with_issue(comments, issues, {"title": "title"})
    keyed = relations.with_url_key(found, "issue_url", "parent_number", "parent_repository")
    return keyed.select("id", c("parent_number").alias("issue"), "title", "parent_number", "parent_repository")


@query(
    """
    SELECT page_id, NULLIF(regexp_extract(api, '/repos/([^/]+/[^/]+)/[a-z]+/([0-9]+)$', 1), '') AS repository,
           NULLIF(regexp_extract(api, '/repos/([^/]+/[^/]+)/[a-z]+/([0-9]+)$', 2), '')::BIGINT AS number
    FROM (SELECT page_id, replace(url, '://', '://api/repos/org/x/') AS url,
                 concat('https://api/repos/', split_part(url, '/', 3), '/', split_part(url, '/', 4), '/issues/',
                        split_part(url, '/', 5)) AS api
          FROM pages)
    """
)
def url_keys(t: Source) -> DataFrame:
    """Repository and number out of record urls; those with anything after the number have no key."""
    part = lambda n: F.split_part("url", lit("/"), lit(n))
    api = F.concat(lit("https://api/repos/"), part(3), lit("/"), part(4), lit("/issues/"), part(5))
    pages = t.pages.select("page_id", api.alias("api"))
    return pages.select("page_id", url_repository(c("api")).alias("repository"), url_number(c("api")).alias("number"))


@query(
    """
    SELECT event_id, c_name AS issue_name, o_orderstatus AS commit_status
    FROM events LEFT JOIN customer ON user_id = c_custkey LEFT JOIN orders ON event_id = o_orderkey
    """
)
def event_parent(t: Source) -> DataFrame:
    """Events with their issue by id and their commit by sha."""
    repo = lit("org/x").alias(REPO)
    events = t.events.select(repo, "event_id", c("user_id").alias("issue_id"), c("event_id").alias("commit_sha"))
    issues = t.customer.select(repo, c("c_custkey").alias("id"), "c_name")
    commits = t.orders.select(repo, c("o_orderkey").alias("commit_sha"), "o_orderstatus")
    found = relations.events_with_issue(events, issues, {"c_name": "issue_name"})
    found = relations.events_with_commit(found, commits, {"o_orderstatus": "commit_status"})
    return found.select("event_id", "issue_name", "commit_status")


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, s_name AS workflow_name, o_orderpriority AS commit_message
    FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN orders ON l_orderkey = o_orderkey
    """
)
def run_parent(t: Source) -> DataFrame:
    """Runs with their workflow and their commit."""
    repo = lit("org/x").alias(REPO)
    runs = t.lineitem.select(
        repo, c("l_orderkey").alias("commit_sha"), "l_linenumber", "l_partkey", c("l_suppkey").alias("workflow_id")
    )
    found = relations.runs_with_workflow(
        runs, t.supplier.select(repo, c("s_suppkey").alias("id"), "s_name"), {"s_name": "workflow_name"}
    )
    commits = t.orders.select(repo, c("o_orderkey").alias("commit_sha"), "o_orderpriority")
    found = relations.runs_with_commit(found, commits, {"o_orderpriority": "commit_message"})
    return found.withColumnsRenamed({"commit_sha": "l_orderkey", "workflow_id": "l_suppkey"}).drop(REPO)


@query(
    """
    SELECT o_custkey AS author, count(*) AS edits, sum(l_linenumber)::BIGINT AS lines
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1
    """
)
def edit_parent(t: Source) -> DataFrame:
    """Edits with the author of their commit, counted per author."""
    repo = lit("org/x").alias(REPO)
    edits = t.lineitem.select(repo, c("l_orderkey").alias("commit_sha"), "l_linenumber")
    commits = t.orders.select(repo, c("o_orderkey").alias("commit_sha"), c("o_custkey").alias("author"))
    found = relations.edits_with_commit(edits, commits, {"author": "author"})
    return found.where(c("author").isNotNull()).groupBy("author").agg(
        F.count("*").alias("edits"), F.sum("l_linenumber").alias("lines")
    )


@query(
    """
    SELECT event_id AS id, event_type AS state, o_orderstatus AS pull_request_state
    FROM events LEFT JOIN orders ON user_id = o_orderkey
    """
)
def review_parent(t: Source) -> DataFrame:
    repo = lit("org/x").alias(REPO)
    reviews = t.events.select(repo, c("event_id").alias("id"), c("event_type").alias("state"), c("user_id").alias("pull_request_id"))
    pulls = t.orders.select(repo, c("o_orderkey").alias("id"), "o_orderstatus")
    found = relations.reviews_with_pull_request(reviews, pulls, {"o_orderstatus": "pull_request_state"})
    return found.select("id", "state", "pull_request_state")


@query(
    """
    SELECT l_partkey AS id, l_orderkey, l_linenumber, o_orderpriority AS title
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
    """
)
def review_comment_parent(t: Source) -> DataFrame:
    """Review comments with their pull request, joined by url."""
    repo = lit("org/x").alias(REPO)
    url = lambda column: tag("https://host/repos/org/x/pulls/", column)
    comments = t.lineitem.select(
        repo, c("l_partkey").alias("id"), "l_orderkey", "l_linenumber", url("l_orderkey").alias("pull_request_url")
    )
    pulls = t.orders.select(repo, url("o_orderkey").alias("url"), c("o_orderpriority").alias("title"))
    found = relations.review_comments_with_pull_request(comments, pulls, {"title": "title"})
    return found.select("id", "l_orderkey", "l_linenumber", "title")


@query(
    """
    SELECT 'issue' AS parent_name, event_id AS id, c_name AS parent_text
    FROM events LEFT JOIN customer ON user_id = c_custkey
    UNION ALL
    SELECT 'comment', o_orderkey, s_name FROM orders LEFT JOIN supplier ON o_custkey = s_suppkey
    UNION ALL
    SELECT 'review_comment', c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
    """
)
def reaction_parent(t: Source) -> DataFrame:
    """Reactions with their parent, which is in one of three tables."""
    reaction = lambda df, key, parent: df.select(
        c(key).alias("id"), c(parent).cast("long").alias("parent_id")
    )
    reactions = union_tagged(
        {
            "issue": reaction(t.events, "event_id", "user_id"),
            "comment": reaction(t.orders, "o_orderkey", "o_custkey"),
            "review_comment": reaction(t.customer, "c_custkey", "c_nationkey"),
        }
    )
    parent = lambda df, key, name: df.select(c(key).cast("long").alias("id"), c(name).alias("parent_text"))
    parents = {
        "issue": parent(t.customer, "c_custkey", "c_name"),
        "comment": parent(t.supplier, "s_suppkey", "s_name"),
        "review_comment": parent(t.nation, "n_nationkey", "n_name"),
    }
    found = relations.reactions_with_parent(reactions, parents, {"parent_text": "parent_text"}, ())
    return found.select("parent_name", "id", "parent_text")


@query(
    """
    SELECT c_custkey, item, o_orderstatus AS state
    FROM (SELECT c_custkey, unnest([c_custkey, c_custkey * 10, -c_custkey - 1]) AS item FROM customer)
    JOIN orders ON item = o_orderkey
    """
)
def array_key_join(t: Source) -> DataFrame:
    """Pull requests joined to commits through an array of shas, some of which are not there."""
    key = c("c_custkey")
    pulls = t.customer.select("c_custkey", F.array(key, key * 10, -key - 1).alias("commit_shas"))
    return relations.join_by_array(pulls, t.orders, "commit_shas", "o_orderkey", {"o_orderstatus": "state"}, scope=())
