"""Raw records -> tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repolume.functions.people import People, pseudonym
from repolume.functions.scalars import apply_datetime_format, field_of, without_nulls
from repolume.operators import projections
from repolume.operators.incremental import extract
from repolume.operators.setops import concat, union_tagged
from repolume.plans.activity import attach_parents, child_table
from repolume.queries.base import Source, as_json, naive, query, sql_pseudonym, tag, text, user
from repolume.schemas import REPO
from repolume.sources.pages import records_of

c, lit, when = F.col, F.lit, F.when


def null_text():
    return lit(None).cast("string")


def null_time():
    return lit(None).cast("timestamp_ntz")


def status_repo():
    return F.concat(lit("org/"), c("o_orderstatus")).alias(REPO)


def null_long():
    return lit(None).cast("long")


def raw_issues(orders: DataFrame) -> DataFrame:
    """Orders as raw issues: one repository per status, urgent orders are pull requests."""
    closed = c("o_orderstatus") == "F"
    login = when(c("o_orderpriority") == "5-LOW", "invalid-email-address").otherwise(tag("login", "o_custkey"))
    name = when(c("o_totalprice") > 250000, tag("name", "o_custkey"))
    author = user(tag("C", "o_custkey"), name, None, login)
    return orders.select(
        status_repo(),
        c("o_orderkey").alias("seq"),
        c("o_orderkey").alias("id"),
        c("o_orderkey").alias("number"),
        F.concat(c("o_orderpriority"), lit(" order")).alias("title"),
        when(c("o_orderstatus") != "P", c("o_orderpriority")).alias("body"),
        when(closed, "closed").otherwise("open").alias("state"),
        F.concat(lit("https://host/repos/org/"), c("o_orderstatus"), lit("/issues/"), text("o_orderkey")).alias("url"),
        (c("o_totalprice") > 300000).alias("locked"),
        when(c("o_totalprice") > 300000, "resolved").alias("active_lock_reason"),
        F.length("o_orderpriority").cast("long").alias("comments"),
        c("o_orderdate").alias("created_at"),
        c("o_orderdate").alias("updated_at"),
        when(closed, c("o_orderdate")).alias("closed_at"),
        author.alias("user"),
        when(closed, user(tag("C", "o_custkey"))).alias("closed_by"),
        F.array(user(tag("C", "o_custkey")), user(when(closed, tag("X", "o_orderkey")))).alias("assignees"),
        F.array(F.struct(c("o_orderpriority").alias("name")), F.struct(c("o_orderstatus").alias("name"))).alias("labels"),
        when(c("o_orderpriority").startswith("1"), F.struct(lit("url").alias("url"))).alias("pull_request"),
    )


@query(
    f"""
    SELECT concat('org/', o_orderstatus) AS repo_full_name, o_orderkey AS id, o_orderkey AS number,
           concat(o_orderpriority, ' order') AS title,
           CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS body,
           CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE 'open' END AS state,
           concat('https://host/repos/org/', o_orderstatus, '/issues/', o_orderkey) AS url,
           o_totalprice > 300000 AS locked,
           CASE WHEN o_totalprice > 300000 THEN 'resolved' END AS active_lock_reason,
           length(o_orderpriority)::BIGINT AS comments,
           to_json([o_orderpriority, o_orderstatus])::VARCHAR AS labels,
           to_json([{sql_pseudonym("concat('C', o_custkey)")},
                    {sql_pseudonym("CASE WHEN o_orderstatus = 'F' THEN concat('X', o_orderkey) END")}])::VARCHAR
               AS assignees,
           {sql_pseudonym("CASE WHEN o_orderpriority <> '5-LOW' OR o_totalprice > 250000 THEN concat('C', o_custkey) END")}
               AS author,
           {sql_pseudonym("CASE WHEN o_orderstatus = 'F' THEN concat('C', o_custkey) END")} AS closed_by,
           o_orderdate AS created_at, o_orderdate AS updated_at,
           CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS closed_at,
           o_orderpriority LIKE '1%' AS is_pull_request
    FROM orders
    """
)
def project_issues(t: Source) -> DataFrame:
    return as_json(projections.issues(raw_issues(t.orders)), "labels", "assignees")


def raw_comments(conversations: DataFrame) -> DataFrame:
    """Conversation turns as raw issue comments; answers carry one reaction, questions two."""
    at = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, cast(conv_id as int), cast(turn as int))")
    comment_id = c("conv_id") * 1000 + c("turn")
    reaction = lambda n, content: F.struct(
        (comment_id * 10 + n).alias("id"), content.alias("content"), at.alias("created_at"),
        user(tag("R", c("conv_id"))).alias("user"),
    )
    return conversations.select(
        lit("org/chat").alias(REPO),
        comment_id.alias("seq"),
        comment_id.alias("id"),
        tag("https://host/repos/org/chat/issues/", "conv_id").alias("issue_url"),
        c("text").alias("body"),
        at.alias("created_at"),
        at.alias("updated_at"),
        user(c("role")).alias("user"),
        when(c("role") == "user", F.array(reaction(0, c("role")), reaction(1, lit("eyes"))))
        .when(c("role") == "assistant", F.array(reaction(0, c("role"))))
        .otherwise(F.array().cast("array<struct<id:bigint,content:string,created_at:timestamp_ntz,"
                                  "user:struct<node_id:string,name:string,email:string,login:string>>>"))
        .alias("reactions"),
    )


SQL_COMMENT_TIME = "TIMESTAMP '2024-01-01 00:00:00' + to_days(conv_id::INTEGER) + to_hours(turn::INTEGER)"


@query(
    f"""
    SELECT 'org/chat' AS repo_full_name, conv_id * 1000 + turn AS id,
           concat('https://host/repos/org/chat/issues/', conv_id) AS issue_url,
           {sql_pseudonym("role")} AS author, text AS body,
           {SQL_COMMENT_TIME} AS created_at, {SQL_COMMENT_TIME} AS updated_at
    FROM conversations
    """
)
def project_issue_comments(t: Source) -> DataFrame:
    return projections.issue_comments(raw_comments(t.conversations))


def raw_events(events: DataFrame) -> DataFrame:
    """Events as raw issue events; the JSON properties give the issue, an absent key reads as NULL."""
    props = F.from_json("props", "k bigint, label string")
    return events.select(
        lit("org/events").alias(REPO),
        c("event_id").alias("seq"),
        c("event_id").alias("id"),
        c("event_type").alias("event"),
        when(c("event_type") == "error", tag("sha", "event_id")).alias("commit_id"),
        c("ts").alias("created_at"),
        user(tag("U", "user_id")).alias("actor"),
        when(c("value") > 10, user(tag("U", "user_id"))).alias("assignee"),
        lit(None).cast("struct<node_id:string,name:string,email:string,login:string>").alias("assigner"),
        F.struct(F.coalesce(props["label"], c("event_type")).alias("name")).alias("label"),
        F.struct(props["k"].alias("id")).alias("issue"),
    )


@query(
    f"""
    SELECT 'org/events' AS repo_full_name, event_id AS id, json_extract_string(props, '$.k')::BIGINT AS issue_id,
           {sql_pseudonym("concat('U', user_id)")} AS author,
           {sql_pseudonym("CASE WHEN value > 10 THEN concat('U', user_id) END")} AS assignee,
           NULL::VARCHAR AS assigner, CASE WHEN event_type = 'error' THEN concat('sha', event_id) END AS commit_sha,
           event_type AS event, event_type AS label, ts AS created_at
    FROM events
    """
)
def project_issue_events(t: Source) -> DataFrame:
    return projections.issue_events(raw_events(t.events))


@query(
    """
    SELECT event_id, ts, user_id, event_type, value, json_extract_string(props, '$.k')::BIGINT AS k,
           json_extract_string(props, '$.label') AS label
    FROM events
    """
)
def normalize_events_json(t: Source) -> DataFrame:
    parsed = F.from_json("props", "k bigint, label string")
    return t.events.select("event_id", "ts", "user_id", "event_type", "value", parsed["k"].alias("k"), parsed["label"].alias("label"))


@query(
    """
    SELECT 'org/events' AS repo_full_name, event_id * 2147483648 + n AS seq,
           CASE WHEN n = 0 THEN event_id ELSE user_id END AS id, CASE WHEN n = 0 THEN event_type ELSE 'user' END AS kind
    FROM events, (VALUES (0), (1)) AS v(n)
    """
)
def landed_pages(t: Source) -> DataFrame:
    """Pages of two records each, taken apart in listing order."""
    item = lambda key, kind: F.struct(c(key).alias("id"), kind.alias("kind"))
    items = F.array(item("event_id", c("event_type")), item("user_id", lit("user")))
    return records_of(t.events.select(lit("org/events").alias(REPO), c("event_id").alias("page"), items.alias("items")))


def _listed(child: DataFrame, parent: Column, **fields: Column) -> DataFrame:
    """Pages of one record each, listed under ``parent``, taken apart."""
    item = F.struct(*[value.alias(name) for name, value in fields.items()])
    return records_of(child.select(lit("org/all").alias(REPO), lit(0).cast("long").alias("page"), parent.alias("parent"), F.array(item).alias("items")))


def _parent(kind: Column | None, key: Column | None, url: Column | None) -> Column:
    pick = lambda value, type_: lit(None).cast(type_) if value is None else value.cast(type_)
    return F.struct(pick(kind, "string").alias("kind"), pick(key, "bigint").alias("id"), pick(url, "string").alias("url"))


def _numbered(df: DataFrame, key: str) -> DataFrame:
    """Records whose number is ``key`` and whose id is another one."""
    return df.select(lit("org/all").alias(REPO), c(key).cast("bigint").alias("number"), (c(key) * 7 + 1).cast("bigint").alias("id"))


@query(
    f"""
    SELECT 'org/all' AS repo_full_name, o_orderkey AS id,
           CASE WHEN o_orderstatus = 'F' OR c_custkey IS NOT NULL THEN o_custkey * 7 + 1 END AS pull_request_id,
           {sql_pseudonym("concat('C', o_custkey)")} AS author, o_orderpriority AS body, o_orderstatus AS state,
           o_orderdate AS submitted_at
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_mktsegment <> 'BUILDING'
    """
)
def listed_reviews(t: Source) -> DataFrame:
    """Reviews that are landed as listings: under the id of a pull request, or under its url, which may lead nowhere."""
    url = tag("https://host/repos/org/all/pulls/", "o_custkey")
    by_id = _parent(None, c("o_custkey") * 7 + 1, None)
    raw = _listed(
        t.orders, when(c("o_orderstatus") == "F", by_id).otherwise(_parent(None, None, url)), id=c("o_orderkey"),
        body=c("o_orderpriority"), state=c("o_orderstatus"), submitted_at=c("o_orderdate"), user=user(tag("C", "o_custkey")),
    )
    pulls = _numbered(t.customer.where(c("c_mktsegment") != "BUILDING"), "c_custkey")
    return child_table("reviews", attach_parents({"review": raw}, {"pull_request": pulls}))


@query(
    f"""
    SELECT 'org/all' AS repo_full_name, event_id AS id,
           CASE event_type WHEN 'view' THEN CASE WHEN user_id IN (SELECT c_custkey FROM customer) THEN user_id * 7 + 1 END
                WHEN 'error' THEN NULL ELSE user_id END AS parent_id,
           CASE event_type WHEN 'view' THEN 'issue' WHEN 'click' THEN 'comment' WHEN 'purchase' THEN 'review_comment'
                WHEN 'error' THEN NULL ELSE 'pull_request' END AS parent_name,
           event_type AS content, {sql_pseudonym("concat('U', user_id)")} AS author, ts AS created_at
    FROM events
    """
)
def listed_reactions(t: Source) -> DataFrame:
    """Reactions that are landed as listings under issues, comments, review comments, pull requests and nothing known."""
    url = lambda path: _parent(None, None, tag(f"https://host/repos/org/all/{path}/", "user_id"))
    kind = c("event_type")
    parent = (
        when(kind == "view", url("issues")).when(kind == "click", url("issues/comments"))
        .when(kind == "purchase", url("pulls/comments")).when(kind == "error", _parent(None, None, None))
        .otherwise(_parent(lit("pull_request"), c("user_id"), None))
    )
    raw = _listed(t.events, parent, id=c("event_id"), content=kind, created_at=c("ts"), user=user(tag("U", "user_id")))
    attached = attach_parents({"reaction": raw}, {"issue": _numbered(t.customer, "c_custkey")})
    return child_table("issue_reactions", attached).unionByName(child_table("pull_request_reactions", attached))


@query(
    f"""
    SELECT 'org/chat' AS repo_full_name, (conv_id * 1000 + turn) * 10 + n AS id, conv_id * 1000 + turn AS parent_id,
           'comment' AS parent_name, CASE WHEN n = 0 THEN role ELSE 'eyes' END AS content,
           {sql_pseudonym("concat('R', conv_id)")} AS author, {SQL_COMMENT_TIME} AS created_at
    FROM conversations, (VALUES (0), (1)) AS v(n)
    WHERE role = 'user' OR (role = 'assistant' AND n = 0)
    UNION ALL
    SELECT 'org/events', event_id, event_id, 'issue', event_type, {sql_pseudonym("concat('U', user_id)")}, ts
    FROM events WHERE event_type <> 'view'
    """
)
def reactions_union_tagged(t: Source) -> DataFrame:
    """Reactions under comments and under issues, in one table."""
    reaction = F.struct(
        c("event_id").alias("id"), c("event_type").alias("content"), c("ts").alias("created_at"),
        user(tag("U", "user_id")).alias("user"),
    )
    issues = t.events.select(
        lit("org/events").alias(REPO), c("event_id").alias("id"),
        when(c("event_type") != "view", F.array(reaction)).alias("reactions"),
    )
    parts = {"comment": raw_comments(t.conversations), "issue": issues}
    found = {name: projections.reactions(df, name).drop("parent_name") for name, df in parts.items()}
    columns = ["repo_full_name", "id", "parent_id", "parent_name", "content", "author", "created_at"]
    return union_tagged(found).select(*columns)


def raw_pull_requests(orders: DataFrame) -> DataFrame:
    """Orders as raw pull requests with two reviews, two requested users and two commits each."""
    closed = c("o_orderstatus") == "F"
    review = lambda n, state: F.struct(
        (c("o_orderkey") * 2 + n).alias("id"), c("o_orderpriority").alias("body"), lit(state).alias("state"),
        c("o_orderdate").alias("submitted_at"), user(tag("C", c("o_custkey") + n)).alias("user"),
    )
    sha = lambda n: F.struct(tag("sha", c("o_orderkey") + n).alias("sha"))
    amount = c("o_totalprice").cast("long")
    return orders.select(
        status_repo(),
        c("o_orderkey").alias("seq"),
        c("o_orderkey").alias("id"),
        c("o_orderkey").alias("number"),
        when(closed, c("o_orderdate")).alias("merged_at"),
        when(closed, tag("sha", "o_orderkey")).alias("merge_commit_sha"),
        (c("o_orderstatus") == "P").alias("draft"),
        c("o_orderdate").alias("updated_at"),
        tag("https://host/repos/org/x/pulls/", "o_orderkey").alias("url"),
        amount.alias("additions"),
        (c("o_custkey") + 1).alias("changed_files"),
        null_long().alias("comments"),
        lit(2).cast("long").alias("commits_count"),
        F.floor(amount / 2).cast("long").alias("deletions"),
        when(~closed, c("o_totalprice") > 1000).alias("mergeable"),
        c("o_orderpriority").alias("mergeable_state"),
        closed.alias("merged"),
        lit(None).cast("boolean").alias("rebaseable"),
        lit(2).cast("long").alias("review_comments"),
        lit(True).alias("maintainer_can_modify"),
        when(closed, user(tag("C", "o_custkey"))).alias("merged_by"),
        F.array(review(0, "APPROVED"), review(1, "COMMENTED")).alias("reviews"),
        F.array(user(tag("C", "o_custkey")), user(tag("S", "o_orderstatus"))).alias("requested_users"),
        F.array(sha(0), sha(1)).alias("commits"),
    )


_PULL_BASE = """
    concat('org/', o_orderstatus) AS repo_full_name, o_orderkey AS id, o_orderkey AS number,
    CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS merged_at,
    CASE WHEN o_orderstatus = 'F' THEN concat('sha', o_orderkey) END AS merge_commit_sha,
    o_orderstatus = 'P' AS draft, o_orderdate AS updated_at,
    concat('https://host/repos/org/x/pulls/', o_orderkey) AS url
"""


@query(f"SELECT {_PULL_BASE} FROM orders")
def project_pull_requests(t: Source) -> DataFrame:
    base = ["repo_full_name", "id", "number", "merged_at", "merge_commit_sha", "draft", "updated_at", "url"]
    return projections.pull_requests(raw_pull_requests(t.orders)).select(*base)


@query(
    f"""
    SELECT {_PULL_BASE}, trunc(o_totalprice)::BIGINT AS additions, o_custkey + 1 AS changed_files, NULL::BIGINT AS comments,
           2::BIGINT AS commits, trunc(o_totalprice)::BIGINT // 2 AS deletions,
           CASE WHEN o_orderstatus <> 'F' THEN o_totalprice > 1000 END AS mergeable, o_orderpriority AS mergeable_state,
           o_orderstatus = 'F' AS merged, NULL::BOOLEAN AS rebaseable, 2::BIGINT AS review_comments,
           true AS maintainer_can_modify,
           {sql_pseudonym("CASE WHEN o_orderstatus = 'F' THEN concat('C', o_custkey) END")} AS merged_by,
           to_json([{sql_pseudonym("concat('C', o_custkey)")}, {sql_pseudonym("concat('S', o_orderstatus)")}])::VARCHAR
               AS review_requested_users,
           to_json([concat('sha', o_orderkey), concat('sha', o_orderkey + 1)])::VARCHAR AS commit_shas
    FROM orders
    """
)
def project_pull_requests_deep(t: Source) -> DataFrame:
    deep = projections.pull_requests(raw_pull_requests(t.orders), deep=True, review_requests=True, commits=True)
    return as_json(deep, "review_requested_users", "commit_shas")


@query(
    f"""
    SELECT concat('org/', o_orderstatus) AS repo_full_name, o_orderkey * 2 + n AS id, o_orderkey AS pull_request_id,
           {sql_pseudonym("concat('C', o_custkey + n)")} AS author, o_orderpriority AS body, state,
           o_orderdate AS submitted_at
    FROM orders, (VALUES (0, 'APPROVED'), (1, 'COMMENTED')) AS v(n, state)
    """
)
def project_reviews(t: Source) -> DataFrame:
    return projections.reviews(raw_pull_requests(t.orders))


@query(
    f"""
    SELECT 'org/lines' AS repo_full_name, l_partkey AS id,
           concat('https://host/repos/org/lines/pulls/', l_orderkey) AS pull_request_url,
           {sql_pseudonym("concat('S', l_suppkey)")} AS author, l_returnflag AS body, concat('sha', l_orderkey) AS commit_sha,
           concat('old', l_orderkey) AS original_commit_id, l_linestatus AS diff_hunk,
           concat(l_returnflag, '/', l_linestatus, '.py') AS path,
           CASE WHEN l_linestatus = 'F' THEN l_linenumber::BIGINT END AS position,
           l_linenumber::BIGINT AS original_position, l_shipdate AS created_at, l_shipdate AS updated_at
    FROM lineitem
    """
)
def project_review_comments(t: Source) -> DataFrame:
    line = c("l_linenumber").cast("long")
    raw = t.lineitem.select(
        lit("org/lines").alias(REPO), c("l_partkey").alias("id"),
        tag("https://host/repos/org/lines/pulls/", "l_orderkey").alias("pull_request_url"),
        c("l_returnflag").alias("body"), tag("sha", "l_orderkey").alias("commit_id"),
        tag("old", "l_orderkey").alias("original_commit_id"), c("l_linestatus").alias("diff_hunk"),
        F.concat("l_returnflag", lit("/"), "l_linestatus", lit(".py")).alias("path"),
        when(c("l_linestatus") == "F", line).alias("position"), line.alias("original_position"),
        c("l_shipdate").alias("created_at"), c("l_shipdate").alias("updated_at"),
        user(tag("S", "l_suppkey")).alias("user"),
    )
    return projections.review_comments(raw)


@query(
    f"""
    SELECT p_brand AS repo_full_name, p_partkey AS id, p_name AS title, p_type AS body, concat('v', p_partkey) AS tag_name,
           'main' AS target_commitish, p_size > 40 AS draft, p_size < 5 AS prerelease,
           {sql_pseudonym("CASE WHEN p_size <> 1 THEN p_brand END")} AS author,
           TIMESTAMP '2024-01-01 00:00:00' + to_days(p_size) AS created_at,
           CASE WHEN p_size <= 40 THEN TIMESTAMP '2024-02-01 00:00:00' + to_days(p_size) END AS published_at
    FROM part
    """
)
def project_releases(t: Source) -> DataFrame:
    days = lambda start: F.expr(f"timestamp_ntz'{start} 00:00:00' + make_interval(0, 0, 0, p_size)")
    raw = t.part.select(
        c("p_brand").alias(REPO), c("p_partkey").alias("id"), c("p_name").alias("title"), c("p_type").alias("body"),
        tag("v", "p_partkey").alias("tag_name"), lit("main").alias("target_commitish"),
        (c("p_size") > 40).alias("draft"), (c("p_size") < 5).alias("prerelease"),
        days("2024-01-01").alias("created_at"), when(c("p_size") <= 40, days("2024-02-01")).alias("published_at"),
        when(c("p_size") != 1, user(c("p_brand"))).alias("author"),
    )
    return projections.releases(raw)


@query(
    """
    SELECT concat('org/', s_nationkey) AS repo_full_name, s_suppkey AS id, s_name AS name,
           CASE WHEN s_acctbal < 0 THEN 'disabled' ELSE 'active' END AS state,
           NULL::TIMESTAMP AS created_at, NULL::TIMESTAMP AS updated_at
    FROM supplier
    """
)
def project_workflows(t: Source) -> DataFrame:
    raw = t.supplier.select(
        tag("org/", "s_nationkey").alias(REPO), c("s_suppkey").alias("id"), c("s_name").alias("name"),
        when(c("s_acctbal") < 0, "disabled").otherwise("active").alias("state"),
        null_time().alias("created_at"), null_time().alias("updated_at"),
    )
    return projections.workflows(raw)


@query(
    """
    SELECT 'org/events' AS repo_full_name, event_id AS id, user_id AS workflow_id, concat('sha', event_id) AS commit_sha,
           'completed' AS state, event_type AS event,
           CASE WHEN event_type = 'error' THEN 'failure' WHEN value > 5 THEN 'success' END AS conclusion,
           CASE WHEN event_type = 'purchase' THEN to_json([user_id, event_id])::VARCHAR ELSE '[]' END AS pull_requests,
           ts AS created_at, ts AS updated_at
    FROM events
    """
)
def project_workflow_runs(t: Source) -> DataFrame:
    number = lambda column: F.struct(c(column).alias("id"))
    raw = t.events.select(
        lit("org/events").alias(REPO), c("event_id").alias("id"), c("user_id").alias("workflow_id"),
        tag("sha", "event_id").alias("head_sha"), lit("completed").alias("status"), c("event_type").alias("event"),
        when(c("event_type") == "error", "failure").when(c("value") > 5, "success").alias("conclusion"),
        when(c("event_type") == "purchase", F.array(number("user_id"), number("event_id"))).alias("pull_requests"),
        c("ts").alias("created_at"), c("ts").alias("updated_at"),
    )
    return as_json(projections.workflow_runs(raw), "pull_requests")


@query(
    f"""
    WITH met AS (
      SELECT concat('org/', o_orderstatus) AS repo_full_name, o_orderkey AS seq, concat('C', o_custkey) AS id,
             CASE WHEN o_totalprice > 250000 THEN concat('name', o_custkey) END AS name,
             CASE WHEN o_orderpriority = '5-LOW' THEN 'invalid-email-address' ELSE concat('login', o_custkey) END AS login
      FROM orders WHERE o_orderpriority <> '5-LOW' OR o_totalprice > 250000
    )
    SELECT repo_full_name, {sql_pseudonym("id", "pepper")} AS anonym_uuid, id, name, NULL::VARCHAR AS email, login, seq
    FROM met QUALIFY row_number() OVER (PARTITION BY repo_full_name, id ORDER BY seq) = 1
    """
)
def project_users(t: Source) -> DataFrame:
    """Users out of the authors of all issues, each as first met in its repository."""
    met = raw_issues(t.orders).select(REPO, "seq", "user")
    return projections.users(met, People("pepper")).drop("alias")


@query(
    """
    SELECT concat('org/', o_orderstatus) AS repo_full_name, o_orderkey AS seq, concat('sha', o_orderkey) AS commit_sha,
           o_orderpriority AS committer_name, o_orderdate AS commited_at, o_custkey AS committer_timezone,
           o_orderpriority AS commit_message, 3::BIGINT AS no_of_modifications, '' AS parent_sha, 'main' AS branches,
           true AS in_main_branch
    FROM orders
    """
)
def commits_shape(t: Source) -> DataFrame:
    mined = t.orders.select(
        status_repo(), c("o_orderkey").alias("seq"), tag("sha", "o_orderkey").alias("hash"),
        null_text().alias("author_name"), null_text().alias("author_email"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("author_date"),
        null_long().alias("author_timezone"), c("o_orderpriority").alias("committer_name"),
        null_text().alias("committer_email"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("committer_date"),
        c("o_custkey").alias("committer_timezone"), c("o_orderpriority").alias("commit_message"),
        F.length("o_orderpriority").cast("long").alias("commit_message_len"),
        lit(3).cast("long").alias("no_of_modifications"), lit("").alias("parents"), lit("main").alias("branches"),
        lit(True).alias("in_main_branch"), lit(False).alias("merge"), lit("p").alias("project_name"),
    )
    return naive(projections.commits(mined))


@query(
    """
    SELECT 'org/lines' AS repo_full_name, l_partkey AS id, concat('sha', l_orderkey) AS commit_sha,
           nullif(l_linestatus, 'O') AS filename, l_returnflag AS edit_type, l_linestatus AS modification_type,
           NULL::VARCHAR AS parent_sha,
           coalesce(CASE WHEN l_returnflag <> 'N' THEN l_quantity END, 0)::BIGINT AS total_added_lines,
           l_linenumber::BIGINT AS total_removed_lines, 0::BIGINT AS levenshtein_dist,
           l_returnflag AS pre_text, l_linestatus AS post_text
    FROM lineitem
    """
)
def rename_fill_cast(t: Source) -> DataFrame:
    mined = t.lineitem.select(
        lit("org/lines").alias(REPO), c("l_partkey").alias("id"), tag("sha", "l_orderkey").alias("commit_hash"),
        F.nullif("l_linestatus", lit("O")).alias("filename"), c("l_returnflag").alias("edit_type"),
        c("l_linestatus").alias("modification_type"), null_text().alias("parent_sha"),
        when(c("l_returnflag") != "N", c("l_quantity")).alias("total_added_lines"),
        c("l_linenumber").alias("total_removed_lines"), null_long().alias("levenshtein_dist"),
        c("l_returnflag").alias("pre_text"), c("l_linestatus").alias("post_text"),
    )
    return projections.edits(mined)


@query(
    """
    SELECT o_orderkey, o_orderdate AS strict_at, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS lenient_at
    FROM orders
    """
)
def parse_timestamps(t: Source) -> DataFrame:
    written = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    df = t.orders.select(
        "o_orderkey", written.alias("written"), when(c("o_orderstatus") == "P", "n/a").otherwise(written).alias("dirty")
    )
    df = apply_datetime_format(df, "written", "strict_at")
    df = apply_datetime_format(df, "dirty", "lenient_at", strict=False)
    return naive(df.select("o_orderkey", "strict_at", "lenient_at"))


@query(f"SELECT c_custkey, {sql_pseudonym('c_name', 'salt')} AS anonym_uuid FROM customer")
def pseudonyms(t: Source) -> DataFrame:
    return t.customer.select("c_custkey", pseudonym(c("c_name"), "salt").alias("anonym_uuid"))


@query(
    """
    SELECT conv_id, turn, to_json([role, CASE WHEN turn > 0 THEN 'reply' END])::VARCHAR AS labels,
           CASE WHEN turn > 0 THEN to_json([role, 'reply'])::VARCHAR ELSE to_json([role])::VARCHAR END AS present,
           CASE WHEN turn > 0 THEN 2 ELSE 1 END::BIGINT AS n_present
    FROM conversations
    """
)
def label_names(t: Source) -> DataFrame:
    name = lambda value: F.struct(value.alias("name"))
    labels = F.array(name(c("role")), name(when(c("turn") > 0, "reply")))
    df = t.conversations.select("conv_id", "turn", field_of(labels, "name").alias("labels"))
    df = df.withColumn("present", without_nulls(c("labels")))
    return as_json(df.withColumn("n_present", F.size("present").cast("long")), "labels", "present")


@query(
    """
    SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer
    UNION ALL
    SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier
    """
)
def concat_missing_columns(t: Source) -> DataFrame:
    customers = t.customer.select(c("c_custkey").alias("id"), c("c_name").alias("name"), c("c_mktsegment").alias("segment"))
    suppliers = t.supplier.select(c("s_suppkey").alias("id"), c("s_name").alias("name"), c("s_acctbal").alias("balance"))
    return concat(customers, suppliers)


@query("SELECT event_id AS id, upper(event_type) AS event, value * 2 AS scaled FROM events")
def user_extraction(t: Source) -> DataFrame:
    """A listing with a user-given extraction and an extra argument."""

    def scaled(df: DataFrame, factor: int) -> DataFrame:
        return df.select(
            c("event_id").alias("id"), F.upper("event_type").alias("event"), (c("value") * factor).alias("scaled")
        )

    return extract(t.events, scaled, 2)
