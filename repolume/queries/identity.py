"""Identity resolution and repair on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repolume.functions.ranking import with_position
from repolume.operators import identity
from repolume.operators.lookups import array_lookup
from repolume.plans.versions import refresh_versions as lay_over
from repolume.plans.versions import version_tables as pipeline
from repolume.queries.base import Source, as_json, naive, query, sql_pseudonym, stored, tag, text
from repolume.schemas import MINED_EDITS, REPO
from repolume.session import scratch_dir
from repolume.sources.tables import read_table

c, lit, when = F.col, F.lit, F.when


@query(
    """
    WITH commits AS (
      SELECT o_orderkey, o_custkey,
             CASE WHEN o_orderpriority = '1-URGENT' THEN 'GitHub' ELSE o_orderpriority END AS committer_name
      FROM orders
    ), reps AS (SELECT committer_name, first(o_custkey ORDER BY o_orderkey) AS rep FROM commits GROUP BY 1)
    SELECT o_orderkey, CASE WHEN committer_name = 'GitHub' THEN o_custkey ELSE rep END AS o_custkey, committer_name
    FROM commits JOIN reps USING (committer_name)
    """
)
def representative_propagation(t: Source) -> DataFrame:
    name = when(c("o_orderpriority") == "1-URGENT", identity.SERVICE_COMMITTER).otherwise(c("o_orderpriority"))
    commits = t.orders.select("o_orderkey", "o_custkey", name.alias("committer_name"))
    return identity.propagate_representative(commits, ["o_custkey"], (), order=["o_orderkey"])


@query(
    """
    WITH aliases AS (
      SELECT s_suppkey, unnest([concat('N', s_nationkey), concat('R', s_suppkey % 7)]) AS alias FROM supplier
    )
    SELECT n_nationkey, min(s_suppkey) AS user FROM nation LEFT JOIN aliases ON alias = concat('N', n_nationkey) GROUP BY 1
    """
)
def alias_match(t: Source) -> DataFrame:
    users = t.supplier.select(
        c("s_suppkey").alias("seq"), c("s_suppkey").alias("anonym_uuid"),
        F.array(tag("N", "s_nationkey"), tag("R", c("s_suppkey") % 7)).alias("alias"),
        *[lit(None).cast("string").alias(n) for n in ("email", "name", "login")],
    )
    names = t.nation.select("n_nationkey", tag("N", "n_nationkey").alias("committer_name"))
    found = identity.match_names(names, users, "committer_name", ())
    return found.select("n_nationkey", c("alias_user").alias("user"))


@query(
    """
    SELECT n_nationkey, min(s_suppkey) AS user
    FROM nation LEFT JOIN supplier
      ON n_nationkey::VARCHAR = s_suppkey::VARCHAR OR n_nationkey::VARCHAR = s_nationkey::VARCHAR
         OR n_nationkey::VARCHAR = s_name
    GROUP BY 1
    """
)
def or_match_first_user(t: Source) -> DataFrame:
    users = t.supplier.select(
        c("s_suppkey").alias("seq"), c("s_suppkey").alias("anonym_uuid"),
        text("s_suppkey").alias("email"), text("s_nationkey").alias("name"), c("s_name").alias("login"),
        lit(None).cast("array<string>").alias("alias"),
    )
    names = t.nation.select("n_nationkey", text("n_nationkey").alias("committer_name"))
    found = identity.match_names(names, users, "committer_name", ())
    return found.select("n_nationkey", c("attribute_user").alias("user"))


def _commits(orders: DataFrame) -> DataFrame:
    name = when(c("o_orderkey") % 10 == 0, identity.SERVICE_COMMITTER).otherwise(tag("C", c("o_custkey") % 40))
    return orders.select(
        c("o_orderkey").alias("seq"), name.alias("committer_name"),
        when(c("o_orderstatus") == "F", tag("A", "o_custkey")).alias("author"),
        when(c("o_orderpriority").startswith("1"), tag("A", "o_custkey")).alias("committer"),
    )


def _users(supplier: DataFrame) -> DataFrame:
    return supplier.select(
        c("s_suppkey").alias("seq"), tag("U", "s_suppkey").alias("anonym_uuid"), tag("S", "s_suppkey").alias("id"),
        tag("C", "s_nationkey").alias("name"), c("s_name").alias("email"), lit(None).cast("string").alias("login"),
        when(c("s_acctbal") > 5000, F.array(tag("C", c("s_suppkey") % 60))).alias("alias"),
    )


_SQL_RULES = """
    commits AS (
      SELECT o_orderkey AS seq,
             CASE WHEN o_orderkey % 10 = 0 THEN 'GitHub' ELSE concat('C', o_custkey % 40) END AS committer_name,
             CASE WHEN o_orderstatus = 'F' THEN concat('A', o_custkey) END AS a0,
             CASE WHEN o_orderpriority LIKE '1%' THEN concat('A', o_custkey) END AS k0
      FROM orders
    ), users AS (
      SELECT s_suppkey AS seq, concat('U', s_suppkey) AS uuid, concat('S', s_suppkey) AS id,
             concat('C', s_nationkey) AS name, s_name AS email,
             CASE WHEN s_acctbal > 5000 THEN concat('C', s_suppkey % 60) END AS alias
      FROM supplier
    ), first_seen AS (SELECT committer_name, min(seq) AS seq FROM commits WHERE committer_name <> 'GitHub' GROUP BY 1),
    reps AS (SELECT f.committer_name, c.a0 AS ra, c.k0 AS rk FROM first_seen f JOIN commits c USING (seq)),
    hits AS (
      SELECT n.committer_name,
             (SELECT arg_min(uuid, u.seq) FROM users u WHERE u.alias = n.committer_name) AS by_alias,
             (SELECT arg_min(uuid, u.seq) FROM users u WHERE u.email = n.committer_name OR u.name = n.committer_name) AS by_attribute
      FROM (SELECT DISTINCT committer_name FROM commits) n
    )
"""
_SQL_OWN = {
    "representative": "CASE WHEN committer_name = 'GitHub' THEN a0 ELSE ra END AS a, "
    "CASE WHEN committer_name = 'GitHub' THEN k0 ELSE rk END AS k",
    "per_commit": "a0 AS a, k0 AS k",
}


def _sql_resolved(mode: str) -> str:
    return f"""
    {_SQL_RULES},
    accounts AS (
      SELECT seq, committer_name, {_SQL_OWN[mode]}, coalesce(by_alias, by_attribute) AS hit
      FROM commits LEFT JOIN reps USING (committer_name) LEFT JOIN hits USING (committer_name)
    ), resolved AS (
      SELECT seq, committer_name,
             CASE WHEN a IS NULL AND k IS NULL THEN hit ELSE a END AS author,
             CASE WHEN a IS NULL AND k IS NULL THEN hit ELSE k END AS committer,
             CASE WHEN a IS NULL AND k IS NULL AND hit IS NULL THEN committer_name END AS unknown_user
      FROM accounts
    )
    """


@query(f"WITH {_sql_resolved('representative')} SELECT * FROM resolved")
def resolve_identities(t: Source) -> DataFrame:
    return identity.resolve(_commits(t.orders), _users(t.supplier), ())


@query(f"WITH {_sql_resolved('per_commit')} SELECT * FROM resolved")
def resolve_identities_per_commit(t: Source) -> DataFrame:
    return identity.resolve(_commits(t.orders), _users(t.supplier), (), mode="per_commit")


@query(
    f"""
    WITH {_sql_resolved('per_commit')}
    SELECT unknown_user, count(*) AS commits FROM resolved WHERE unknown_user IS NOT NULL GROUP BY 1
    """
)
def unknown_users(t: Source) -> DataFrame:
    return identity.unknown_users(identity.resolve(_commits(t.orders), _users(t.supplier), (), mode="per_commit"), ())


def _assigned(t: Source) -> tuple[DataFrame, DataFrame]:
    """Unknown names in order: every third goes to the user of that number, the others to new users.

    Repair starts from stored commits and a mapping table, so both are written first.
    """
    users = _users(t.supplier)
    commits = stored(identity.resolve(_commits(t.orders), users, (), mode="per_commit"), "resolved")
    names = with_position(identity.unknown_users(commits, ()).select("unknown_user"), ["unknown_user"], name="seq")
    mapping = names.select(
        "unknown_user", "seq",
        when(c("seq") % 3 == 0, tag("U", "seq")).otherwise(tag("new", "seq")).alias("uuid"),
        (c("seq") % 3 == 1).alias("new_user"),
    )
    return identity.assign_unknown_users(commits, users, stored(mapping, "mapping"), ())


_SQL_ASSIGNED = f"""
    WITH {_sql_resolved('per_commit')},
    mapping AS (
      SELECT unknown_user, row_number() OVER (ORDER BY unknown_user) - 1 AS pos
      FROM (SELECT DISTINCT unknown_user FROM resolved WHERE unknown_user IS NOT NULL)
    ), targets AS (
      SELECT unknown_user, pos, CASE WHEN pos % 3 = 0 THEN concat('U', pos)
                                     WHEN pos % 3 = 1 THEN {sql_pseudonym("concat('new', pos)")}
                                     ELSE concat('new', pos) END AS uuid
      FROM mapping
    )
"""


@query(
    f"""
    {_SQL_ASSIGNED}
    SELECT seq, committer_name, coalesce(uuid, author) AS author, coalesce(uuid, committer) AS committer,
           NULL::VARCHAR AS unknown_user
    FROM resolved LEFT JOIN targets USING (unknown_user)
    """
)
def assign_unknown_users(t: Source) -> DataFrame:
    return _assigned(t)[0]


@query(
    f"""
    {_SQL_ASSIGNED}
    SELECT u.seq, u.uuid AS anonym_uuid, u.id, u.name, u.email, NULL::VARCHAR AS login,
           to_json(CASE WHEN x.unknown_user IS NOT NULL
                        THEN list_concat(CASE WHEN alias IS NULL THEN [] ELSE [alias] END, [x.unknown_user])
                        WHEN alias IS NOT NULL THEN [alias] END)::VARCHAR AS alias
    FROM users u LEFT JOIN targets x ON x.uuid = u.uuid
    UNION ALL
    SELECT (SELECT max(seq) FROM users) + 1 + pos, uuid, CASE WHEN pos % 3 = 0 THEN uuid ELSE concat('new', pos) END,
           unknown_user, NULL, NULL, NULL
    FROM targets WHERE uuid NOT IN (SELECT uuid FROM users)
    """
)
def assign_unknown_users_users(t: Source) -> DataFrame:
    return as_json(_assigned(t)[1], "alias")


def _mined_commits(orders: DataFrame) -> DataFrame:
    """The commits of ``_commits`` as the miner writes them, one repository per status."""
    time = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    none = lit(None).cast("string")
    number = lit(None).cast("long")
    name = when(c("o_orderkey") % 10 == 0, identity.SERVICE_COMMITTER).otherwise(tag("C", c("o_custkey") % 40))
    return orders.select(
        tag("org/", "o_orderstatus").alias(REPO), c("o_orderkey").alias("seq"), tag("sha", "o_orderkey").alias("hash"),
        *[none.alias(n) for n in ("author_name", "author_email", "committer_email", "project_name")],
        time.alias("author_date"), number.alias("author_timezone"), name.alias("committer_name"),
        time.alias("committer_date"), number.alias("committer_timezone"), c("o_orderpriority").alias("commit_message"),
        number.alias("commit_message_len"), lit(1).cast("long").alias("no_of_modifications"), lit("").alias("parents"),
        F.concat(lit("main,"), F.lower("o_orderpriority")).alias("branches"), lit(True).alias("in_main_branch"),
        lit(False).alias("merge"),
    )


def _version_inputs(t: Source) -> tuple[DataFrame, ...]:
    mined = _mined_commits(t.orders)
    accounts = t.orders.select(
        tag("org/", "o_orderstatus").alias(REPO), tag("sha", "o_orderkey").alias("sha"),
        when(c("o_orderpriority").startswith("1"), tag("A", "o_custkey")).alias("author"),
        when(c("o_orderpriority").startswith("2"), tag("A", "o_custkey")).alias("committer"),
    )
    repositories = F.explode(F.array(lit("org/F"), lit("org/O")))
    users = _users(t.supplier).withColumn(REPO, repositories)
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    marks = t.lineitem.where(c("l_quantity") >= 45).groupBy("l_orderkey").agg(
        F.max_by("l_returnflag", F.struct(*order)).alias("name")
    )
    tags = marks.join(t.orders, c("l_orderkey") == c("o_orderkey")).select(
        tag("org/", "o_orderstatus").alias(REPO), lit(0).alias("seq"), tag("sha", "o_orderkey").alias("sha"), "name"
    )
    return mined, accounts, users, tags


_SQL_VERSIONS = """
    WITH commits AS (
      SELECT concat('org/', o_orderstatus) AS repo, o_orderkey AS seq,
             CASE WHEN o_orderkey % 10 = 0 THEN 'GitHub' ELSE concat('C', o_custkey % 40) END AS committer_name,
             CASE WHEN o_orderpriority LIKE '1%' THEN concat('A', o_custkey) END AS a0,
             CASE WHEN o_orderpriority LIKE '2%' THEN concat('A', o_custkey) END AS k0,
             o_orderdate, o_orderpriority
      FROM orders
    ), users AS (
      SELECT concat('org/', r) AS repo, s_suppkey AS seq, concat('U', s_suppkey) AS uuid, concat('C', s_nationkey) AS name,
             s_name AS email, CASE WHEN s_acctbal > 5000 THEN concat('C', s_suppkey % 60) END AS alias
      FROM supplier, (VALUES ('F'), ('O')) AS v(r)
    ), reps AS (
      SELECT repo, committer_name, a0 AS ra, k0 AS rk FROM commits WHERE committer_name <> 'GitHub'
      QUALIFY row_number() OVER (PARTITION BY repo, committer_name ORDER BY seq) = 1
    ), hits AS (
      SELECT n.repo, n.committer_name,
             coalesce((SELECT arg_min(uuid, u.seq) FROM users u WHERE u.repo = n.repo AND u.alias = n.committer_name),
                      (SELECT arg_min(uuid, u.seq) FROM users u
                       WHERE u.repo = n.repo AND (u.email = n.committer_name OR u.name = n.committer_name))) AS hit
      FROM (SELECT DISTINCT repo, committer_name FROM commits) n
    ), own AS (
      SELECT c.*, hit, CASE WHEN committer_name = 'GitHub' THEN a0 ELSE ra END AS a,
             CASE WHEN committer_name = 'GitHub' THEN k0 ELSE rk END AS k
      FROM commits c LEFT JOIN reps USING (repo, committer_name) LEFT JOIN hits USING (repo, committer_name)
    ), tags AS (
      SELECT l_orderkey, arg_max(l_returnflag, (l_linenumber, l_partkey, l_suppkey, l_shipdate)) AS tag
      FROM lineitem WHERE l_quantity >= 45 GROUP BY 1
    ), dictionary AS (
      SELECT repo, branch, row_number() OVER (PARTITION BY repo ORDER BY branch) - 1 AS id
      FROM (SELECT DISTINCT repo, unnest(['main', lower(o_orderpriority)]) AS branch FROM commits)
    )
    SELECT own.repo AS repo_full_name, concat('sha', seq) AS commit_sha,
           CASE WHEN a IS NULL AND k IS NULL THEN hit ELSE a END AS author,
           CASE WHEN a IS NULL AND k IS NULL THEN hit ELSE k END AS committer,
           CASE WHEN a IS NULL AND k IS NULL AND hit IS NULL THEN committer_name END AS unknown_user,
           o_orderdate AS commited_at, o_orderpriority AS commit_message, coalesce(tag, '') AS tag,
           {branches}
    FROM own LEFT JOIN tags ON l_orderkey = seq
         JOIN dictionary m ON m.repo = own.repo AND m.branch = 'main'
         JOIN dictionary b ON b.repo = own.repo AND b.branch = lower(o_orderpriority)
"""


@query(_SQL_VERSIONS.replace("{branches}", "to_json([m.id, b.id])::VARCHAR AS branch_ids"))
def version_tables(t: Source) -> DataFrame:
    """Commits of three repositories through the whole pipeline: shape, identities, tags, branches."""
    mined, accounts, users, tags = _version_inputs(t)
    commits = pipeline(mined, t.spark.createDataFrame([], MINED_EDITS), accounts, users, tags)["commits"]
    shown = commits.select(
        REPO, "commit_sha", "author", "committer", "unknown_user", "commited_at", "commit_message", "tag", "branch_ids"
    )
    return as_json(naive(shown), "branch_ids")


@query(_SQL_VERSIONS.replace("{branches}", "to_json(['main', lower(o_orderpriority)])::VARCHAR AS branches"))
def refresh_versions(t: Source) -> DataFrame:
    """The version tables of one whole landing, out of two: the first commits of most names land second, and so do all tags."""
    mined, accounts, users, tags = _version_inputs(t)
    spark, root = t.spark, scratch_dir(t.spark, "versions")
    none = t.spark.createDataFrame([], MINED_EDITS)
    for late in (True, False):
        part = lambda df, number: df.where((number % 3 == 0) if late else (number % 3 != 0))
        sha_number = F.substring("sha", 4, 20).cast("long")
        lay_over(
            spark, root, part(mined, c("seq")), none, part(accounts, sha_number), users, tags.limit(0) if late else tags
        )
    commits = array_lookup(
        read_table(spark, root, "commits"), read_table(spark, root, "branches"), "branch_ids", "branches", [REPO], "id",
        "branch_names",
    )
    shown = commits.select(
        REPO, "commit_sha", "author", "committer", "unknown_user", "commited_at", "commit_message", "tag", "branches"
    )
    return as_json(naive(shown), "branches")
