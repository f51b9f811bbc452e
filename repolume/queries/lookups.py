"""User lookups, arrays and enrichment on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repolume.operators.enrich import add_tags, branch_dictionary, encode_branches
from repolume.operators.lookups import array_lookup, commit_accounts, replace_users, user_lookup as lookup_user
from repolume.operators.setops import distinct_items
from repolume.functions.scalars import split_list
from repolume.queries.base import Source, as_json, query

c, lit, when = F.col, F.lit, F.when


def stored_users(customer: DataFrame) -> DataFrame:
    """Customers with a positive balance as stored users."""
    return customer.where(c("c_acctbal") > 0).select(c("c_custkey").alias("id"), c("c_name").alias("anonym_uuid"))


@query(
    """
    SELECT o_orderkey, c_name AS author FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0
    """
)
def user_lookup(t: Source) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_custkey")
    return lookup_user(orders, stored_users(t.customer), "o_custkey", "author").select("o_orderkey", "author")


def _assigned(orders: DataFrame) -> DataFrame:
    custkey = c("o_custkey")
    assignees = when(c("o_orderstatus") == "P", F.array(custkey, -custkey - 1, custkey + 1)).when(
        c("o_orderstatus") == "F", F.array(custkey + 1, custkey)
    )
    return orders.select("o_orderkey", "o_custkey", assignees.alias("assignees"))


_SQL_ASSIGNED = """
    SELECT o_orderkey, o_custkey,
           CASE WHEN o_orderstatus = 'P' THEN [o_custkey, -o_custkey - 1, o_custkey + 1]
                WHEN o_orderstatus = 'F' THEN [o_custkey + 1, o_custkey] ELSE []::BIGINT[] END AS assignees
    FROM orders
"""
_SQL_MAPPED = f"""
    WITH o AS ({_SQL_ASSIGNED}),
    items AS (SELECT o_orderkey, unnest(assignees) AS item, generate_subscripts(assignees, 1) AS pos FROM o),
    mapped AS (
      SELECT o_orderkey, list(c_name ORDER BY pos) AS names
      FROM items LEFT JOIN customer ON item = c_custkey AND c_acctbal > 0 GROUP BY 1
    )
"""


@query(
    f"""
    {_SQL_MAPPED}
    SELECT o.o_orderkey, coalesce(to_json(names)::VARCHAR, '[]') AS assignees
    FROM o LEFT JOIN mapped ON o.o_orderkey = mapped.o_orderkey
    """
)
def assignee_lookup(t: Source) -> DataFrame:
    """Every element of an array replaced; unknown users stay as NULL, no assignees as an empty array."""
    df = array_lookup(_assigned(t.orders), stored_users(t.customer), "assignees", "assignees")
    return as_json(df.select("o_orderkey", "assignees"), "assignees")


@query(
    f"""
    {_SQL_MAPPED}
    SELECT o.o_orderkey, c_name AS o_custkey, coalesce(to_json(names)::VARCHAR, '[]') AS assignees
    FROM o LEFT JOIN mapped ON o.o_orderkey = mapped.o_orderkey
           LEFT JOIN customer ON o.o_custkey = c_custkey AND c_acctbal > 0
    """
)
def pseudonymise_table(t: Source) -> DataFrame:
    df = replace_users(_assigned(t.orders), stored_users(t.customer), ["o_custkey"], ["assignees"])
    return as_json(df, "assignees")


_SQL_BRANCHES = """
    WITH names AS (
      SELECT DISTINCT p_brand AS repo_full_name, unnest(string_split(p_name, ' ')) AS branch_names FROM part
    ), dictionary AS (
      SELECT repo_full_name, row_number() OVER (PARTITION BY repo_full_name ORDER BY branch_names) - 1 AS id, branch_names
      FROM names
    )
"""


def _listed(part: DataFrame) -> DataFrame:
    """Parts as commits whose names are comma lists of branches."""
    return part.select(
        c("p_brand").alias("repo_full_name"), "p_partkey", F.replace("p_name", lit(" "), lit(",")).alias("branches")
    )


@query(f"{_SQL_BRANCHES} SELECT * FROM dictionary")
def branch_ids(t: Source) -> DataFrame:
    return branch_dictionary(_listed(t.part))


@query(
    f"""
    {_SQL_BRANCHES},
    items AS (
      SELECT p_partkey, p_brand, unnest(string_split(p_name, ' ')) AS item,
             generate_subscripts(string_split(p_name, ' '), 1) AS pos
      FROM part
    )
    SELECT p_brand AS repo_full_name, p_partkey, to_json(list(id ORDER BY pos))::VARCHAR AS branch_ids
    FROM items JOIN dictionary ON p_brand = repo_full_name AND item = branch_names GROUP BY 1, 2
    """
)
def array_lookup_ordered(t: Source) -> DataFrame:
    commits = _listed(t.part)
    encoded = encode_branches(commits, branch_dictionary(commits))
    return as_json(encoded.select("repo_full_name", "p_partkey", "branch_ids"), "branch_ids")


@query("SELECT DISTINCT p_type, unnest(string_split(p_name, ' ')) AS word FROM part")
def distinct_list_items(t: Source) -> DataFrame:
    words = t.part.select("p_type", split_list(c("p_name"), " ").alias("words"))
    return distinct_items(words, "words", ["p_type"], "word")


@query(
    """
    WITH accounts AS (
      SELECT o_orderkey AS sha, o_custkey AS a, CASE WHEN o_orderpriority LIKE '1%' THEN o_custkey + 1 END AS k
      FROM orders WHERE o_orderstatus <> 'P'
    )
    SELECT o_orderkey AS commit_sha, ca.c_name AS author, ck.c_name AS committer
    FROM orders LEFT JOIN accounts ON sha = o_orderkey
         LEFT JOIN customer ca ON ca.c_custkey = a AND ca.c_acctbal > 0
         LEFT JOIN customer ck ON ck.c_custkey = k AND ck.c_acctbal > 0
    """
)
def commit_account_lookup(t: Source) -> DataFrame:
    """Accounts of commits by sha: none for open commits, committers for urgent ones only."""
    raw = t.orders.where(c("o_orderstatus") != "P").select(
        c("o_orderkey").alias("sha"), c("o_custkey").alias("author"),
        when(c("o_orderpriority").startswith("1"), c("o_custkey") + 1).alias("committer"),
    )
    accounts = replace_users(raw, stored_users(t.customer), ["author", "committer"])
    return commit_accounts(t.orders.select(c("o_orderkey").alias("commit_sha")), accounts)


@query(
    """
    WITH tags AS (
      SELECT l_orderkey, arg_max(l_returnflag, (l_linenumber, l_partkey, l_suppkey, l_shipdate)) AS tag
      FROM lineitem WHERE l_quantity >= 45 GROUP BY 1
    )
    SELECT o_orderkey, coalesce(tag, '') AS tag FROM orders LEFT JOIN tags ON l_orderkey = o_orderkey
    """
)
def tag_enrichment(t: Source) -> DataFrame:
    tags = t.lineitem.where(c("l_quantity") >= 45).select(
        c("l_orderkey").alias("sha"), c("l_returnflag").alias("name"), "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"
    )
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    return add_tags(t.orders.select("o_orderkey"), tags, (), "o_orderkey", order)
