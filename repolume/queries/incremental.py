"""Change detection, upserts, paging and ordering on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repolume.functions.ranking import first_rows
from repolume.operators import incremental, ordering, setops
from repolume.queries.base import Source, query

c, lit, when = F.col, F.lit, F.when


@query("SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_per_id(t: Source) -> DataFrame:
    return incremental.latest_per_id(t.events, ["user_id"], "ts", "event_id")


_SQL_OLD = """
    SELECT event_id, CASE WHEN event_type = 'error' THEN ts - INTERVAL 1 DAY ELSE ts END AS ts, event_type
    FROM events WHERE event_type <> 'signup'
"""


def _stored(events: DataFrame) -> DataFrame:
    """An earlier state of the events: signups had not come yet, errors were a day older."""
    earlier = when(c("event_type") == "error", c("ts") - F.expr("interval 1 day")).otherwise(c("ts"))
    return events.where(c("event_type") != "signup").select("event_id", earlier.alias("ts"), "event_type")


@query(
    f"""
    WITH old AS ({_SQL_OLD}),
    new AS (SELECT event_id, ts, concat(event_type, '!') AS event_type FROM events WHERE event_type IN ('signup', 'error', 'view'))
    SELECT event_id, ts, event_type FROM (SELECT *, 0 AS is_new FROM old UNION ALL SELECT *, 1 FROM new)
    QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ts DESC, is_new DESC) = 1
    """
)
def upsert_refresh(t: Source) -> DataFrame:
    new = t.events.where(c("event_type").isin("signup", "error", "view")).select(
        "event_id", "ts", F.concat("event_type", lit("!")).alias("event_type")
    )
    return incremental.upsert(_stored(t.events), new, ["event_id"], "ts")


@query("SELECT event_id, ts, user_id, event_type FROM events")
def stitch_pages(t: Source) -> DataFrame:
    """Two windows of the listing that overlap by ten days, put together."""
    events = t.events.select("event_id", "ts", "user_id", "event_type")
    windows = [
        events.where(c("ts") < F.expr("timestamp_ntz'2024-01-20 00:00:00'")),
        events.where(c("ts") >= F.expr("timestamp_ntz'2024-01-10 00:00:00'")),
    ]
    return setops.stitch(windows, ["event_id"], "ts")


@query(
    f"""
    WITH old AS ({_SQL_OLD})
    SELECT e.event_id, e.ts,
           CASE WHEN o.event_id IS NULL THEN 'new' WHEN o.ts <> e.ts THEN 'changed' ELSE 'same' END AS change
    FROM events e LEFT JOIN old o ON o.event_id = e.event_id
    """
)
def change_classes(t: Source) -> DataFrame:
    return incremental.change_classes(t.events.select("event_id", "ts"), _stored(t.events), ["event_id"], "ts")


@query(
    """
    WITH newest AS (SELECT event_id, ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 1)
    SELECT NOT EXISTS (
      SELECT 1 FROM events e, newest n
      WHERE e.event_id = n.event_id AND e.ts = n.ts AND e.event_id < (SELECT max(event_id) FROM events)
    ) AS has_updates
    """
)
def has_updates(t: Source) -> DataFrame:
    """The store lacks the event with the last id."""
    last = t.events.agg(F.max("event_id").alias("last"))
    old = t.events.join(F.broadcast(last), c("event_id") < c("last")).drop("last")
    return incremental.has_updates(t.events, old, "ts", "event_id")


@query("SELECT false AS has_updates")
def has_no_updates(t: Source) -> DataFrame:
    """The store holds all that is listed."""
    return incremental.has_updates(t.events, t.events, "ts", "event_id")


@query(
    f"""
    WITH old AS ({_SQL_OLD}),
    newest AS (SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, max(ts) AS ts FROM events GROUP BY 1)
    SELECT n.user_id, o.ts IS NULL OR o.ts <> n.ts AS has_updates
    FROM newest n LEFT JOIN old o ON o.event_id = n.event_id
    """
)
def updates_per_repository(t: Source) -> DataFrame:
    """Which users have something new, against the earlier state."""
    owner = t.events.select("user_id", "event_id")
    old = _stored(t.events).join(owner, "event_id")
    return incremental.updates_per_repository(t.events, old, "ts", "event_id", ["user_id"])


@query(
    f"""
    WITH old AS (SELECT o.*, e.user_id FROM ({_SQL_OLD}) o JOIN events e ON e.event_id = o.event_id),
    new AS (SELECT event_id, ts, event_type, user_id FROM events WHERE event_type <> 'error' OR user_id % 2 = 0),
    differing AS ((SELECT * FROM new EXCEPT ALL SELECT * FROM old) UNION ALL (SELECT * FROM old EXCEPT ALL SELECT * FROM new))
    SELECT DISTINCT c_custkey AS user_id, c_custkey IN (SELECT user_id FROM differing) AS has_updates
    FROM customer WHERE c_custkey % 3 = 0
    """
)
def children_per_repository(t: Source) -> DataFrame:
    """For which customers the events differ from the stored ones: some changed, came or went; some customers have none."""
    new = t.events.where((c("event_type") != "error") | (c("user_id") % 2 == 0)).select("event_id", "ts", "event_type", "user_id")
    old = _stored(t.events).join(t.events.select("event_id", "user_id"), "event_id")
    asked = t.customer.where(c("c_custkey") % 3 == 0).select(c("c_custkey").alias("user_id"))
    return incremental.children_per_repository(asked, new, old, ["user_id"])


@query(
    """
    SELECT event_id, ts, event_type FROM events
    WHERE (ts, event_id) > (SELECT (ts, event_id) FROM events WHERE event_id = 100)
    ORDER BY ts, event_id LIMIT 50
    """
)
def cursor_page(t: Source) -> DataFrame:
    """The page after a stored cursor (the position of event 100)."""
    cursor = t.events.where(c("event_id") == 100).select("ts", "event_id").first()
    return incremental.read_since(
        t.events.select("event_id", "ts", "event_type"), tuple(cursor) if cursor else None, 50, "ts", "event_id"
    )


@query("SELECT event_id, ts, (row_number() OVER (ORDER BY ts, event_id) - 1) // 1000 AS page FROM events")
def cursor_pages(t: Source) -> DataFrame:
    """All pages that paging by cursor to the end would give."""
    return incremental.cursor_pages(t.events.select("event_id", "ts"), 1000, "ts", "event_id")


@query(
    """
    SELECT user_id, event_id, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) // 10 AS page
    FROM events
    """
)
def cursor_pages_per_parent(t: Source) -> DataFrame:
    events = t.events.select("user_id", "event_id", "ts")
    return incremental.cursor_pages(events, 10, "ts", "event_id", ["user_id"]).drop("ts")


@query(
    """
    SELECT user_id, event_id, ts FROM events
    QUALIFY CASE WHEN count(*) OVER (PARTITION BY user_id) < 3 THEN 0 ELSE 3 END
        BETWEEN row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 5
            AND row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1
    """
)
def next_pages(t: Source) -> DataFrame:
    """Five more events of every user, after cursors on the third event of those that have three."""
    events = t.events.select("user_id", "event_id", "ts")
    read = first_rows(events, ["user_id"], [c("ts"), c("event_id")], 3)
    enough = read.groupBy("user_id").count().where("count = 3")
    cursors = incremental.advance_cursors(events.limit(0), read.join(enough, "user_id", "left_semi"), "ts", "event_id", ["user_id"])
    return incremental.next_pages(events, cursors, 5, "ts", "event_id", ["user_id"])


@query(
    """
    WITH pool AS (
      SELECT event_id AS id, NULL::BIGINT AS issue_id, event_type AS event, 0 AS f FROM events WHERE event_type <> 'error'
      UNION ALL SELECT event_id, user_id, event_type, 1 FROM events WHERE event_type <> 'view'
      UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, 1 FROM orders WHERE o_orderstatus = 'F'
    )
    SELECT id, issue_id, event FROM pool QUALIFY row_number() OVER (PARTITION BY id ORDER BY f, issue_id, event) = 1
    """
)
def events_overflow_union(t: Source) -> DataFrame:
    """Events of the flat listing and those found under issues, each once."""
    event = lambda df, key, parent, kind: df.select(
        c(key).alias("id"), parent.alias("issue_id"), c(kind).alias("event")
    )
    listed = event(t.events.where(c("event_type") != "error"), "event_id", lit(None).cast("long"), "event_type")
    nested = event(t.events.where(c("event_type") != "view"), "event_id", c("user_id"), "event_type").unionByName(
        event(t.orders.where(c("o_orderstatus") == "F"), "o_orderkey", c("o_custkey"), "o_orderstatus")
    )
    return incremental.overflow_union(listed, nested, ["id"], ["issue_id", "event"])


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem QUALIFY count(*) OVER (PARTITION BY l_orderkey) <= 4")
def cap_modifications(t: Source) -> DataFrame:
    edits = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return incremental.cap_modifications(edits, 4, ["l_orderkey"])


@query("SELECT event_id, ts, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 1000 OFFSET 500")
def sorted_page(t: Source) -> DataFrame:
    return ordering.page(t.events.select("event_id", "ts", "value"), 1000, 500, "ts", "event_id", ascending=False)


@query("SELECT event_id, ts, value FROM events ORDER BY ts, event_id")
def sorted_listing(t: Source) -> DataFrame:
    return ordering.sort_by_update(t.events.select("event_id", "ts", "value"), "ts", "event_id")


@query(
    """
    SELECT user_id, event_id, event_type FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) <= 3
    """
)
def top_n_per_parent(t: Source) -> DataFrame:
    return ordering.first_per_parent(t.events, ["user_id"], ["ts", "event_id"], 3).select("user_id", "event_id", "event_type")


@query(
    """
    SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) <= 5000
    """
)
def request_maximum_per_parent(t: Source) -> DataFrame:
    """A large number of rows of each of a few parents."""
    lines = t.lineitem.select("l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return ordering.first_per_parent(lines, ["l_returnflag"], order, 5000)


@query(
    """
    (SELECT 'newest' AS pick, event_id, ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 1)
    UNION ALL (SELECT 'third', event_id, ts FROM events ORDER BY ts, event_id LIMIT 1 OFFSET 2)
    """
)
def nth_item(t: Source) -> DataFrame:
    events = t.events.select("event_id", "ts")
    newest = ordering.nth(events, 0, "ts", "event_id").withColumn("pick", lit("newest"))
    third = ordering.nth(events, 2, "ts", "event_id", newest_first=False).withColumn("pick", lit("third"))
    return newest.unionByName(third)


@query("SELECT o_orderkey, o_orderdate, o_orderstatus FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderdate, o_orderkey")
def state_sorted(t: Source) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_orderdate", "o_orderstatus")
    return ordering.listing(orders, "O", "o_orderstatus", "o_orderdate", "o_orderkey")
