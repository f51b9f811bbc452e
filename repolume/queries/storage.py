"""Sinks, sources and streaming on the test tables. Whatever is written goes to the shared scratch folder."""

from __future__ import annotations

import io
import sys
import zipfile
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repolume.operators import projections
from repolume.plans.completion import read_wanted_issues, settle_wanted_issues
from repolume.queries.base import TABLE_NAMES, Source, naive, query, sql_pseudonym, tag
from repolume.queries.records import SQL_COMMENT_TIME, raw_comments, raw_events, raw_issues, raw_pull_requests
from repolume.schemas import REPO, TABLES
from repolume.session import scratch_dir
from repolume.sinks.tables import add_repositories, append_users, export_tables, read_export, save_table
from repolume.sources.archives import archive_lines, batched, count_members
from repolume.sources.tables import read_registry, read_table
from repolume.streaming.ingest import append_versions, current_state, stream_into_store, stream_pages

cloudpickle.register_pickle_by_value(sys.modules[__name__])

c, lit, when = F.col, F.lit, F.when


@query(" UNION ALL ".join(f"SELECT '{name}' AS \"table\", count(*) AS rows FROM {name}" for name in TABLE_NAMES))
def catalog_counts(t: Source) -> DataFrame:
    counts = [getattr(t, name).agg(F.count("*").alias("rows")).select(lit(name).alias("table"), "rows") for name in TABLE_NAMES]
    return reduce(DataFrame.unionByName, counts)


@query(
    """
    SELECT 'conversations' AS "table", conv_id AS id, role AS kind, text AS content FROM conversations
    UNION ALL SELECT 'documents', doc_id, source, text FROM documents
    UNION ALL SELECT 'embeddings', vec_id, label::VARCHAR, len(embedding)::VARCHAR FROM embeddings
    """
)
def export_roundtrip(t: Source) -> DataFrame:
    """Tables with long texts and arrays exported as CSV and read back."""
    folder = scratch_dir(t.spark, "export")
    tables = {"conversations": t.conversations, "documents": t.documents, "embeddings": t.embeddings}
    export_tables(tables, folder)
    back = {name: read_export(t.spark, folder, name, df.schema) for name, df in tables.items()}
    vector = F.size(F.from_json("embedding", "array<float>")).cast("string")
    row = lambda name, key, kind, content: back[name].select(
        lit(name).alias("table"), c(key).alias("id"), kind.cast("string").alias("kind"), content.alias("content")
    )
    return (
        row("conversations", "conv_id", c("role"), c("text"))
        .unionByName(row("documents", "doc_id", c("source"), c("text")))
        .unionByName(row("embeddings", "vec_id", c("label"), vector))
    )


@query(
    """
    SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'P' THEN 'edited' ELSE o_orderpriority END AS body,
           concat('org/', o_orderstatus) AS repo_full_name
    FROM orders
    """
)
def stored_table_replace(t: Source) -> DataFrame:
    """Issues stored for all repositories, then replaced for one of them."""
    root = scratch_dir(t.spark, "tables")
    issues = projections.issues(raw_issues(t.orders))
    save_table(issues, root, "issues")
    edited = read_table(t.spark, root, "issues", ["org/P"]).withColumn("body", lit("edited"))
    save_table(edited, root, "issues")
    return read_table(t.spark, root, "issues").select("id", "body", REPO)


@query(
    """
    SELECT concat('C', c_custkey) AS id, CASE WHEN c_acctbal > 0 THEN c_name ELSE 'later' END AS name,
           CASE WHEN c_acctbal > 0 THEN c_custkey
                ELSE (SELECT max(c_custkey) FROM customer WHERE c_acctbal > 0) + 1 + c_custkey END AS seq
    FROM customer
    """
)
def users_insert(t: Source) -> DataFrame:
    """Users stored in two steps: known ones keep what was stored first, the others come after all that are stored."""
    root, spec = scratch_dir(t.spark, "users"), TABLES["users"]
    none = lit(None).cast("string")
    users = t.customer.select(
        lit("org/x").alias(REPO), tag("P", "c_custkey").alias("anonym_uuid"), tag("C", "c_custkey").alias("id"),
        c("c_name").alias("name"), none.alias("email"), none.alias("login"), lit(None).cast("array<string>").alias("alias"),
        c("c_custkey").alias("seq"),
    ).select(*spec.columns)
    append_users(users.join(t.customer.where("c_acctbal > 0"), c("seq") == c("c_custkey"), "left_semi"), root)
    append_users(users.withColumn("name", lit("later")), root)
    return read_table(t.spark, root, "users").select("id", "name", "seq")


@query("SELECT DISTINCT concat(p_brand, '/', p_type) AS repo_full_name FROM part")
def registry_roundtrip(t: Source) -> DataFrame:
    """Repositories registered twice are there once."""
    path = scratch_dir(t.spark, "registry")
    names = t.part.select(F.concat_ws("/", "p_brand", "p_type").alias(REPO))
    add_repositories(t.spark, path, names.where(c("p_size") > 10))
    add_repositories(t.spark, path, names)
    return read_registry(t.spark, path)


def _pages(raw: DataFrame) -> DataFrame:
    """Raw records as pages of their listing, one record each."""
    record = F.struct(*[name for name in raw.columns if name not in (REPO, "seq")])
    return raw.select(REPO, c("seq").alias("page"), F.array(record).alias("items"))


@query(
    f"""
    SELECT event_id AS id, json_extract_string(props, '$.k')::BIGINT AS issue_id, event_type AS event,
           {sql_pseudonym("concat('U', user_id)")} AS author, ts AS created_at
    FROM events
    """
)
def stream_cursor_ingest(t: Source) -> DataFrame:
    """Events landed as pages, errors twice as overlapping windows do, streamed into a version log and read there."""
    spark, folder = t.spark, scratch_dir(t.spark, "stream")
    raw = raw_events(t.events)
    again = raw.where(c("event") == "error").withColumn("seq", c("seq") + 1)
    landed = _pages(raw.unionByName(again))
    landed.write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(f"{folder}/landed")
    stream = stream_pages(spark, f"{folder}/landed", "issue_event", max_files=1000)
    append_versions(stream, f"{folder}/log", f"{folder}/checkpoint", projections.issue_events).awaitTermination()
    state = current_state(spark, f"{folder}/log", TABLES["issue_events"].schema, updated_at="created_at")
    return naive(state.select("id", "issue_id", "event", "author", "created_at"))


@query(
    f"""
    SELECT 'org/chat' AS repo_full_name, conv_id * 1000 + turn AS id, {sql_pseudonym("role")} AS author, text AS body,
           {SQL_COMMENT_TIME} AS updated_at
    FROM conversations
    """
)
def stream_store_ingest(t: Source) -> DataFrame:
    """Comments streamed into the store: stale versions of two thirds first, all of them, and stale ones again, late."""
    spark, folder = t.spark, scratch_dir(t.spark, "stream-store")
    raw = raw_comments(t.conversations).drop("reactions")
    stale = raw.withColumns({"updated_at": c("updated_at") - F.expr("interval 1 day"), "body": lit("stale")})
    for part in (stale.where("id % 3 > 0"), raw, stale):
        pages = _pages(part).write.mode("append").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        pages.json(f"{folder}/landed")
        stream = stream_pages(spark, f"{folder}/landed", "issue_comment")
        stream_into_store(stream, f"{folder}/store", "issue_comments", f"{folder}/check", projections.issue_comments).awaitTermination()
    return naive(read_table(spark, f"{folder}/store", "issue_comments").select(REPO, "id", "author", "body", "updated_at"))


@query(
    """
    SELECT concat('org/', o_orderstatus) AS repo_full_name, o_orderkey AS number, o_orderkey * 3 AS pull_request_id
    FROM orders
    WHERE NOT (o_orderpriority LIKE '1%' AND (o_orderstatus <> 'O' OR o_totalprice > 100000))
    """
)
def wanted_issues(t: Source) -> DataFrame:
    """The ledger of missing issues: all pull requests land, then the issues of two repositories, then the dear ones of a third.
    Issues that are not flagged as pull requests settle nothing."""
    root = scratch_dir(t.spark, "wanted")
    issues = projections.issues(raw_issues(t.orders))
    pulls = projections.pull_requests(raw_pull_requests(t.orders)).withColumn("id", c("id") * 3)
    save_table(pulls, root, "pull_requests")
    settle_wanted_issues(t.spark, root, pulls)
    landed = issues.where(c(REPO) != "org/O")
    save_table(landed, root, "issues")
    settle_wanted_issues(t.spark, root, landed)
    dear = t.orders.where((c("o_orderstatus") == "O") & (c("o_totalprice") > 100000))
    late = projections.issues(raw_issues(dear))
    save_table(late, root, "issues")
    settle_wanted_issues(t.spark, root, late)
    return read_wanted_issues(t.spark, root)


def _zip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One archive per document: its paragraphs as members; French ones stay plain bytes."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for values in zip(*batch.columns):
                doc_id, lang, text = (value.as_py() for value in values)
                if lang == "fr":
                    yield doc_id, text.encode()
                    continue
                buffer = io.BytesIO()
                with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                    for number, paragraph in enumerate(text.split("\n\n")):
                        archive.writestr(f"{number}.txt", paragraph)
                yield doc_id, buffer.getvalue()

    return batched(rows(), pa.schema({"run_id": pa.int64(), "payload": pa.binary()}))


def _archives(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", "lang", "text").mapInArrow(_zip, "run_id long, payload binary")


@query(
    """
    SELECT doc_id AS run_id,
           CASE WHEN lang <> 'fr' THEN len(string_split(text, chr(10) || chr(10))) END::BIGINT AS members
    FROM documents
    """
)
def log_archive_members(t: Source) -> DataFrame:
    return count_members(_archives(t.documents))


@query(
    """
    WITH members AS (
      SELECT doc_id, unnest(string_split(text, chr(10) || chr(10))) AS body FROM documents WHERE lang <> 'fr'
    ), counted AS (
      SELECT doc_id, len(string_split(body, chr(10))) - CASE WHEN body = '' OR ends_with(body, chr(10)) THEN 1 ELSE 0 END AS lines,
             length(replace(body, chr(10), '')) AS chars
      FROM members
    )
    SELECT doc_id AS run_id, sum(lines)::BIGINT AS lines, sum(chars)::BIGINT AS chars
    FROM counted GROUP BY 1 HAVING sum(lines) > 0
    """
)
def log_archive_lines(t: Source) -> DataFrame:
    """Lines and characters of all members of each archive."""
    return archive_lines(_archives(t.documents)).groupBy("run_id").agg(
        F.count("*").alias("lines"), F.sum(F.length("text")).alias("chars")
    )
