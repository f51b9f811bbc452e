"""The operators on whole test tables, with the SQL that has to give the same rows where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repolume.llm.byte_bpe import encode_and_decode, read_ranks
from repolume.llm.exact_dedup import exact_dedup
from repolume.llm.minhash import near_duplicates
from repolume.llm.mixing import mix_sources
from repolume.llm.packing import digests, pack
from repolume.llm.prefix_trie import ordered_turns, prefix_trie, rebuild
from repolume.llm.quality_mil import quality
from repolume.llm.quality_rules import judge
from repolume.llm.sharding import shard_documents
from repolume.llm.substring_dedup import substring_dedup
from repolume.llm.toxicity import toxicity
from repolume.llm.warc import derive, responses
from repolume.llm.whitening import by_component, whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of (spark, folder) under its name, with its SQL."""

    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query()
def op1_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


@query()
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op3_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return encode_and_decode(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)


@query(
    """
    WITH texts AS (
        SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS content
        FROM documents
    )
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
        doc_id = max(doc_id) OVER same AS kept, sha256(content) AS text_sha256
    FROM texts WINDOW same AS (PARTITION BY content)
    """
)
def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup(table(spark, folder, "documents"))


@query()
def op5_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup(table(spark, folder, "documents"))


@query()
def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shard_documents(table(spark, folder, "documents"), 8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query()
def op8_warc_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    return derive(responses(table(spark, folder, "pages")))


@query()
def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix_sources(table(spark, folder, "documents")).drop("source")


@query()
def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op11_packing(spark: SparkSession, folder: str) -> DataFrame:
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        content = file.read()
    return digests(pack(table(spark, folder, "documents"), content, public_tokenizers.PATTERN))


@query()
def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return by_component(whiten(table(spark, folder, "embeddings")))


@query(
    """
    WITH turns AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
            sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
            row_number() OVER (
                PARTITION BY conv_id
                ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))
            ) - 1 AS pos
        FROM conversations WHERE conv_id IS NOT NULL
    ),
    members AS (
        SELECT conv_id, count(*) AS turns, xor(list_reduce(
            list_transform(string_split(conv_id::VARCHAR, ''), lambda letter: ascii(letter)::BIGINT),
            lambda crc, byte: list_reduce(
                range(8), lambda old, step: CASE WHEN old & 1 = 1 THEN xor(old >> 1, 3988292384) ELSE old >> 1 END, xor(crc, byte)
            ),
            4294967295
        ), 4294967295) % 9 AS h
        FROM turns GROUP BY conv_id
    ),
    rebuilt AS (
        SELECT m.conv_id, b.pos, b.digest, strlen(b.text) AS bytes
        FROM members m JOIN turns b ON b.conv_id = m.conv_id - m.conv_id % 5 AND b.pos < m.h
        UNION ALL
        SELECT o.conv_id, o.pos - m.h + least(m.h, coalesce(base.turns, 0)), o.digest, strlen(o.text)
        FROM turns o JOIN members m ON m.conv_id = o.conv_id AND o.pos >= m.h
        LEFT JOIN members base ON base.conv_id = m.conv_id - m.conv_id % 5
    ),
    prefixes AS (
        SELECT conv_id, pos + 1 AS depth, list(digest) OVER (PARTITION BY conv_id ORDER BY pos) AS path, bytes FROM rebuilt
        UNION ALL
        SELECT conv_id, 0, []::VARCHAR[], 0 FROM members
    ),
    nodes AS (
        SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes
        FROM prefixes GROUP BY depth, path
    ),
    parents AS (
        SELECT c.depth, c.path, p.conv_id AS parent_conv_id
        FROM nodes c JOIN nodes p ON p.depth = c.depth - 1 AND p.path = c.path[1:c.depth - 1]
    ),
    children AS (
        SELECT depth - 1 AS depth, path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
    ),
    below AS (
        SELECT depth, path, unnest(range(0, depth + 1)) AS top, (n_convs - 1) * bytes AS saved FROM nodes
    ),
    subtrees AS (
        SELECT b.top AS depth, b.path[1:b.top] AS path, sum(b.saved)::BIGINT AS saved_tokens,
            count(*) FILTER (c.n_children IS NULL) AS n_leaves
        FROM below b LEFT JOIN children c ON c.depth = b.depth AND c.path = b.path GROUP BY ALL
    ),
    ends AS (
        SELECT depth, path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256
        FROM (SELECT conv_id, depth, path FROM prefixes QUALIFY depth = max(depth) OVER (PARTITION BY conv_id))
        GROUP BY depth, path
    )
    SELECT n.conv_id, n.depth, p.parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children, s.n_leaves, s.saved_tokens,
        coalesce(e.ends_sha256, sha256('')) AS ends_sha256
    FROM nodes n
    LEFT JOIN parents p ON p.depth = n.depth AND p.path = n.path
    LEFT JOIN children c ON c.depth = n.depth AND c.path = n.path
    JOIN subtrees s ON s.depth = n.depth AND s.path = n.path
    LEFT JOIN ends e ON e.depth = n.depth AND e.path = n.path
    """
)
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(rebuild(ordered_turns(table(spark, folder, "conversations"))))
