"""Duplicate passages by relative Lempel-Ziv parsing against an index of reference blocks.

Every window of ``WINDOW`` words has an anchor: the smallest hash among its runs of ``ANCHOR`` words. Neighbouring
windows with the same anchor form a block, so that equal passages are cut into equal blocks wherever they stand. The
blocks of all documents are indexed by their anchor and fingerprint, each entry with the smallest id that has it.

A document is parsed greedily, block by block, against every entry of its anchors: a block that a document with a
smaller id has as a whole extends the current factor by all its windows. Where a factor ends, the block differs from
all earlier ones of its anchor although parts of it may be known. Only such boundary blocks are checked window by
window, against the windows of all other variants of the same anchor, one document per variant. Windows found either
way become spans, and the words in spans are removed. Equal windows have equal anchors, so no window is missed.

Entries are keyed by two 64-bit hashes (anchor and content). Groups of copies shrink to one variant per block before
anything is compared; a passage that a third of all documents share is aggregated in the map tasks, and joins are
against sides that are unique on their key.

Defined results: a NULL, empty or blank text has no words; texts below ``WINDOW`` words lose nothing; a row without an
id neither loses words nor makes others lose any; rows that share an id are parsed one by one, none against another; no
documents give no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repolume.llm.common import hash_windows, hash_words, mix, settled, texts_of

WINDOW = 50
ANCHOR = 16
_CHUNK = 1 << 16


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()


def digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def windows(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every window its hash, its anchor and the position of its anchor."""
    hashes = hash_words(words)
    whole = hash_windows(hashes, WINDOW)
    grams = hash_windows(hashes, ANCHOR)
    reach = WINDOW - ANCHOR + 1
    at = np.empty(len(whole), dtype=np.int64)
    for first in range(0, len(whole), _CHUNK):  # in chunks, so a long text needs no more memory than its words
        view = np.lib.stride_tricks.sliding_window_view(grams[first : first + _CHUNK + reach - 1], reach)
        at[first : first + len(view)] = view.argmin(axis=1) + np.arange(first, first + len(view))
    return whole, grams[at], at


def blocks(words: list[bytes]) -> list[np.ndarray]:
    """Anchor, fingerprint, first window and number of windows of every block."""
    if len(words) < WINDOW:
        empty = np.empty(0, dtype=np.int64)
        return [empty, empty, empty, empty]
    whole, anchors, at = windows(words)
    starts = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    counts = np.diff(np.append(starts, len(whole)))
    inside = np.arange(len(whole), dtype=np.uint64) - np.repeat(starts, counts).astype(np.uint64)
    sums = np.add.reduceat(whole * (inside * np.uint64(2) + np.uint64(1)), starts)
    prints = mix(sums + counts.astype(np.uint64))
    return [anchors[starts].view(np.int64), prints.view(np.int64), starts, counts]


def _parsed(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, n_words, sha and blocks of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, found, ends = [], [], [[], [], [], []], [0]
            for text in texts_of(batch):
                words = words_of(text)
                counts.append(len(words))
                digests.append(digest(words))
                for column, values in zip(found, blocks(words), strict=True):
                    column.append(values)
                ends.append(ends[-1] + len(found[0][-1]))
            flat = [pa.array(np.concatenate(column) if column else [], pa.int64()) for column in found]
            flat[2:] = [column.cast(pa.int32()) for column in flat[2:]]
            cut = pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.StructArray.from_arrays(flat, names=["anchor", "print", "at", "n"])
            )
            columns = [batch.column("doc_id"), batch.column("row_key"), pa.array(counts, pa.int64()), pa.array(digests), cut]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "row_key", "n_words", "sha", "blocks"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    cut = "array<struct<anchor: bigint, print: bigint, at: int, n: int>>"
    return docs.mapInArrow(run, f"doc_id {kind}, row_key long, n_words long, sha string, blocks {cut}")


def _window_rows(rows: DataFrame) -> DataFrame:
    """doc_id, row_key, anchor, hash and at of the windows in ``spans`` (first window, count) of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, row_key, text, spans in zip(*(batch.column(i) for i in range(4)), strict=True):
                whole, anchors, _ = windows(words_of(text.as_py()))
                at = np.concatenate([np.arange(s["at"], s["at"] + s["n"]) for s in spans.as_py()])
                n = len(at)
                columns = [
                    pa.array([doc_id.as_py()] * n, batch.column(0).type), pa.array([row_key.as_py()] * n, pa.int64()),
                    pa.array(anchors[at].view(np.int64)), pa.array(whole[at].view(np.int64)), pa.array(at, pa.int32()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "row_key", "anchor", "hash", "at"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "row_key", "text", "spans").mapInArrow(
        run, f"doc_id {kind}, row_key long, anchor long, hash long, at int"
    )


def _without(rows: DataFrame) -> DataFrame:
    """doc_id, row_key, n_removed, sha and kept_text of texts without the words of their ``spans``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, digests, kept_texts = [], [], []
            for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
                words = words_of(text.as_py())
                edges = np.zeros(len(words) + 1, dtype=np.int64)
                for span in spans.as_py():
                    edges[span["at"]] += 1
                    edges[span["at"] + span["n"] + WINDOW - 1] -= 1
                keep = np.cumsum(edges[:-1]) == 0
                kept = [word for word, stays in zip(words, keep, strict=True) if stays]
                removed.append(len(words) - len(kept))
                digests.append(digest(kept))
                kept_texts.append(b" ".join(kept).decode("utf-8", "surrogatepass"))
            columns = [batch.column("doc_id"), batch.column("row_key"), pa.array(removed, pa.int64()), pa.array(digests)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(kept_texts)], names=["doc_id", "row_key", "n_removed", "sha", "kept_text"]
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "row_key", "text", "spans").mapInArrow(
        run, f"doc_id {kind}, row_key long, n_removed long, sha string, kept_text string"
    )


def remove_duplicate_passages(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two frames: doc_id, row_key, n_words and sha of every row; and doc_id, row_key, n_removed, sha and kept_text of
    the rows that lose words."""
    keyed = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("row_key"), "text")
    parsed = settled(_parsed(keyed), "substring-parsed")
    key = ["doc_id", "row_key"]
    cut = parsed.where("doc_id IS NOT NULL").select(*key, F.inline("blocks"))
    known = cut.groupBy("anchor").agg(F.min("doc_id").alias("_least"), F.max("doc_id").alias("_most"))
    # settled, as are the other small sides below: a join whose side is aggregated in the same stage is not split
    known = settled(known.where("_least <> _most").select("anchor"), "substring-known")
    shared = settled(cut.join(known, "anchor", "left_semi"), "substring-shared")

    variants = settled(shared.groupBy("anchor", "print").agg(F.min("doc_id").alias("_least")), "substring-variants")
    counts = variants.groupBy("anchor").agg(F.count(F.lit(1)).alias("_variants"))
    index = settled(variants.join(settled(counts, "substring-counts"), "anchor"), "substring-index")
    placed = settled(
        shared.join(index, ["anchor", "print"]).select(
            *key, "at", "n", (F.col("doc_id") > F.col("_least")).alias("known"), "_variants"
        ).where("known OR _variants > 1"),
        "substring-placed",
    )
    factors = placed.where("known").select(*key, "at", "n")
    borders = placed.where("NOT known").select(*key, "at", "n")

    touched = placed.select(key).distinct()
    texts = settled(keyed.join(touched, key, "left_semi").dropDuplicates(key), "substring-texts")
    gather = lambda rows: rows.groupBy(key).agg(F.collect_list(F.struct("at", "n")).alias("spans"))
    checked = settled(_window_rows(texts.join(gather(borders), key)), "substring-windows")
    earliest = checked.groupBy("anchor", "hash").agg(F.min("doc_id").alias("_least"))
    found = checked.join(settled(earliest, "substring-earliest"), ["anchor", "hash"]).where("doc_id > _least")
    spans = factors.unionByName(found.select(*key, "at", F.lit(1).alias("n")))
    return parsed.select(*key, "n_words", "sha"), _without(texts.join(gather(spans), key))


def substring_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row of ``docs`` (doc_id, text)."""
    every, shortened = remove_duplicate_passages(docs)
    changed = shortened.select("doc_id", "row_key", "n_removed", F.col("sha").alias("_sha"))
    return every.join(changed, ["doc_id", "row_key"], "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("_sha", "sha").alias("kept_sha256"),
    )
