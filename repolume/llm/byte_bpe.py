"""Byte-level BPE encoding and decoding with a given rank file.

A text is cut into words by a pattern; each word's bytes are merged pair by pair, always the pair whose concatenation
has the lowest rank (the leftmost of equals), until no pair is in the vocabulary. Words are encoded once, not once per
occurrence:

1. All words of all texts are counted. The threshold that leaves at most ``HEAD`` distinct words comes from a
   histogram of the counts, so nothing is sorted in one task.
2. The words at or above it are encoded by Spark higher-order functions: ``aggregate`` folds the merges over the array
   of a word's bytes, and looks ranks up in a broadcast row (hashed into ``BUCKETS`` small maps, as a map is searched
   linearly). The result, of bounded size, is broadcast.
3. Every text is then encoded where it lies, with nothing shuffled. Words below the threshold, and words of more than
   ``LONG`` bytes, are merged in the task by the byte-pair library, once per task; white space that its pattern gives
   up on is merged by the same rule here, with a heap, so that a run of a million takes no quadratic time.

Decoding concatenates the binary pieces of the ids. ``encode_and_decode`` does both in one pass over the texts: what a
word adds to the digests is made once per word and task, so a text is cut once and joined twice; the ids are read from
the decimals that the first digest is of.

Defined results: a NULL or empty text has no ids and decodes to no bytes; repeated rows are encoded alike; no documents
give no rows. Every byte must have a rank in the file. Special tokens do not exist: their spelling is ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import zlib
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repolume.llm.common import discard, quick, settled, settled_in_batches, slices, texts_of

HEAD = 1 << 17
BUCKETS = 1 << 15
GROUPS = 1 << 9  # of the head's words, for encoding
LONG = 64
_KEPT = 1 << 18  # words a task remembers or counts before it starts anew
_NONE = 1 << 62


def read_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary: lines of base64 and rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one word."""
    if word in ranks and len(word) == 1:
        return [ranks[word]]
    if len(word) > LONG:
        return _merge_long(word, ranks)
    parts = [word[at : at + 1] for at in range(len(word))]
    while len(parts) > 1:
        found = [ranks.get(left + right, _NONE) for left, right in zip(parts, parts[1:])]
        least = min(found)
        if least == _NONE:
            break
        at = found.index(least)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[part] for part in parts]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    ends = list(range(1, len(word) + 1))  # of the part that begins here; 0: none begins here
    before = list(range(-1, len(word) - 1))
    heap: list[tuple[int, int, int, int]] = []

    def offer(at: int) -> None:
        middle = ends[at]
        if middle < len(word):
            rank = ranks.get(word[at : ends[middle]])
            if rank is not None:
                heapq.heappush(heap, (rank, at, middle, ends[middle]))

    for at in range(len(word)):
        offer(at)
    while heap:
        _, at, middle, end = heapq.heappop(heap)
        if ends[at] != middle or ends[middle] != end:
            continue  # one of the two has been merged since
        ends[at], ends[middle] = end, 0
        if end < len(word):
            before[end] = at
        offer(at)
        if before[at] >= 0:
            offer(before[at])
    ids, at = [], 0
    while at < len(word):
        ids.append(ranks[word[at : ends[at]]])
        at = ends[at]
    return ids


def _library(ranks: dict[bytes, int], pattern: str) -> Callable[[str], list[int]]:
    """The ids of a word by the byte-pair library."""
    merge = tiktoken.Encoding("own", pat_str=quick(pattern), mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def ids_of(word: str) -> list[int]:
        try:
            return merge(word)
        except ValueError:  # its pattern gives up on a long run of white space
            return merge_word(word.encode("utf-8", "surrogatepass"), ranks)

    return ids_of


class _Words(dict):
    """An entry for each word: those of the head are made in advance, the others when they are first asked for."""

    def __init__(self, head: Iterator[tuple], entry: Callable, merge: Callable) -> None:
        super().__init__((word, entry(ids)) for word, ids in head)
        self.head, self.entry, self.merge = dict(self), entry, merge

    def __missing__(self, word: str):
        if len(self) > len(self.head) + _KEPT:
            self.clear()
            self.update(self.head)
        found = self[word] = self.entry(self.merge(word))
        return found


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fold_merges(word: Column, ranks: dict[bytes, int]) -> Column:
    """The ids of a word (binary, one byte or more), by higher-order functions only; ``ranks`` become a literal, so this
    is for few words and small plans."""
    maps: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    for piece, rank in ranks.items():
        key = piece.hex().upper()
        maps[zlib.crc32(key.encode()) % BUCKETS][key] = rank
    literal = F.from_json(F.lit(json.dumps(maps)), "array<map<string,int>>")  # folded into one literal
    return _let(literal, lambda table: _folded(word, table))


def rank_table(spark: SparkSession, ranks: dict[bytes, int]) -> DataFrame:
    """One row, ``table``: the ranks by hex digits, hashed into ``BUCKETS`` small maps. A literal of them would be printed
    with every plan and sent with every task."""
    pieces = spark.createDataFrame(pa.table({"piece": pa.array(ranks, pa.binary()), "rank": pa.array(ranks.values(), pa.int32())}))
    key = F.hex("piece")
    bucket = (F.crc32(key.cast("binary")) % BUCKETS).alias("bucket")
    entries = pieces.select(bucket, F.struct(key.alias("key"), "rank").alias("entry")).groupBy("bucket").agg(
        F.collect_list("entry").alias("entries")
    )
    every = spark.range(BUCKETS).withColumnRenamed("id", "bucket").join(entries, "bucket", "left")
    none = F.array().cast("array<struct<key:string,rank:int>>")
    ordered = F.sort_array(F.collect_list(F.struct("bucket", F.coalesce("entries", none).alias("entries"))))
    return every.agg(F.transform(ordered, lambda one: F.map_from_entries(one["entries"])).alias("table"))


def _folded(word: Column, table: Column) -> Column:
    """The ids of a word by the maps of ``rank_table``. Bytes are two hex digits here."""

    def rank(key: Column) -> Column:
        bucket = (F.crc32(key.cast("binary")) % BUCKETS).cast("int")
        return F.try_element_at(F.get(table, bucket), key)

    def merge(parts: Column, _: Column) -> Column:
        pair = lambda at: F.concat(F.get(parts, at - 1), F.get(parts, at))
        ranked = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda at: rank(pair(at)))
        joined = lambda at: F.concat(
            F.slice(parts, 1, at - 1), F.array(pair(at)), F.slice(parts, at + 2, F.size(parts))
        )
        first = _let(ranked, lambda found: F.coalesce(F.array_position(found, F.array_min(found)), F.lit(0)))
        merged = _let(first.cast("int"), lambda at: F.when(at > 0, joined(at)).otherwise(parts))
        return F.when(F.size(parts) > 1, merged).otherwise(parts)

    single = F.regexp_extract_all(F.hex(word), F.lit(".."), F.lit(0))
    parts = _let(single, lambda bytes_: F.aggregate(F.sequence(F.lit(1), F.size(bytes_)), bytes_, merge))
    return F.transform(parts, rank)


def count_words(docs: DataFrame, pattern: str) -> DataFrame:
    """word and n of every distinct word of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = regex.compile(quick(pattern)).findall
        counts: Counter[str] = Counter()
        for batch in batches:
            for text in texts_of(batch):
                counts.update(cut(text))
                if len(counts) > _KEPT:
                    yield _counted(counts)
                    counts.clear()
        yield _counted(counts)

    partial = docs.select("text").mapInArrow(run, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


def _counted(counts: Counter[str]) -> pa.RecordBatch:
    columns = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["word", "n"])


def encoded_head(docs: DataFrame, ranks: dict[bytes, int], pattern: str, head: int = HEAD) -> DataFrame:
    """word and ids of the most frequent words, at most ``head`` of them."""
    counts = settled_in_batches(count_words(docs, pattern).where(F.octet_length("word") <= LONG), "bpe-words")
    # exact counts up to 999, then four steps per power of two: at most a thousand and some hundred rows
    step = F.when(F.col("n") < 1000, F.col("n")).otherwise(F.pow(2.0, F.floor(4 * F.log2("n")) / 4).cast("long"))
    left, least = head, None
    for row in sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True):
        if row["count"] > left:
            break
        left, least = left - row["count"], row["step"]
    chosen = counts.where(step >= least) if least is not None else counts.limit(0)
    # a bounded number of words, each dear: deal them out evenly, in groups that meet the table of ranks once
    slot = F.pmod(F.xxhash64("word"), F.lit(GROUPS)).alias("slot")
    groups = chosen.select(slot, "word").repartition(64, "slot").groupBy("slot").agg(F.collect_list("word").alias("words"))
    table = F.broadcast(rank_table(docs.sparkSession, ranks))  # one row of bounded size
    coded = lambda word: F.struct(word.alias("word"), _folded(F.encode(word, "UTF-8"), F.col("table")).alias("ids"))
    return groups.crossJoin(table).select(F.inline(F.transform("words", coded)))


def _shared(docs: DataFrame, ranks: dict[bytes, int], pattern: str, head: int):
    """The head's words and the ranks, broadcast."""
    # at most ``head`` words, kept in columns: the driver needs them only to pass them on
    settled_head = settled(encoded_head(docs, ranks, pattern, head), "bpe-head")
    known = settled_head.toArrow()
    discard(settled_head)
    return docs.sparkSession.sparkContext.broadcast((known, ranks))


def _rows(table: pa.Table) -> Iterator[tuple]:
    for batch in table.to_batches(max_chunksize=4096):
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, head: int = HEAD) -> DataFrame:
    """``docs`` with ``ids`` (array<int>) in place of any column of that name; every other column stays."""
    shared = _shared(docs, ranks, pattern, head)
    docs = docs.drop("ids")
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = regex.compile(quick(pattern)).findall
        table, ranks = shared.value
        ids_of = _Words(_rows(table), lambda ids: ids, _library(ranks, pattern)).__getitem__
        for batch in slices(batches):
            found = [
                np.fromiter(chain.from_iterable(map(ids_of, cut(text))), dtype=np.int32) for text in texts_of(batch, at)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, _lists(found)], names=[*batch.schema.names, "ids"])

    schema = docs.withColumn("ids", F.lit(None).cast("array<int>")).schema
    return docs.mapInArrow(run, schema)


def _lists(found: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
    flat = np.concatenate(found) if found else np.empty(0, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def encode_and_decode(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, keep: Sequence[str] = ("doc_id",), ids: bool = False,
    head: int = HEAD,
) -> DataFrame:
    """The columns ``keep`` of ``docs``, ``ids`` if asked for, and what ``decode`` adds, in one pass over the texts."""
    shared = _shared(docs, ranks, pattern, head)
    keep = list(keep)
    chosen = docs.select(*keep, F.col("text").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = regex.compile(quick(pattern)).findall
        table, ranks = shared.value
        piece_of = _pieces(ranks).__getitem__
        # plain text and bytes per word, in a table each: one lookup a word and no tuples
        decimals_of = _Words(_rows(table), lambda found: ",".join(map(str, found)), _library(ranks, pattern)).__getitem__
        bytes_of = _Words(
            iter(()), lambda found: b"".join(map(piece_of, found)), lambda word: map(int, decimals_of(word).split(","))
        ).__getitem__
        for batch in slices(batches):
            counts, ids_digests, digests, lists = [], [], [], []
            for text in texts_of(batch, "_text"):
                words = cut(text)
                decimals = ",".join(map(decimals_of, words))
                counts.append(decimals.count(",") + 1 if words else 0)
                ids_digests.append(hashlib.sha256(decimals.encode()).hexdigest())
                digests.append(hashlib.sha256(b"".join(map(bytes_of, words))).hexdigest())
                if ids:
                    lists.append(np.fromstring(decimals, dtype=np.int32, sep=",") if words else np.empty(0, dtype=np.int32))
            made = [pa.array(counts, pa.int64()), pa.array(ids_digests, pa.string()), pa.array(digests, pa.string())]
            columns = [*(batch.column(name) for name in keep), *([_lists(lists)] if ids else []), *made]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    added = {"ids": "array<int>"} if ids else {}
    added |= {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}
    names = [*keep, *added]
    schema = docs.select(*keep, *(F.lit(None).cast(kind).alias(name) for name, kind in added.items())).schema
    return chosen.mapInArrow(run, schema)


def _pieces(ranks: dict[bytes, int]) -> list[bytes]:
    """The bytes of each id."""
    pieces = [b""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece
    return pieces


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``encoded`` (ids, and others) with n_tokens, ids_sha256 (of the decimal ids, joined by commas) and
    decoded_sha256 (of the decoded bytes)."""
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)
    encoded = encoded.drop("n_tokens", "ids_sha256", "decoded_sha256")
    at = encoded.columns.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece_of = _pieces(shared.value)
        decimal = [str(rank) for rank in range(len(piece_of))]
        for batch in slices(batches):
            counts, ids_digests, digests = [], [], []
            for value in batch.column(at):
                ids = value.values.to_numpy(zero_copy_only=False).tolist() if value.is_valid else []
                counts.append(len(ids))
                ids_digests.append(hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                digests.append(hashlib.sha256(b"".join(map(piece_of.__getitem__, ids))).hexdigest())
            columns = [*batch.columns, pa.array(counts, pa.int64()), pa.array(ids_digests), pa.array(digests)]
            names = [*batch.schema.names, "n_tokens", "ids_sha256", "decoded_sha256"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return encoded.mapInArrow(
        run,
        encoded.withColumns(
            {
                "n_tokens": F.lit(None).cast("long"), "ids_sha256": F.lit(None).cast("string"),
                "decoded_sha256": F.lit(None).cast("string"),
            }
        ).schema,
    )


def decoded_bytes(ids: Column, ranks: dict[bytes, int]) -> Column:
    """The bytes of ``ids`` by built-in functions, for ids that are the numbers from 0."""
    pieces = [""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece.hex()
    literal = F.split(F.lit(",".join(pieces)), ",")
    return _let(literal, lambda table: F.unhex(F.array_join(F.transform(ids, lambda i: F.get(table, i)), "")))
