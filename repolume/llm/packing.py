"""Packing of documents into training sequences along a Hilbert curve.

1. Every text is tokenized, and its token ids are hashed into a sparse vector that a fixed random projection brings
   down to ``DIMENSIONS`` numbers. Ids are kept as one compressed value per document.
2. The numbers are standardized over the whole corpus (sums of whole numbers, so that reruns agree), cut into
   ``2 ** BITS`` steps each, and become the document's position on a Hilbert curve: documents with similar words lie
   close together on it.
3. Documents are range-sorted by that key. Every task adds up the tokens of its range, and the ranges' totals are added
   up over the ranges, which gives each document the place of its first token in one long stream. Only keys, ids and
   token counts are sorted, never texts or tokens.
4. The stream is cut every ``length`` tokens; what is left at its end is cut into powers of two. A document is cut
   wherever its sequence ends, so no sequence needs padding but for the rule of the caller.

Ids are those of the tokenizer file: its vocabulary and merges are run by a byte-pair library that gives the same ids
several times faster; a text which that library refuses (white space without end) goes through the tokenizer itself.

Defined results: a NULL text is an empty one, and an empty text is a document of the end token alone; documents at one
place of the curve are ordered by doc_id (NULL first), then by their tokens; repeated rows are packed one by one; no
documents give no rows. Other columns are ignored, whatever they are called. Spellings of special tokens are text.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType
from tokenizers import Tokenizer

from repolume.llm.common import mix, quick, settled, texts_of

LENGTH = 1024
END = 0  # the id after each document
DIMENSIONS = 4
BITS = 15  # of the key, per dimension
FEATURES = 1 << 12  # coordinates of the hashed vector
STEPS = 1 << 10  # into which a unit of a projected coordinate is divided
# a document has at most so many pieces in one batch of the result
_ROWS = 1 << 16

# coordinates of the ids that a vocabulary of usual size has
_FEATURE_OF = (mix(np.arange(1 << 16, dtype=np.uint64)) % np.uint64(FEATURES)).astype(np.int64)
_PROJECTION = np.random.default_rng(11).choice([-1.0, 1.0], (FEATURES, DIMENSIONS))


# ---- tokens -------------------------------------------------------------------------------------------------------


def byte_alphabet() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable Latin-1 letters stand for themselves,
    the other bytes, ascending, for the letters from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = sorted({*range(256)} - {*plain})
    return {chr(byte): byte for byte in plain} | {chr(256 + at): byte for at, byte in enumerate(others)}


@lru_cache(maxsize=2)
def _encoders(content: str, pattern: str) -> tuple[tiktoken.Encoding, Tokenizer]:
    letters = byte_alphabet()
    vocabulary = json.loads(content)["model"]["vocab"]
    ranks = {bytes(letters[letter] for letter in piece): rank for piece, rank in vocabulary.items()}
    # a special token that is never allowed: without any, the library looks for none at every place of a text
    none = {"\0<|none|>\0": max(ranks.values()) + 1}
    fast = tiktoken.Encoding("byte_bpe", pat_str=quick(pattern), mergeable_ranks=ranks, special_tokens=none)
    own = Tokenizer.from_str(content)
    own.encode_special_tokens = True
    return fast, own


def token_ids(text: str, content: str, pattern: str) -> np.ndarray:
    """The ids of ``text`` by the tokenizer file ``content``, without special tokens."""
    fast, own = _encoders(content, pattern)
    try:
        return fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)
    except ValueError:  # its pattern has given up on a long run of white space
        return np.array(own.encode(text, add_special_tokens=False).ids, dtype="<u4")


def project(ids: np.ndarray) -> np.ndarray:
    """The hashed vector of a document, of unit length, in ``DIMENSIONS`` whole numbers."""
    if ids.max(initial=0) < len(_FEATURE_OF):
        features = _FEATURE_OF[ids]
    else:
        features = (mix(ids.astype(np.uint64)) % np.uint64(FEATURES)).astype(np.int64)
    counts = np.bincount(features, minlength=FEATURES)
    met = np.flatnonzero(counts)
    weights = np.log1p(counts[met])
    return np.rint(weights @ _PROJECTION[met] / np.sqrt((weights**2).sum()) * STEPS).astype(np.int64)


def tokenized(docs: DataFrame, content: str, pattern: str, end: int = END) -> DataFrame:
    """doc_id, n (ids, the end included), ids (compressed) and p0, p1, ... of every row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(content)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            sizes, blobs, places = [], [], []
            for text in texts_of(batch):
                ids = np.append(token_ids(text, shared.value, pattern), np.uint32(end)).astype("<u4")
                sizes.append(len(ids))
                blobs.append(pack((ids.astype("<u2") if ids.max() < 1 << 16 else ids).tobytes()))
                places.append(project(ids))
            axes = np.array(places, dtype=np.int64).reshape(-1, DIMENSIONS).T
            columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(blobs, pa.binary()), *map(pa.array, axes)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "ids", *(f"p{at}" for at in range(DIMENSIONS))])

    kind = docs.schema["doc_id"].dataType.simpleString()
    axes = ", ".join(f"p{at} long" for at in range(DIMENSIONS))
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n long, ids binary, {axes}")


def unpacked(blob: bytes, n: int) -> np.ndarray:
    """The ``n`` ids of a compressed value."""
    raw = zstandard.ZstdDecompressor().decompress(blob)
    return np.frombuffer(raw, dtype=f"<u{len(raw) // n}").astype("<u4", copy=False)


# ---- order --------------------------------------------------------------------------------------------------------


def hilbert(axes: np.ndarray, bits: int) -> np.ndarray:
    """The position on the Hilbert curve of each column of ``axes`` (dimensions x points, 0 to 2 ** bits - 1).

    After J. Skilling, Programming the Hilbert curve (2004): undo the excess rotations from the highest bit down, Gray-
    encode, and read the bits of all axes in turn.
    """
    x = axes.astype(np.uint64)
    one = np.uint64(1)
    for bit in range(bits - 1, 0, -1):
        below = np.uint64((1 << bit) - 1)
        for at in range(len(x)):
            turned = (x[at] >> np.uint64(bit)) & one == one
            swapped = np.where(turned, np.uint64(0), (x[0] ^ x[at]) & below)
            x[0] ^= np.where(turned, below, swapped)
            x[at] ^= swapped
    for at in range(1, len(x)):
        x[at] ^= x[at - 1]
    flips = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        flips ^= np.where((x[-1] >> np.uint64(bit)) & one == one, np.uint64((1 << bit) - 1), np.uint64(0))
    x ^= flips
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for axis in x:
            key = (key << one) | ((axis >> np.uint64(bit)) & one)
    return key.astype(np.int64)


def with_key(rows: DataFrame) -> DataFrame:
    """``rows`` with ``key``, their place on the curve, in place of p0, p1, ...

    An axis is divided evenly between three standard deviations below and above its mean; what lies beyond goes to the
    outermost steps.
    """
    axes = [f"p{at}" for at in range(DIMENSIONS)]
    exact = "decimal(38,0)"
    sums = [F.sum(F.col(axis).cast(exact)).alias(axis) for axis in axes]
    squares = [F.sum((F.col(axis) * F.col(axis)).cast(exact)).alias(f"{axis}_2") for axis in axes]
    total = rows.agg(F.count(F.lit(1)).alias("n"), *sums, *squares).first()
    n = max(total["n"], 1)
    means = np.array([float(total[axis] or 0) / n for axis in axes])
    spreads = np.array([max(float(total[f"{axis}_2"] or 0) / n - mean**2, 0.0) ** 0.5 for axis, mean in zip(axes, means)])
    least, width = means - 3 * spreads, np.maximum(6 * spreads, 1.0)

    @F.pandas_udf(LongType())
    def place(*columns: pd.Series) -> pd.Series:
        points = np.array([column.to_numpy(dtype=float) for column in columns])
        steps = np.floor((points - least[:, None]) / width[:, None] * (1 << BITS))
        return pd.Series(hilbert(np.clip(steps, 0, (1 << BITS) - 1), BITS))

    return rows.withColumn("key", place(*axes)).drop(*axes)


def with_starts(rows: DataFrame) -> tuple[DataFrame, int]:
    """uid and ``first`` (tokens of all rows before it, in the order of key, doc_id, ids_hash, uid) of every row of
    ``rows``, and the number of all tokens.

    Ranges of keys are sorted apart; a task adds up within its range. One row per range is added up in the end.
    """
    order = ["key", "doc_id", "ids_hash", "uid"]
    ordered = rows.select(*order, "n").repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            sizes = batch.column("n").to_numpy()
            ends = before + np.cumsum(sizes)
            columns = [
                batch.column("uid"), pa.array(np.full(len(sizes), part, dtype=np.int32)), pa.array(ends - sizes), batch.column("n"),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["uid", "part", "inside", "n"])
            before = int(ends[-1]) if len(ends) else before

    placed = settled(ordered.mapInArrow(run, "uid long, part int, inside long, n long"), "packing-places")
    parts = placed.groupBy("part").agg(F.sum("n").alias("size"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    starts = settled(parts.select("part", "size", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before")), "packing-starts")
    total = starts.agg(F.sum("size")).first()[0] or 0
    # as many rows as the sort had tasks
    first = placed.join(F.broadcast(starts.select("part", "before")), "part")
    return first.select("uid", (F.col("before") + F.col("inside")).alias("first")), total


# ---- pieces -------------------------------------------------------------------------------------------------------


def last_cuts(total: int, length: int) -> list[int]:
    """Where the stream's last sequences begin and end, after the last whole one: powers of two, falling."""
    cuts = [total // length * length]
    rest = total - cuts[0]
    for bit in range(rest.bit_length() - 1, -1, -1):
        if rest >> bit & 1:
            cuts.append(cuts[-1] + (1 << bit))
    return cuts


def cut_document(first: int, n: int, cuts: list[int], length: int) -> Iterator[tuple[int, int, int, int]]:
    """start, length, sequence_id and offset of each piece of a document whose tokens are ``first`` to ``first + n``."""
    at, end = first, first + n
    while at < min(end, cuts[0]):
        stop = min(end, (at // length + 1) * length)
        yield at - first, stop - at, at // length, at % length
        at = stop
    for nth, (begin, close) in enumerate(zip(cuts, cuts[1:])):
        if at < end and at < close:
            stop = min(end, close)
            yield at - first, stop - at, cuts[0] // length + nth, at - begin
            at = stop


def pack(docs: DataFrame, content: str, pattern: str, length: int = LENGTH, end: int = END) -> DataFrame:
    """The pieces of every row of ``docs`` (doc_id, text): doc_id, start, length, ids (little-endian 32-bit numbers),
    doc_tokens, sequence_id and offset. ``content`` is a tokenizer file, ``pattern`` how it cuts words.

    Sequences hold ``length`` tokens each; the last ones are powers of two.
    """
    rows = tokenized(docs, content, pattern, end)
    rows = settled(rows.withColumn("uid", F.monotonically_increasing_id()), "packing-tokens")
    slim = rows.withColumn("ids_hash", F.xxhash64("ids")).drop("ids")
    starts, total = with_starts(settled(with_key(slim), "packing-keys"))
    cuts = last_cuts(total, length)
    placed = rows.select("uid", "doc_id", "n", "ids").join(starts.hint("shuffle_hash"), "uid").select("doc_id", "n", "ids", "first")
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(doc_ids, pieces, blobs):
            numbers = [pa.array(column, pa.int64()) for column in zip(*pieces)]
            start, size, tokens, sequence, offset = numbers
            columns = [pa.array(doc_ids, kind), start, size, pa.array(blobs, pa.binary()), tokens, sequence, offset]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            kind = batch.column("doc_id").type
            doc_ids, pieces, blobs = [], [], []
            for doc_id, n, blob, first in zip(*map(pa.Array.to_pylist, batch.columns), strict=True):
                ids = unpacked(blob, n)
                for start, size, sequence, offset in cut_document(first, n, cuts, length):
                    doc_ids.append(doc_id)
                    pieces.append((start, size, n, sequence, offset))
                    blobs.append(ids[start : start + size].tobytes())
                    if len(pieces) == _ROWS:
                        yield made(doc_ids, pieces, blobs)
                        doc_ids, pieces, blobs = [], [], []
            if pieces:
                yield made(doc_ids, pieces, blobs)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return placed.mapInArrow(
        run, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    )


def digests(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ids_crc32 in place of ids."""
    return pieces.withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")
