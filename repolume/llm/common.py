"""What several operators share: normal form of their input, words, and frames that are cut from their lineage."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repolume.session import discard, settled

__all__ = ["discard", "settled"]

# White space of the word pattern [^\x20\x09-\x0D]+; ``bytes.split()`` cuts at the same six bytes.
WHITE = "\\x20\\x09-\\x0D"
# How the tokenizers cut words, and a pattern with the same matches for every text that takes fewer steps: what has been
# matched is not given back, letters are tried first, and white space at a text's end is passed once.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SAME = {_WORDS: r" ?\p{L}++|'(?:[sdmt]|ll|ve|re)| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"}
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z, and nothing else, in lower case.

    A text without multi-byte characters takes the built-in ``lower``, which is several times cheaper.
    """
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def count_words(text: Column) -> Column:
    """Number of words of a text; NULL has none."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{WHITE}]+"), "")).cast("long")


def quick(pattern: str) -> str:
    """A word pattern with the same matches that takes fewer steps, if one is known."""
    return _SAME.get(pattern, pattern)


def small(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows; beyond that the join shuffles. For settled frames
    of a few numbers a row."""
    return F.broadcast(df) if df.count() <= rows else df


def settled_in_batches(df: DataFrame, label: str, size: str = "4m") -> DataFrame:
    """``df`` settled, while Python gets about ``size`` of rows at once. For functions that look at one row at a time: a
    batch lies in memory several times, in the executor and in the worker, and by Spark's default takes up to 64 MB."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    before = conf.get(key)
    conf.set(key, size)
    try:
        return settled(df, label)
    finally:
        conf.set(key, before)


def hash_words(words: Sequence[bytes]) -> np.ndarray:
    """A 64-bit hash of each word, the same in every process."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finalizer of MurmurHash3)."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def hash_windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every run of ``width`` consecutive word hashes."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(count, dtype=np.uint64)
    for at in range(width):
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[at : at + count]
    return mix(total)


def texts_of(batch: pa.RecordBatch, column: str | int = "text") -> Iterator[str]:
    """The texts of a batch, NULL as empty, one at a time."""
    for value in batch.column(column):
        yield value.as_py() or ""


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in smaller ones, so that what is made of them is handed back piece by piece."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def learns(doc_id: Column, modulus: int, held: int) -> Column:
    """Whether a label may be learned from: crc32 of the id as text leaves another remainder than ``held``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus != held
