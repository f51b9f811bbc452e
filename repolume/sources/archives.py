"""CI log archives: zip payloads to rows.

The only place where Python touches data: unzipping has no built-in expression. Spark reads and distributes
the payloads; each task unpacks one archive at a time and hands its lines back in batches of bounded size.
"""

from __future__ import annotations

import io
import sys
import zipfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# the functions below travel to the executors by value: the package need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS_PER_BATCH = 20_000
BYTES_PER_BATCH = 4 << 20


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``run_id, payload`` of the files ``<run_id>.<ext>`` below ``path``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    run_id = F.regexp_extract("path", r"([0-9]+)[^/]*$", 1).cast("long")
    return files.select(run_id.alias("run_id"), F.col("content").alias("payload"))


def _open(payload: bytes | None) -> zipfile.ZipFile | None:
    try:
        return zipfile.ZipFile(io.BytesIO(payload or b""))
    except zipfile.BadZipFile:
        return None


def batched(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as batches of at most ``ROWS_PER_BATCH`` rows, which are ended by the row that brings their texts and bytes to
    ``BYTES_PER_BATCH``; nothing else is held in memory."""
    chunk, held = [], 0

    def made() -> pa.RecordBatch:
        columns = [pa.array(column, field.type) for column, field in zip(zip(*chunk), schema)]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    for row in rows:
        chunk.append(row)
        held += sum(len(value) for value in row if isinstance(value, (str, bytes)))
        if len(chunk) == ROWS_PER_BATCH or held >= BYTES_PER_BATCH:
            yield made()
            chunk, held = [], 0
    if chunk:
        yield made()


def _payloads(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, zipfile.ZipFile | None]]:
    for batch in batches:
        # one value at a time: a batch of archives is never held as Python objects
        for run_id, payload in zip(batch.column("run_id"), batch.column("payload")):
            yield run_id.as_py(), _open(payload.as_py())


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for run_id, archive in _payloads(batches):
            names = [] if archive is None else archive.namelist()
            for name in names or [None]:
                yield run_id, name, archive is not None

    return batched(rows(), pa.schema({"run_id": pa.int64(), "member": pa.string(), "is_archive": pa.bool_()}))


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for run_id, archive in _payloads(batches):
            for member in [] if archive is None else archive.infolist():
                if member.is_dir():
                    continue
                with archive.open(member) as stream:
                    text = io.TextIOWrapper(stream, encoding="utf-8", errors="replace", newline="\n")
                    for number, line in enumerate(text, start=1):
                        yield run_id, member.filename, number, line.removesuffix("\n")

    return batched(
        rows(), pa.schema({"run_id": pa.int64(), "member": pa.string(), "line_no": pa.int64(), "text": pa.string()})
    )


def archive_members(archives: DataFrame) -> DataFrame:
    """One row per member of each archive: ``run_id, member, is_archive``.

    An empty archive, and a payload that is no archive, give one row with a NULL member.
    """
    return archives.select("run_id", "payload").mapInArrow(
        _members, "run_id long, member string, is_archive boolean"
    )


def archive_lines(archives: DataFrame) -> DataFrame:
    """Every line of every member: ``run_id, member, line_no, text``."""
    return archives.select("run_id", "payload").mapInArrow(
        _lines, "run_id long, member string, line_no long, text string"
    )


def count_members(archives: DataFrame) -> DataFrame:
    """Members per run; NULL where the payload is no archive, 0 for an empty archive."""
    counts = archive_members(archives).groupBy("run_id").agg(
        F.count("member").alias("_n"), F.bool_or("is_archive").alias("_ok")
    )
    return counts.select("run_id", F.when(F.col("_ok"), F.col("_n")).alias("members"))
