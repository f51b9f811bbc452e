"""Order-dependent picks that stay distributed when one group holds most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows of one key range of a numbered table; the number of ranges follows from the number of rows.
ROWS_PER_RANGE = 1_000_000
# Into so many ranges one range is cut at most; more of them are cut in several levels.
FAN = 1024
# Sampled keys per range; more of them make the ranges more even.
_SAMPLES = 16


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key in ``order``.

    The ``= 1`` filter lets Spark trim each key to one row per input task before the shuffle, so a key that
    holds a third of the table sends one row per task and not the whole group.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], limit: int) -> DataFrame:
    """The first ``limit`` rows of each key in ``order``, trimmed per task like ``first_per_key``."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= limit).drop("_rank")


def _cut_points(df: DataFrame, key: Column, parts: int, share: float) -> DataFrame:
    """``_outer`` and ``_cuts`` of each value of ``_range``: its sorted cut points, at most ``parts - 1``.

    ``share`` of the keys are sampled, those with the smallest hashes, so a recomputed task finds the same cut points.
    """
    draw = F.shiftrightunsigned(F.xxhash64("_key"), 11) / F.lit(float(1 << 53))
    sample = df.select("_range", key.alias("_key")).where(draw < share).groupBy(F.col("_range").alias("_outer"))
    sample = sample.agg(F.sort_array(F.collect_set("_key")).alias("_keys"))
    step = F.greatest(F.ceil(F.size("_keys") / parts), F.lit(1))
    cuts = F.filter("_keys", lambda _, i: i % step == step - 1)
    return sample.select("_outer", F.slice(cuts, 1, parts - 1).alias("_cuts"))


def _levels(ranges: int) -> list[int]:
    """Into how many parts each level of the cut divides the ranges of the level before."""
    levels = []
    while ranges > 1:
        levels.append(min(ranges, FAN))
        ranges = -(-ranges // FAN)
    return levels


def _in_ranges(df: DataFrame, key: Column, ranges: int, rows: int) -> DataFrame:
    """Add ``_range``, a number that ascends with the key, for about ``ranges`` ranges of rows.

    Ranges are cut into ranges, level by level, so that no list of cut points, and no sample it is taken from, is
    longer than ``FAN`` ranges need, however many rows there are. The first list is one row; the lists of the further
    levels are a table with a row per range, joined by the range.

    Within a list, the number of cut points up to the key is found by a binary search, one projection per step. Past the
    last cut point ``get`` is NULL, which compares like a cut point beyond every key.
    """
    found, reached = df.withColumn("_range", F.lit(0).cast("long")), 1
    for parts in _levels(ranges):
        reached *= parts
        cuts = _cut_points(found, key, parts, min(reached, ranges) * _SAMPLES / max(rows, 1))
        if reached == parts:  # a single row
            cuts = F.broadcast(cuts)
        found = found.join(cuts, found["_range"] == cuts["_outer"], "left").withColumns({"_key": key, "_part": F.lit(0)})
        for step in range((parts - 1).bit_length() - 1, -1, -1):
            cut = F.get("_cuts", F.col("_part") + ((1 << step) - 1))
            found = found.withColumn("_part", F.col("_part") + F.when(cut <= F.col("_key"), 1 << step).otherwise(0))
        found = found.withColumn("_range", F.col("_range") * parts + F.col("_part")).drop("_outer", "_cuts", "_key", "_part")
    return found


def _numbered(
    df: DataFrame, order: Sequence[str], within: Sequence[str], ascending: bool, per_range: int, name: str,
    span: tuple[int, int] | None = None,
) -> DataFrame:
    within, order = list(within), list(order)
    columns = [*within, *order]
    key = F.struct(*columns) if len(columns) > 1 else F.col(columns[0])
    rows = df.count()
    ranges = max(1, -(-rows // per_range))
    sort = [F.col(column).asc() if ascending else F.col(column).desc() for column in ["_range", *order]]

    def ranked(frame: DataFrame, inside: list[str]) -> DataFrame:
        frame = frame.withColumn("_rank", F.row_number().over(Window.partitionBy(*inside).orderBy(*sort[1:])))
        # compared with the rank itself, the end of the span lets Spark trim each group before the shuffle
        return frame if span is None else frame.where(F.col("_rank") <= F.lit(min(span[1], (1 << 31) - 1)))

    if ranges == 1:
        return ranked(df, within).withColumn(name, (F.col("_rank") - 1).cast("long")).select(*df.columns, name)
    cut = _in_ranges(df, key, ranges, rows)
    earlier = Window.partitionBy(*within).orderBy(sort[0]).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(*within, "_range")
        .agg(F.count("*").alias("_rows"))
        .withColumn("_offset", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    )
    if span is not None:
        # ranges outside the wanted positions are dropped before their rows are shuffled
        offsets = offsets.where((F.col("_offset") < span[1]) & (F.col("_offset") + F.col("_rows") > span[0]))
    offsets = offsets.select(*[F.col(column).alias(f"_w_{column}") for column in within], F.col("_range").alias("_b"), "_offset")
    same = [cut[column].eqNullSafe(offsets[f"_w_{column}"]) for column in within]
    placed = ranked(cut.join(offsets, [*same, cut["_range"] == offsets["_b"]]), [*within, "_range"])
    return placed.withColumn(name, F.col("_rank") - 1 + F.col("_offset")).select(*df.columns, name)


def with_position(
    df: DataFrame, order: Sequence[str], within: Sequence[str] = (), name: str = "position", ascending: bool = True,
    per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add the zero-based position of each row in ``order`` (unique per row) inside ``within``.

    A plain ``row_number`` would pull a whole group into one task. Here the rows are counted (one job, when the
    plan is built) and cut into key ranges of about ``per_range`` rows, however many that gives; each range is
    numbered on its own, and the row counts of the earlier ranges are added. A group that holds most of the rows
    spans many ranges. ``df`` is read several times (once more for each level of the cut), so it should lie in storage.
    """
    return _numbered(df, order, within, ascending, per_range, name)


def slice_by_position(
    df: DataFrame, order: Sequence[str], offset: int, limit: int, within: Sequence[str] = (), ascending: bool = True,
    per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Rows at positions ``offset .. offset + limit - 1``, however many that are, without a single big task.

    Only the key ranges that reach into the slice are shuffled and numbered; of each group no task sends more than the
    first ``offset + limit`` rows of a range.
    """
    span = (offset, offset + limit)
    numbered = _numbered(df, order, within, ascending, per_range, "_position", span)
    return numbered.where((F.col("_position") >= span[0]) & (F.col("_position") < span[1])).drop("_position")
