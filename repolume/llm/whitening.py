"""Whitening of embeddings by components of their covariance, found by FEAST contour integration.

1. **Covariance, exactly.** Entries become whole numbers (``floor(scale * c) + offset``). One pass adds up every
   dimension; the next subtracts the whole number next to each mean and adds up products, as exact whole numbers that
   do not depend on the order of rows or tasks. From both the covariance of the fit list follows as an exact quotient.
2. **Slices.** Inertia counts (signs of the pivots of a shifted covariance; Sylvester's law) say how many eigenvalues lie
   above a number. By them the wanted end of the spectrum is cut into intervals of at most ``PER_INTERVAL`` eigenvalues
   whose edges lie in gaps.
3. **FEAST.** One Spark task per interval: complex shifted covariance solves at the Gauss-Legendre nodes of a circle through
   the interval's edges filter a random block to the interval's eigenvectors, Rayleigh-Ritz extracts them, and the result
   is filtered again until its residuals are at rounding level. The number of Ritz values inside must be the inertia
   count of the interval; otherwise the block grows, and what cannot be verified raises an error.
4. **Whitening.** A pass over the rows projects each centred row on the components, and a last aggregation measures the
   covariance of what came out.

The driver holds matrices of dimensions x dimensions, never rows.

Defined results: rows whose vector is NULL, empty or holds NULL, NaN, infinite entries, or entries beyond 2 ** 52 / scale
(whose whole number a double does not hold), are dropped; so are those whose length is not the commonest (of equally
common ones the largest). Rows without an id stay, and repeated rows count each. Components whose eigenvalue is zero at
rounding level have no whitened value and are left out, so a constant table or a single row gives no rows, and neither
does an empty one. A deviation that a long does not hold is NULL. Other columns are ignored, whatever they are called.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repolume.llm.common import settled

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
PER_INTERVAL = 8  # eigenvalues that one task extracts at once, if gaps allow
NODES = 8  # of the quadrature, on the half circle
_PASSES = 30  # filterings of one block
_BLOCK = 4096  # rows multiplied at once
_LIMIT = float(1 << 52)
_LONG = (1 << 63) - 1


# ---- exact sums ---------------------------------------------------------------------------------------------------


def whole_rows(embeddings: DataFrame, vector: str, id_column: str, scale: float) -> DataFrame:
    """id and x (array<long>, without the offset) of the rows that can be used."""
    entries = F.transform(F.col(vector), lambda c: F.lit(float(scale)) * c.cast("double"))
    rows = embeddings.select(F.col(id_column).alias("id"), entries.alias("c")).where("size(c) > 0")
    # NULL and NaN are not below the limit
    usable = rows.where(F.forall("c", lambda c: F.coalesce(F.abs(c) < _LIMIT, F.lit(False))))
    rows = settled(usable.select("id", F.transform("c", lambda c: F.floor(c).cast("long")).alias("x")), "whitening-rows")
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    commonest = lengths.agg(F.max(F.struct("n", "d"))["d"]).first()[0]  # one number
    return rows.where(F.size("x") == F.lit(commonest))


def _matrix(column: pa.Array) -> np.ndarray:
    """The rows of a list column of equally long lists."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def sums(rows: DataFrame) -> tuple[int, list[int]]:
    """The number of rows, and the sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = 0, None
        for batch in batches:
            for at in range(0, len(batch), _BLOCK):
                x = _matrix(batch.column("x").slice(at, _BLOCK))
                part = (x if int(np.abs(x).max()) * len(x) <= _LONG else x.astype(object)).sum(axis=0).astype(object)
                total = part if total is None else total + part
                count += len(x)
        if count:
            values = [Decimal(int(value)) for value in total]
            columns = [pa.array([count], pa.int64()), pa.array([values], pa.list_(pa.decimal128(38, 0)))]
            yield pa.RecordBatch.from_arrays(columns, names=["n", "s"])

    parts = rows.select("x").mapInArrow(run, "n long, s array<decimal(38,0)>")
    each = parts.select("n", F.posexplode("s").alias("at", "s")).groupBy("at").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    found = each.orderBy("at").collect()  # a row per dimension
    return (found[0]["n"], [int(row["s"]) for row in found]) if found else (0, [])


def products(rows: DataFrame, centre: list[int]) -> np.ndarray:
    """The sum over the rows of (x - centre)(x - centre)^T, as whole numbers (dtype object)."""
    origin, size = np.array(centre, dtype=np.int64), len(centre)
    upper = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size), dtype=object)
        for batch in batches:
            for at in range(0, len(batch), _BLOCK):
                y = _matrix(batch.column("x").slice(at, _BLOCK)) - origin
                most = int(np.abs(y).max())
                if most * most * len(y) < 1 << 53:  # then sums of products are exact in doubles
                    total += (y.T.astype(float) @ y.astype(float)).astype(np.int64).astype(object)
                else:
                    total += y.T.astype(object) @ y.astype(object)
        columns = [pa.array(upper[0].astype(np.int32)), pa.array(upper[1].astype(np.int32))]
        values = pa.array([Decimal(int(value)) for value in total[upper]], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([*columns, values], names=["i", "j", "p"])

    parts = rows.select("x").mapInArrow(run, "i int, j int, p decimal(38,0)")
    found = parts.groupBy("i", "j").agg(F.sum("p").alias("p")).toLocalIterator()
    result = np.zeros((size, size), dtype=object)
    for row in found:
        result[row["i"], row["j"]] = result[row["j"], row["i"]] = int(row["p"])
    return result


def covariance(rows: DataFrame) -> tuple[int, list[int], np.ndarray]:
    """The number of rows, the sum of each dimension, and the covariance with the divisor n, rounded once."""
    n, total = sums(rows)
    if not n:
        return 0, [], np.zeros((0, 0))
    centre = [round(s / n) if abs(s) < 1 << 53 else s // n for s in total]
    moved = [s - n * c for s, c in zip(total, centre)]
    exact = n * products(rows, centre) - np.outer(np.array(moved, dtype=object), np.array(moved, dtype=object))
    # the quotient of whole numbers is rounded correctly
    return n, total, np.array([[int(value) / (n * n) for value in line] for line in exact])


# ---- eigenvectors -------------------------------------------------------------------------------------------------


def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix are larger than ``shift``: the positive pivots of the shifted matrix,
    eliminated with pivots of one or two rows (Bunch and Parlett), by Sylvester's law of inertia."""
    a = matrix - shift * np.eye(len(matrix))
    positive = 0
    while len(a):
        size = np.abs(a)
        on, off = np.diagonal(size), np.triu(size, 1)
        r = int(on.argmax())
        i, j = divmod(int(off.argmax()), len(a))
        if on[r] == 0 and off[i, j] == 0:
            break
        if on[r] >= 0.6404 * off[i, j]:  # (1 + sqrt(17)) / 8 bounds the growth
            order = [r]
            positive += bool(a[r, r] > 0)
        else:
            order = [i, j]
            positive += 1  # a pivot of two rows that is chosen so has one eigenvalue of each sign
        rest = np.delete(np.arange(len(a)), order)
        cross = a[np.ix_(order, rest)]
        a = a[np.ix_(rest, rest)] - cross.T @ np.linalg.solve(a[np.ix_(order, order)], cross)
    return positive


def gap_near(matrix: np.ndarray, low: float, high: float) -> tuple[float, int]:
    """A number in the middle part of (low, high) as far from eigenvalues as a few trials show, and how many lie above."""
    width = high - low
    for margin in (0.1, 0.03, 0.01, 1e-3, 1e-4, 1e-6):
        for part in (0.5, 0.4, 0.6, 0.3, 0.7):
            at = low + part * width
            count = above(matrix, at)
            if above(matrix, at - margin * width) == count == above(matrix, at + margin * width):
                return at, count
    return low + 0.5 * width, above(matrix, low + 0.5 * width)


def slices(matrix: np.ndarray, wanted: int, per_interval: int = PER_INTERVAL) -> list[tuple[float, float, int]]:
    """Intervals (low, high, eigenvalues inside), disjoint, which hold the ``wanted`` largest eigenvalues at least."""
    scale = float(np.abs(matrix).sum(axis=1).max())
    found, floor = [], scale * 1e-12
    # low, high, how many lie above each
    waiting = [(floor, 1.01 * scale, above(matrix, floor), 0)] if scale > 0 else []
    while waiting:
        low, high, above_low, above_high = waiting.pop()
        count = above_low - above_high
        if not count or above_high >= wanted:
            continue
        if count <= per_interval and above_low <= wanted + per_interval or high - low <= 1e-10 * scale:
            found.append((low, high, count))
            continue
        middle, count_middle = gap_near(matrix, low, high)
        waiting += [(low, middle, above_low, count_middle), (middle, high, count_middle, above_high)]
    return found


def feast(
    matrix: np.ndarray, low: float, high: float, count: int, seed: int = 0, nodes: int = NODES
) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues in (low, high), falling, and their eigenvectors as columns."""
    size = len(matrix)
    scale = np.abs(matrix).sum(axis=1).max()
    points, weights = np.polynomial.legendre.leggauss(nodes)
    angles = -0.5 * np.pi * (points - 1)
    centre, radius = 0.5 * (low + high), 0.5 * (high - low)
    draw = np.random.default_rng(seed)
    for width in (min(size, 2 * count + 4), min(size, 4 * count + 8), size):
        block = draw.standard_normal((size, width))
        for _ in range(_PASSES):
            filtered = np.zeros_like(block)
            for angle, weight in zip(angles, weights):
                turn = radius * np.exp(1j * angle)
                solved = np.linalg.solve((centre + turn) * np.eye(size) - matrix, block.astype(complex))
                filtered += 0.5 * weight * (turn * solved).real
            basis, strength, _ = np.linalg.svd(filtered, full_matrices=False)
            basis = basis[:, strength > strength[0] * 1e-14]
            values, turned = np.linalg.eigh(basis.T @ matrix @ basis)
            vectors = basis @ turned
            inside = (values > low) & (values < high)
            residual = np.linalg.norm(matrix @ vectors[:, inside] - vectors[:, inside] * values[inside], axis=0)
            if inside.sum() == count and residual.max(initial=0.0) <= 1e-14 * size * scale:
                order = np.argsort(-values[inside])
                return values[inside][order], vectors[:, inside][:, order]
            block = vectors
    raise ArithmeticError(f"{count} eigenvalues lie between {low} and {high}, but they could not be extracted")


def components(spark, matrix: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest positive eigenvalues (or all, if fewer), falling, and unit eigenvectors as columns, each
    with its largest entry positive. Intervals are solved side by side."""
    parts = slices(matrix, wanted)
    if not parts:
        return np.empty(0), np.empty((len(matrix), 0))
    shared = spark.sparkContext.broadcast(matrix)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                values, vectors = feast(shared.value, row.low, row.high, int(row.n), int(row.part))
                yield pd.DataFrame({"value": values, "vector": list(vectors.T)})

    plan = [(at, low, high, n) for at, (low, high, n) in enumerate(parts)]
    intervals = spark.createDataFrame(plan, "part int, low double, high double, n int").repartition(len(parts), "part")
    found = intervals.mapInPandas(solve, "value double, vector array<double>").collect()
    found = sorted(found, key=lambda row: -row["value"])[:wanted]
    vectors = np.array([row["vector"] for row in found]).T
    # eigenvectors of different intervals are orthogonal but for rounding; one step of QR takes that out
    vectors = np.linalg.qr(vectors)[0]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return np.array([row["value"] for row in found]), vectors * signs


# ---- rows ---------------------------------------------------------------------------------------------------------


def whiten(
    embeddings: DataFrame, wanted: int = COMPONENTS, scale: float = SCALE, offset: int = OFFSET,
    vector: str = "embedding", id_column: str = "vec_id",
) -> DataFrame:
    """One row per usable row of ``embeddings``: vec_id, n, deviation, whitened, explained (two arrays, an entry per
    component) and identity_error.

    ``offset`` moves every entry alike, so it changes none of these columns: it is not carried through the sums.
    """
    spark = embeddings.sparkSession
    rows = whole_rows(embeddings, vector, id_column, scale)
    n, total, matrix = covariance(rows)
    values, vectors = components(spark, matrix, wanted) if n else (np.empty(0), np.empty((0, 0)))
    kind = embeddings.schema[id_column].dataType.simpleString()
    if not len(values):
        empty = "n long, deviation long, whitened array<double>, explained array<double>, identity_error double"
        return spark.createDataFrame([], f"{id_column} {kind}, {empty}")
    trace = math.fsum(np.diagonal(matrix))
    centre = [s // n for s in total]
    moved = [s - n * c for s, c in zip(total, centre)]  # n times the rest of the mean
    shared = spark.sparkContext.broadcast((np.array(centre, dtype=np.int64), moved, vectors / np.sqrt(values)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        origin, rest, basis = shared.value
        mean, exact = np.array([m / n for m in rest]), np.array(rest, dtype=object)
        for batch in batches:
            for at in range(0, len(batch), _BLOCK):
                part = batch.slice(at, _BLOCK)
                y = _matrix(part.column("x")) - origin
                if (n * (int(np.abs(y).max(initial=0)) + 1)) ** 2 * len(rest) <= _LONG:
                    deviations = ((n * y - exact.astype(np.int64)) ** 2).sum(axis=1).tolist()
                else:
                    each = ((n * y.astype(object) - exact) ** 2).sum(axis=1)
                    deviations = [int(value) if value <= _LONG else None for value in each]
                projected = (y - mean) @ basis
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, projected.size + 1, projected.shape[1], dtype=np.int32)), pa.array(projected.reshape(-1))
                )
                columns = [part.column("id"), pa.array(deviations, pa.int64()), lists]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "deviation", "whitened"])

    done = settled(rows.mapInArrow(run, f"id {kind}, deviation long, whitened array<double>"), "whitening-done")
    return done.select(
        F.col("id").alias(id_column), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.array(*(F.lit(float(value) / trace) for value in values)).alias("explained"),
        F.lit(identity_error(done, len(values))).alias("identity_error"),
    )


def identity_error(done: DataFrame, size: int) -> float:
    """The largest absolute entry of the covariance of ``whitened``, measured over all rows, minus the identity.

    The rows are centred already; what rounding has left of their mean is taken off the products.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total, square = 0, np.zeros(size), np.zeros((size, size))
        for batch in batches:
            if len(batch):
                rows = _matrix(batch.column("whitened"))
                count, total, square = count + len(rows), total + rows.sum(axis=0), square + rows.T @ rows
        lines = [total, *square]
        columns = [pa.array([count] * (size + 1), pa.int64()), pa.array(range(-1, size), pa.int32()), pa.array(lines)]
        yield pa.RecordBatch.from_arrays(columns, names=["n", "line", "sums"])

    parts = done.select("whitened").mapInArrow(run, "n long, line int, sums array<double>")
    each = parts.select("n", "line", F.posexplode("sums").alias("at", "s"))
    found = each.groupBy("line", "at").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).toLocalIterator()
    grid = np.zeros((size + 1, size))
    for row in found:
        grid[row["line"] + 1, row["at"]] = row["s"] / row["n"]
    return float(np.abs(grid[1:] - np.outer(grid[0], grid[0]) - np.eye(size)).max())


def by_component(whitened: DataFrame, id_column: str = "vec_id") -> DataFrame:
    """A row for each row of ``whitened`` and each component, numbered from 1."""
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "entry")
    rows = whitened.select(id_column, "n", "deviation", "identity_error", each)
    return rows.select(
        id_column, (F.col("at") + 1).alias("component"), "n", "deviation", F.col("entry.whitened").alias("whitened"),
        F.col("entry.explained").alias("explained"), "identity_error",
    )
