import math
from fractions import Fraction

import numpy as np
import pytest

from repolume.llm.queries import QUERIES
from repolume.llm.whitening import above, by_component, components, covariance, feast, slices, whiten, whole_rows

SCHEMA = "vec_id long, embedding array<float>, label int, id int, x int, n int, deviation int"


@pytest.fixture
def embeddings(spark):
    return lambda *rows: spark.createDataFrame([(vec_id, vector, 0, 1, 2, 3, 4) for vec_id, vector in rows], SCHEMA)


def whole(vectors):
    return [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in vector] for vector in vectors]


def exact_covariance(x):
    n, size = len(x), len(x[0])
    means = [Fraction(sum(row[i] for row in x), n) for i in range(size)]
    return np.array(
        [[float(sum((row[i] - means[i]) * (row[j] - means[j]) for row in x) / n) for j in range(size)] for i in range(size)]
    )


def check(found, vectors, most=32):
    """``found`` (rows by component) against eigenvectors by another library and exact sums."""
    x = whole([vector for _, vector in vectors])
    n, size = len(x), len(x[0])
    totals = [sum(row[i] for row in x) for i in range(size)]
    matrix = exact_covariance(x) if n <= 50 else np.cov((np.array(x) - 1_000_000).astype(float).T, bias=True)
    values, basis = np.linalg.eigh(matrix)
    values, basis = values[::-1], basis[:, ::-1]
    rank = int((values > values[0] * 1e-12).sum())
    kept = min(most, rank)
    by_id = {vec_id: row for (vec_id, _), row in zip(vectors, x)}
    assert len(found) == n * kept
    centred = {i: [Fraction(c) - Fraction(t, n) for c, t in zip(row, totals)] for i, row in by_id.items()}
    whitened = np.zeros((n, kept))
    for row in found:
        own = by_id[row["vec_id"]]
        assert row["n"] == n
        assert row["deviation"] == sum((n * c - t) ** 2 for c, t in zip(own, totals))
        at = row["component"] - 1
        assert row["explained"] == pytest.approx(values[at] / np.trace(matrix), rel=1e-9)
        assert row["identity_error"] <= 1e-9
        expected = float(np.array([float(c) for c in centred[row["vec_id"]]]) @ basis[:, at]) / values[at] ** 0.5
        others = np.abs(np.delete(values[:rank], at) - values[at])
        if len(others) == 0 or others.min() > 1e-6 * values[0]:
            assert abs(row["whitened"]) == pytest.approx(abs(expected), abs=1e-6)
        whitened[list(by_id).index(row["vec_id"]), at] = row["whitened"]
    assert len({row["identity_error"] for row in found}) == 1
    assert np.abs(np.cov(whitened.T, bias=True).reshape(kept, kept) - np.eye(kept)).max() < 1e-9


def test_whole_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    found = QUERIES["op12_whitening"](spark, "/root/testdata/sf0.01").collect()
    check(found, [(row["vec_id"], row["embedding"]) for row in rows])


def test_small_table(embeddings):
    draw = np.random.default_rng(3)
    rows = [(at, (draw.standard_normal(5) * [9, 5, 3, 1, 0.5]).tolist()) for at in range(40)]
    check(by_component(whiten(embeddings(*rows))).collect(), rows)


def test_unusable_rows_are_dropped(embeddings):
    draw = np.random.default_rng(4)
    rows = [(at, draw.standard_normal(3).tolist()) for at in range(20)]
    odd = [None, [], [None, 1.0, 2.0], [float("nan"), 1.0, 2.0], [float("inf"), 0.0, 0.0], [1e30, 0.0, 0.0], [1.0], [1.0] * 4]
    found = by_component(whiten(embeddings(*rows, *enumerate(odd, 100)))).collect()
    check(found, rows)


def test_ids_that_are_missing_or_repeated_stay(embeddings):
    draw = np.random.default_rng(5)
    rows = [(None if at % 2 else 7, draw.standard_normal(3).tolist()) for at in range(12)]
    found = whiten(embeddings(*rows)).collect()
    assert [row["vec_id"] for row in found].count(None) == 6 and len(found) == 12


def test_flat_dimensions_have_no_component(embeddings):
    draw = np.random.default_rng(6)
    rows = [(at, [*draw.standard_normal(2).tolist(), 5.0, 5.0]) for at in range(30)]
    check(by_component(whiten(embeddings(*rows))).collect(), rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_tables_without_spread_give_no_rows(embeddings, rows):
    found = by_component(whiten(embeddings(*rows)))
    assert found.collect() == []
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_large_entries_are_summed_exactly(embeddings):
    draw = np.random.default_rng(7)
    rows = [(at, (draw.standard_normal(3) * 1e9).tolist()) for at in range(50)]
    n, totals, matrix = covariance(whole_rows(embeddings(*rows), "embedding", "vec_id", 64))
    x = [[c - 1_000_000 for c in row] for row in whole([vector for _, vector in rows])]
    assert (n, totals) == (50, [sum(row[i] for row in x) for i in range(3)])
    assert (matrix == exact_covariance(x)).all()
    assert all(row["deviation"] is None or row["deviation"] >= 0 for row in whiten(embeddings(*rows)).collect())


def test_inertia_counts():
    draw = np.random.default_rng(8)
    for size in (1, 2, 5, 30):
        half = draw.standard_normal((size, size))
        matrix = half + half.T
        values = np.linalg.eigvalsh(matrix)
        for shift in (*(values[:-1] + values[1:]) / 2, values[0] - 1, values[-1] + 1, 0.0):
            assert above(matrix, shift) == (values > shift).sum()


@pytest.mark.parametrize("repeated", [1, 3, 12])
def test_components_of_equal_eigenvalues(spark, repeated):
    draw = np.random.default_rng(9)
    turned = np.linalg.qr(draw.standard_normal((40, 40)))[0]
    values = np.sort(np.repeat(draw.random(40), repeated)[:40] + 0.5)[::-1]
    matrix = turned @ np.diag(values) @ turned.T
    matrix = (matrix + matrix.T) / 2
    found, vectors = components(spark, matrix, 20)
    assert found == pytest.approx(values[:20], rel=1e-12)
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-12
    assert np.abs(vectors.T @ vectors - np.eye(20)).max() < 1e-12


def test_slices_hold_the_wanted_end():
    values = np.r_[np.full(10, 2.0), np.linspace(0.1, 1, 50)]
    parts = slices(np.diag(values), 25)
    assert sum(n for *_, n in parts) >= 25
    for low, high, n in parts:
        assert n == ((values > low) & (values <= high)).sum()
    top = min(low for low, *_ in parts)
    assert (values > top).sum() == sum(n for *_, n in parts)


def test_what_cannot_be_verified_raises():
    with pytest.raises(ArithmeticError):
        feast(np.diag([1.0, 2.0, 3.0]), 0.5, 2.5, 3)
