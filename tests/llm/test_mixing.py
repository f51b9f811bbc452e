import numpy as np

from repolume.llm.mixing import dependent_rounding, mix_sources, round_in_pairs, take_copies, targets
from tests.conftest import rows


def filled(sizes, weights, most):
    """Water filling step by step."""
    total, capped = sum(sizes), set()
    while True:
        rest = total - sum(most * sizes[i] for i in capped)
        weight = sum(weights[i] for i in range(len(sizes)) if i not in capped)
        wanted = [most * size if i in capped else rest * weights[i] / weight for i, size in enumerate(sizes)]
        over = {i for i in range(len(sizes)) if i not in capped and wanted[i] > most * sizes[i] * (1 + 1e-12)}
        if not over:
            return wanted
        capped |= over


def test_targets_are_those_of_filling_step_by_step(spark):
    draw = np.random.default_rng(2)
    for _ in range(4):
        sizes = [int(x) for x in draw.integers(1, 1000, 9) ** 2]
        names = [f"s{i}" for i in range(8)] + [None]
        found = targets(spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long"))
        expected = filled(sizes, [1, 2, 3] * 3, 3)
        got = {row["source"]: row["target"] for row in found.collect()}
        assert all(abs(got[name] - want) <= 1e-6 * want for name, want in zip(names, expected, strict=True))


def test_pairs_keep_the_words_and_leave_one_fraction():
    draw = np.random.default_rng(4)
    for seed in range(50):
        sizes, fractions = draw.integers(1, 500, 60), draw.random(60)
        rounded, held = round_in_pairs(sizes, fractions, seed)
        assert abs((sizes * rounded).sum() - (sizes * fractions).sum()) < 1e-6
        loose = [i for i, x in enumerate(rounded) if x not in (0.0, 1.0)]
        assert loose in ([], [held])


def test_expectations_are_kept():
    sizes, fractions = np.array([5, 3, 9, 1]), np.array([0.2, 0.7, 0.5, 0.1])
    mean = np.mean([round_in_pairs(sizes, fractions, seed)[0] for seed in range(20_000)], axis=0)
    assert np.abs(mean - fractions).max() < 0.02


def test_a_tree_of_bundles_misses_by_less_than_one_document(spark):
    items = spark.range(5000).selectExpr(
        "cast(id AS string) AS doc_id", "cast(id % 3 AS int) AS source_rank", "1 + id * 7 % 100 AS size", "0.37D AS fraction"
    )
    done = dependent_rounding(items, bundle=50, fan_in=4)
    for row in done.groupBy("source_rank").agg({"size": "sum", "*": "count"}).collect():
        taken = done.where(f"source_rank = {row['source_rank']}").selectExpr("sum(size * extra)").first()[0]
        assert abs(taken - 0.37 * row["sum(size)"]) <= 100
    assert done.count() == 5000
    assert rows(done, "doc_id", "extra") == rows(dependent_rounding(items, bundle=50, fan_in=4), "doc_id", "extra")


def corpus(documents):
    texts = [(i, "word " * (1 + i % 50), "abc"[i % 3] if i % 7 else "big") for i in range(600)]
    return documents(*texts, (600, None, "a"), (601, "", None), (602, "w " * 5000, None), (None, "null id", "b"),
                     (7, "twice", "a"), (7, "twice", "a"))


def test_sources_come_near_their_targets(documents):
    docs = corpus(documents)
    found = mix_sources(docs).collect()
    assert len(found) == docs.count()
    by_source = {}
    for row in found:
        assert row["taken"] <= 3 * row["size"] and row["taken"] == row["size"] * row["copies"]
        entry = by_source.setdefault(row["source"], [0, 0, row["target"], 0])
        entry[0], entry[1], entry[3] = entry[0] + row["taken"], entry[1] + row["size"], max(entry[3], row["size"])
    for taken, size, target, largest in by_source.values():
        assert abs(taken - target) <= largest and target <= 3 * size + 1e-6
    assert rows(mix_sources(docs)) == rows(mix_sources(docs))


def test_the_mix_repeats_rows(documents):
    docs = corpus(documents)
    expected = {}
    for row in mix_sources(docs).collect():
        expected[row["doc_id"]] = expected.get(row["doc_id"], 0) + row["copies"]
    taken = take_copies(docs)
    assert taken.columns == docs.columns
    got = {}
    for row in taken.collect():
        got[row["doc_id"]] = got.get(row["doc_id"], 0) + 1
        assert row["copies"] == 7
    assert got == {doc: n for doc, n in expected.items() if n}


def test_which_of_equal_ids_is_taken_does_not_depend_on_the_order_of_rows(documents):
    texts = [(i % 40, f"{chr(97 + i % 26)} {i} word", "abc"[i % 40 % 3]) for i in range(240)]
    taken = [sorted(row["text"] for row in take_copies(documents(*order)).collect()) for order in (texts, texts[::-1])]
    assert taken[0] == taken[1]


def test_no_documents(documents):
    empty = documents((1, "a")).where("false")
    assert mix_sources(empty).count() == 0 and take_copies(empty).count() == 0
