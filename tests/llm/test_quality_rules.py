import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from repolume.llm.quality_rules import (
    CUTOFFS, FOLDS, PATH, RULES, binomial_cdf, controlled, cutoffs, good_documents, judge, measure, repeated_words, steps_passed,
)


def test_repeated_words_are_those_of_all_windows():
    draw = random.Random(3)
    for _ in range(300):
        words = [draw.choice([b"a", b"b", b"c"]) for _ in range(draw.randint(0, 60))]
        runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        covered = {i + k for i, run in enumerate(runs) if runs.count(run) > 1 for k in range(5)}
        assert repeated_words(words) == len(covered)


def test_measures():
    text = "Ab c#\n\n \nAb c#\nAb c# \n|é<>\x1c\u00a0"
    n_words, chars, symbols, dup, repeat, lines, capitals = measure(text)
    assert (n_words, chars, symbols, dup, repeat, lines, capitals) == (7, 18, 6, 1, 0, 4, 3)
    assert measure("") == (0,) * 7
    assert measure("a " * 30_000)[:2] == (30_000, 30_000) and measure("a " * 30_000)[4] == 30_000


def test_binomial_bounds():
    exact = lambda k, n, p: sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    for k, n, p in ((0, 10, 0.3), (3, 50, 0.02), (7, 40, 0.1), (40, 40, 0.5)):
        assert abs(binomial_cdf(k, n, p) - exact(k, n, p)) < 1e-9
    assert abs(binomial_cdf(10_000, 500_000, 0.02) - 0.5) < 0.01 and binomial_cdf(0, 10**9, 0.02) == 0
    assert not controlled(0, 100, 0.005, 0.01) and controlled(0, 1000, 0.005, 0.01) and not controlled(4, 1000, 0.005, 0.01)


def corpus(documents, labels, n=3000):
    good = [(i, f"the quick brown fox number {i} jumps over a lazy dog again and again {i * 7}", "s", "en" if i % 2 else None) for i in range(n)]
    bad = [(n + i, " ".join(f"w{j}###" for j in range(i, i + 20)), "s", "en" if i % 2 else None) for i in range(50)]
    base = [(5000, None, "s", "en"), (5001, "", "s", "en"), (5002, "too few words", "s", "fr"), (5003, "a b c d e " * 20, "s", "en"),
            (5004, " ".join(f"w{j}###" for j in range(20)), "s", "fr"), (5005, "word " * 30 + " ".join(map(str, range(500))), "s", "en")]
    return documents(*good, *bad, *base, base[0]), labels(*[(i, 1, 0) for i in range(n)], *[(n + i, 0, 0) for i in range(25)])


def test_cutoffs_reject_little_of_the_good_and_catch_the_bad(documents, labels):
    docs, marks = corpus(documents, labels)
    found = {row["doc_id"]: row for row in judge(docs, marks).collect()}
    assert sum(not found[i]["kept"] for i in range(3000)) <= 0.02 * 3000
    assert all(not found[3000 + i]["kept"] and found[3000 + i]["broken_rule"] == "symbol_share" for i in range(50))
    assert [found[i]["base_failed"] for i in range(5000, 5006)] == [True, True, True, True, False, False]
    assert found[5004]["kept"], "a stratum without labels has no cutoffs"
    assert judge(docs, marks).count() == docs.count()


def test_without_enough_labels_only_the_base_rules_decide(documents, labels):
    docs, marks = corpus(documents, labels, 40)
    assert judge(docs, marks).where("kept = base_failed").count() == 0
    empty = judge(docs.where("false"), marks.where("false"))
    assert empty.count() == 0 and judge(docs, marks.where("false")).where(F.col("kept") == F.col("base_failed")).count() == 0


def test_a_rare_language_keeps_all_its_labels_in_a_large_corpus(spark):
    """450,000 good labels, of which 1,500 are of a language: its cutoffs come from all 1,500."""
    shared = spark.range(450_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 300 == 0, "is").otherwise("en").alias("lang"),
        F.lit(100).alias("n_words"), F.lit(0).alias("n_repeat_words"), *(F.lit(0.0).alias(rule) for rule in RULES),
    )
    good = good_documents(shared, shared.select("doc_id", F.lit(1).alias("quality")))
    assert good.where("lang = 'is'").count() == 1500 and good.count() == 450_000
    assert set(cutoffs(good)) == {"en", "is"}


def test_repeated_labels_and_rows_are_one_draw(documents, labels):
    """150 good documents are too few, however often their labels and rows are repeated."""
    docs, _ = corpus(documents, labels, 150)
    marks = labels(*[(i, 1, 0) for i in range(150)] * 20)
    assert judge(docs.unionByName(docs), marks).where("kept = base_failed").count() == 0


def test_false_rejection_stays_below_the_risk():
    """Paths whose true rates grow past the risk: a step beyond it is taken in at most the level's part of the draws."""
    draw = np.random.default_rng(5)
    risk, level, trials = 0.02, 0.05, 4000
    for n, rates in ((250, (0.0, 0.01, 0.021, 0.03)), (2000, (0.005, 0.015, 0.0205, 0.04)), (300, (0.0201, 0.05))):
        safe = sum(rate <= risk for rate in rates)
        beyond = 0
        for _ in range(trials):
            shares = draw.random(n)
            beyond += steps_passed([int((shares < rate).sum()) for rate in rates], n, risk, level) > safe
        assert beyond <= (level + 3 * math.sqrt(level * (1 - level) / trials)) * trials


def test_cutoffs_are_those_of_brute_force(spark):
    draw = random.Random(8)
    good = [(i, draw.choice(["a", "b", None]), *(draw.random() ** 6 if draw.random() < 0.03 else 0.0 for _ in RULES)) for i in range(3000)]
    design = [row for row in good if zlib.crc32(str(row[0]).encode()) % FOLDS == 0]
    path = []
    for part in PATH:
        fits = lambda at: [c for c in CUTOFFS if sum(row[2 + at] > c for row in design) <= part * len(design)]  # noqa: E731, B023
        path.append([min(fits(at)) for at in range(len(RULES))])
    expected = {}
    for lang in ("a", "b", None):
        held = [row for row in good if row[1] == lang and row not in design]
        for limits in path:
            rejected = sum(any(share > cut for share, cut in zip(row[2:], limits, strict=True)) for row in held)
            if not controlled(rejected, len(held), 0.02, 0.05 / 3):
                break
            expected[lang] = dict(zip(RULES, limits, strict=True))
    assert expected
    assert cutoffs(spark.createDataFrame(good, "doc_id long, lang string, " + ", ".join(f"{rule} double" for rule in RULES))) == expected
