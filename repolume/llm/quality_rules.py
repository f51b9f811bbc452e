"""Quality rules with risk-controlled cutoffs.

``measures`` counts words, symbols, repeated lines and repeated five-word windows of whole texts. Fixed base rules
fail texts of fewer than ten words and texts in which more than a fifth of the words are repeated windows.

On top of them, a share of symbols, repeated lines, repeated words or capitals above a cutoff rejects a document. All
four cutoffs move together along one path of steps, from lenient to strict: step by step, a rule may reject a larger
part (``PATH``) of a fifth of the good labelled documents, the design fold, of all strata together. The other four
fifths, the holdouts, decide stratum by stratum (the language) how far the path is followed: each step asks whether the
chance to reject a good document is below the tolerated risk, by the exact binomial (Clopper-Pearson) bound; the last
step before the first failed test is used. Along the path the level need not be divided, as testing stops at the first
failure (fixed sequence) and the path does not depend on the holdouts; it is divided by the number of strata tested
(Bonferroni). So with probability ``1 - alpha`` over the holdouts, the cutoffs reject, in every stratum, at most
``risk`` of the good documents that pass the base rules. A stratum with too few labels for such a guarantee (217 at the
defaults and four strata) gets no cutoffs, and only the base rules apply to it.

Defined results: a NULL or empty text has no words and fails the base rules; a NULL language is a stratum of its own;
repeated rows give repeated rows, but a labelled id is one draw however often its label or document is repeated (of
different documents the largest in language and shares); an id with contradicting labels counts as good; labels of a
NULL id are not used; no documents give no rows; without labels only the base rules decide. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import takewhile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repolume.llm.common import settled, texts_of

WINDOW = 5
SYMBOLS = "#*$%&|<>"
_WHITE = " \t\n\x0b\x0c\r"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")
RULES = ("symbol_share", "dup_line_share", "repeat_share", "capital_share")
# Candidate cutoffs of a share, strict first; no cutoff is stricter than the first.
CUTOFFS = tuple(round(0.1 + 0.025 * step, 3) for step in range(37))
# The part of the design fold that each rule may reject at each step.
PATH = (0.0, 0.001, 0.002, 0.003, 0.005, 0.0075, 0.01, 0.015, 0.02)
FOLDS = 5  # one of them is the design fold
RISK, ALPHA = 0.02, 0.05


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words that lie in a window of ``width`` words which the text has twice or more."""
    count = len(words) - width + 1
    if count < 2:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(word, len(known)) for word in words), dtype=np.int64, count=len(words))
    names = ids[:count]
    for at in range(1, width):  # name each longer run by its first part's name and its last word
        names = np.unique(names * len(known) + ids[at : at + count], return_inverse=True)[1]
    again = np.bincount(names)[names] > 1
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    covered[:count] += again
    covered[width : width + count] -= again
    return int(np.count_nonzero(np.cumsum(covered[:-1])))


def measure(text: str) -> tuple[int, ...]:
    """The ``MEASURES`` of one text."""
    words = text.encode("utf-8", "surrogatepass").split()
    lines = [line for line in text.split("\n") if line.strip(_WHITE)]
    return (
        len(words),
        len(text) - sum(map(text.count, _WHITE)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        sum(1 for char in text if char.isupper()) if not text.islower() else 0,
    )


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang and the ``MEASURES`` of every text of ``docs`` (doc_id, lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([measure(text) for text in texts_of(batch)], dtype=np.int64).reshape(-1, len(MEASURES))
            columns = [batch.column("doc_id"), batch.column("lang"), *(pa.array(column) for column in found.T)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang", *MEASURES])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, lang string, " + ", ".join(f"{name} long" for name in MEASURES)
    return docs.select("doc_id", "lang", "text").mapInArrow(run, schema)


def shares(measured: DataFrame) -> DataFrame:
    """``measured`` with the share each rule looks at, from 0."""
    at_least_one = lambda name: F.greatest(F.col(name), F.lit(1))
    return measured.withColumns(
        {
            "symbol_share": F.col("n_symbols") / at_least_one("word_chars"),
            "dup_line_share": F.col("n_dup_lines") / at_least_one("n_lines"),
            "repeat_share": F.col("n_repeat_words") / at_least_one("n_words"),
            "capital_share": F.col("n_capitals") / at_least_one("word_chars"),
        }
    )


def _beta_fraction(a: float, b: float, x: float) -> float:
    """The continued fraction of the incomplete beta function, by Lentz's method; takes about sqrt(max(a, b)) steps."""
    tiny = 1e-300
    c, d = 1.0, 1.0 / max(1.0 - (a + b) * x / (a + 1.0), tiny)
    value, m = d, 0
    while True:
        m += 1
        for term in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 / (1.0 + term * d or tiny)
            c = 1.0 + term / c or tiny
            value *= c * d
        if abs(c * d - 1.0) < 1e-14:
            return value


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(X <= k) for n draws with chance p (between 0 and 1): the incomplete beta function I(1 - p; n - k, k + 1)."""
    if k >= n:
        return 1.0
    a, b, x = float(n - k), k + 1.0, 1.0 - p
    scale = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(p))
    if x < (a + 1.0) / (a + b + 2.0):
        return scale * _beta_fraction(a, b, x) / a
    return 1.0 - scale * _beta_fraction(b, a, p) / b


def controlled(rejected: int, of: int, risk: float, level: float) -> bool:
    """Whether the upper Clopper-Pearson bound of a rejection rate is at most ``risk``."""
    return of > 0 and rejected <= risk * of and binomial_cdf(rejected, of, risk) <= level


def steps_passed(rejected: Sequence[int], of: int, risk: float, level: float) -> int:
    """How many steps of a path, with their rejections among ``of`` holdouts, pass before the first that fails."""
    passed = (controlled(count, of, risk, level) for count in rejected)
    return sum(1 for _ in takewhile(bool, passed))


def _broken(limits: dict[str, float]) -> Column:
    """Whether any share is above its cutoff."""
    return reduce(lambda found, rule: found | (F.col(rule) > limits[rule]), limits, F.lit(False))


def path_of(design: DataFrame) -> list[dict[str, float]]:
    """The cutoffs of each step: the strictest ones above which a rule has at most its part of ``design``.

    One row of counts comes to the driver.
    """
    counts = design.agg(
        F.count(F.lit(1)).alias("n_good"),
        *(F.array(*(F.count_if(F.col(rule) > cutoff) for cutoff in CUTOFFS)).alias(rule) for rule in RULES),
    ).first()
    return [
        {
            rule: next((cut for cut, above in zip(CUTOFFS, counts[rule], strict=True) if above <= part * counts["n_good"]), 1.0)
            for rule in RULES
        }
        for part in PATH
    ]


def cutoffs(good: DataFrame, risk: float = RISK, alpha: float = ALPHA) -> dict[str | None, dict[str, float]]:
    """The certified cutoff of each rule in each stratum, from good documents (doc_id, lang and the shares).

    What comes to the driver is one row of counts per stratum that has enough holdouts to be certified.
    """
    design = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0
    path = path_of(good.where(design))
    counts = good.where(~design).groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_good"), F.array(*(F.count_if(_broken(limits)) for limits in path)).alias("rejected")
    )
    # strata are left out by their number of holdouts alone, at the level of a single one, not by what was rejected
    rows = counts.where(F.col("n_good") * -math.log1p(-risk) >= -math.log(alpha)).collect()
    passed = {row["lang"]: steps_passed(row["rejected"], row["n_good"], risk, alpha / len(rows)) for row in rows}
    return {lang: path[steps - 1] for lang, steps in passed.items() if steps}


def good_documents(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, lang and shares of the documents whose ``labels.quality`` is 1 and that pass the base rules, once each."""
    good = labels.where("quality = 1").select("doc_id").distinct()
    passing = shared.where(~base_failed()).join(good, "doc_id")
    return passing.groupBy("doc_id").agg(F.max(F.struct("lang", *RULES)).alias("_one")).select("doc_id", "_one.*")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def judge(docs: DataFrame, labels: DataFrame, risk: float = RISK, alpha: float = ALPHA) -> DataFrame:
    """doc_id, the base measures, base_failed, kept and the broken rule of every document."""
    shared = shares(settled(measures(docs), "quality-measures"))
    found = cutoffs(settled(good_documents(shared, labels), "quality-good"), risk, alpha)
    broken = F.lit(None).cast("string")
    for lang, limits in sorted(found.items(), key=str):
        for rule, cutoff in limits.items():
            over = F.col("lang").eqNullSafe(F.lit(lang)) & (F.col(rule) > cutoff)
            broken = F.coalesce(F.when(over, F.lit(rule)), broken)
    judged = shared.withColumns({"base_failed": base_failed(), "broken_rule": broken})
    return judged.select(
        "doc_id", *MEASURES[:5], "base_failed", (~F.col("base_failed") & F.col("broken_rule").isNull()).alias("kept"),
        "broken_rule",
    )
