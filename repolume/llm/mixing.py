"""Mix sources to target weights by pivotal dependent rounding.

A source's target is its weight's share of all words, at most ``most`` times its own size; what exceeds that is
reshared by weight. Each document is to be taken ``target / source size`` times, a number with a fraction. Its whole
part is given. The fractions are rounded in pairs: words are moved between two documents of a source, in a random
direction whose odds keep both expectations, until one of the two fractions is 0 or 1. The words of a pair are the
same before and after, so a source misses its target by less than one document.

The pairing runs in bundles of bounded size, many per source; each bundle leaves at most one fraction, and those are
paired again, ``FAN_IN`` at a time, up a reduction tree whose root is rounded by chance. Random numbers come from
hashes of the bundle, and rows are ordered by content, so reruns and retried tasks agree.

Defined results: a NULL text has no words; documents without words are taken as often as their whole part says
(0 words each way); NULL is a source of its own, ordered last; repeated rows are rounded one by one; no documents
give no rows. A source without words has the target 0.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repolume.llm.common import count_words, settled, small

BUNDLE = 20_000  # documents of a source that one task pairs
FAN_IN = 5_000  # residual fractions of a source that one task pairs
_EDGE = 1e-9


def targets(sources: DataFrame, weights: Sequence[int] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """``sources`` (source, source_size) with ``source_rank`` (by code point, NULL last) and ``target``.

    One row per source. Sources whose cap is small for their weight are filled first: with the sources in the order
    of cap per weight, the level that the others share is the largest of the levels left after each prefix.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("source_rank", F.row_number().over(ordered) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("source_rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumns({"_weight": weight.cast("double"), "_cap": F.col("source_size") * F.lit(float(most))})
    fill = Window.orderBy(F.col("_cap") / F.col("_weight"), "source_rank")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy())
    level = (total - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_weight").over(rest)
    levels = ranked.withColumn("_level", level)
    level = F.max("_level").over(Window.partitionBy())
    return levels.withColumn("target", F.least("_cap", level * F.col("_weight"))).drop("_weight", "_cap", "_level")


def round_in_pairs(sizes: np.ndarray, fractions: np.ndarray, seed: int) -> tuple[np.ndarray, int]:
    """Fractions after pairing, all 0 or 1 but at most one, and the position of that one (-1: none)."""
    draws = np.random.default_rng(seed).random(len(sizes)).tolist()
    result = fractions.tolist()
    weights = sizes.tolist()
    held = -1
    for at, fraction in enumerate(result):
        if fraction <= _EDGE or fraction >= 1 - _EDGE:
            result[at] = float(fraction > 0.5)
            continue
        if held < 0:
            held = at
            continue
        a, b, x, y = weights[held], weights[at], result[held], fraction
        # words that can go from the held document to this one, and the other way
        out, back = min(a * x, b * (1 - y)), min(a * (1 - x), b * y)
        moved = out if draws[at] * (out + back) < back else -back
        x, y = x - moved / a, y + moved / b
        if x <= _EDGE or x >= 1 - _EDGE:
            result[held], result[at] = float(x > 0.5), y
            held = at
            if y <= _EDGE or y >= 1 - _EDGE:
                result[at], held = float(y > 0.5), -1
        else:
            result[held], result[at] = x, float(y > 0.5)
    return np.array(result, dtype="float64"), held


def _pair(id_columns: list[str], level: int, columns: list[str]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def pair(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(id_columns, kind="stable", na_position="first").reset_index(drop=True)
        seed = (int(rows["source_rank"].iloc[0]) << 40) ^ (int(rows["node"].iloc[0]) << 4) ^ level
        fractions, held = round_in_pairs(rows["size"].to_numpy(), rows["fraction"].to_numpy(), seed)
        return rows.assign(fraction=fractions, open=np.arange(len(rows)) == held)[columns]

    return pair


def dependent_rounding(items: DataFrame, bundle: int = BUNDLE, fan_in: int = FAN_IN) -> DataFrame:
    """``items`` (doc_id, source_rank, size > 0, fraction, and others) with ``extra`` 0 or 1 in place of ``fraction``.

    Sums of size * fraction per source are kept but for one document.
    """
    counts = settled(
        items.groupBy("source_rank").agg(F.ceil(F.count(F.lit(1)) / bundle).alias("nodes")), "mixing-nodes"
    )
    most = counts.agg(F.max("nodes")).first()[0] or 0
    others = [c for c in items.columns if c not in ("node", "open", "extra")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.select(others).schema.fields)
    dealt = items.select(others).join(small(counts), "source_rank")
    dealt = dealt.withColumn("node", F.pmod(F.xxhash64("doc_id"), F.col("nodes"))).drop("nodes")
    keep = [*others, "node", "open"]
    done = settled(
        dealt.groupBy("source_rank", "node").applyInPandas(
            _pair(["doc_id", "size", "fraction"], 0, keep), f"{schema}, node long, open boolean"
        ),
        "mixing-pairs",
    )
    # residual: the one open fraction of each bundle, under the number of the node it waits in
    residual = done.where("open").select("source_rank", F.col("node").alias("item"), "node", "size", "fraction")
    decided = None
    level, nodes = 0, most
    slim = ["source_rank", "item", "node", "size", "fraction", "open"]
    kinds = "source_rank int, item long, node long, size long, fraction double, open boolean"
    while nodes > 1:
        nodes, level = math.ceil(nodes / fan_in), level + 1
        paired = settled(
            residual.withColumn("node", F.floor(F.col("node") / fan_in))
            .groupBy("source_rank", "node")
            .applyInPandas(_pair(["item"], level, slim), kinds),
            "mixing-residuals",
        )
        closed = paired.where("not open").select("source_rank", "item", F.col("fraction").cast("int").alias("extra"))
        decided = closed if decided is None else decided.unionByName(closed)
        residual = paired.where("open").drop("open")
    draw = F.pmod(F.xxhash64(F.lit("root"), "source_rank", "item"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    root = residual.select("source_rank", "item", (draw < F.col("fraction")).cast("int").alias("extra"))
    decided = root if decided is None else decided.unionByName(root)
    outer = [c for c in others if c != "fraction"]
    settled_rows = done.where("not open").select(*outer, F.col("fraction").cast("int").alias("extra"))
    open_rows = done.where("open").withColumnRenamed("node", "item").join(decided, ["source_rank", "item"])
    return settled_rows.unionByName(open_rows.select(*outer, "extra"))


def mix_sources(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """doc_id, size, source_size, target, taken and copies of every row of ``docs`` (doc_id, text, source)."""
    sized = settled(docs.select("doc_id", "source", count_words(F.col("text")).alias("size")), "mixing-sizes")
    per_source = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    per_source = settled(per_source, "mixing-targets")
    per_source = small(per_source)
    same = sized["source"].eqNullSafe(per_source["source"])
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = sized.join(per_source, same).withColumn("times", times).select(
        "doc_id", sized["source"], "size", "source_size", "target", "source_rank", F.floor("times").alias("whole"),
        (F.col("times") - F.floor("times")).alias("fraction"),
    )
    # as text: pandas has no NULL among whole numbers
    slim = rows.where("size > 0").withColumn("doc_id", F.col("doc_id").cast("string"))
    rounded = dependent_rounding(slim).withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
    wordless = rows.where("size = 0").drop("fraction").withColumn("extra", F.lit(0))
    copies = F.col("whole") + F.col("extra")
    return rounded.unionByName(wordless).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"), copies.alias("copies"),
        "source",
    )


def take_copies(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """The mix itself: each row of ``docs`` as many times as it is taken, with all its columns.

    Rows that share an id are told apart by their order in source and size, and of equal ones the text with the smaller
    hash is taken less often, so reruns agree.
    """
    nth = lambda tie: F.row_number().over(Window.partitionBy("id").orderBy("source", "size", tie)).alias("nth")
    copies = mix_sources(docs, weights, most).withColumnRenamed("doc_id", "id").select("id", nth("copies"), "copies")
    copies = copies.where("copies > 0").withColumnsRenamed({"id": "taken_id", "nth": "taken_nth"})
    # whole rows travel as one column, so that no column of theirs can clash
    rows = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").alias("id"), "source", count_words(F.col("text")).alias("size"),
        F.xxhash64("text").alias("text_hash"),
    ).select("row", "id", nth("text_hash"))
    same = rows["id"].eqNullSafe(copies["taken_id"]) & (rows["nth"] == copies["taken_nth"])
    repeat = F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("copy")
    return rows.join(copies, same).select("row", repeat).select("row.*")
