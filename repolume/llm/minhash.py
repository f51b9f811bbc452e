"""Near-duplicate groups by a chosen-path set similarity join over minwise hashes.

Every text becomes its set of distinct five-word shingles (fewer words: one shingle of all of them) and ``COORDINATES``
minwise hashes of it. Texts with equal sets form one class, which takes part once. ``TREES`` independent trees then
branch the classes: a node chooses one coordinate, with chance 1/3 a second one (1 / 0.75 branches in expectation), and
sends each class to the child of its minwise token there. Two sets whose similarity is 0.75 stay together with chance
0.75 per branch, so they survive some path of a tree with chance 0.81, 0.69, 0.60 at depth one, two, three; over the
twelve trees about one link in 10,000 is missed at the last of the ``LEVELS``, and more similar sets far more rarely.

Links come from the trees in two passes, so that a group of copies is never compared pair by pair:

1. In every node of the first level each class is compared with the node's hub, the class that shares most tokens with
   the others. The comparison whose tokens agree best is confirmed per class. Most of a large group is joined by that,
   at one comparison each.
2. Nodes whose classes now lie in one component are done. In small nodes, those with at most ``LEAF`` classes outside
   their main component, all classes of different components are compared exhaustively, which is at most ``LEAF`` pairs a
   class; the others are branched on, with chance 1/2 for a second branch, for as long as that takes ``SHRINK`` of the
   classes out of large nodes at every level.
3. What branching does not part shares much of its text. It is linked to its hubs, and what that does not connect is joined
   exactly, by the rarest shingles of each class: two similar sets share one of them, so no pair of theirs is missed. Blocks
   of a shingle are cut into cells, so that no task compares a whole one.

Minwise estimates only sort out; every link is confirmed on the shingles of both texts. The links to hubs form a
forest, whose roots are found by pointer doubling; other links join its trees, by alternating star contractions. Both
are joins.

Defined results: a NULL, empty or blank text has an empty set and is linked with nothing; rows that share an id are
grouped by their texts, and groups with the same smallest id are one; repeated rows get the same result; a row without
an id belongs to the group of its text but names none; no documents give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repolume.llm.common import discard, hash_windows, hash_words, mix, settled, settled_in_batches, small, texts_of

SHINGLE = 5
SIMILAR = 75  # per cent of the union
TREES = 12
COORDINATES = 64
ROOT = 2 * TREES  # coordinates that the first level uses, none of them twice; deeper levels use the others
LEAF = 40  # a node is compared exhaustively if at most so many of its rows lie outside its main component
SHRINK = 0.2
CELL = 400  # rows on each side of a cell in which blocks of rare shingles are compared
BUCKETS = 1 << 17  # of hashes, by whose counts shingles are ordered, rare ones first
# A list of so many ids at most (8 MB) is broadcast, to take the texts that are wanted before any is shuffled.
IDS = 1_000_000
# Estimates from 64 coordinates have a standard deviation of 0.054 at 0.75: this lies more than four of them below.
LEAST_ESTIMATE = 33
_BLOCK = 4096
# One bit of each of many more minwise hashes tells 0.75 from 0.6, which 64 whole ones do not. Similar sets agree in 7/8 of
# the bits; the least is more than six standard deviations below.
WORDS = 32
BITS = 64 * WORDS
LEAST_BITS = 1695

_draw = np.random.default_rng(64)
_FACTORS = _draw.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _draw.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)
_BIT_FACTORS = _draw.integers(1, 1 << 63, BITS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BIT_OFFSETS = _draw.integers(0, 1 << 63, BITS, dtype=np.uint64)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingles(text: str | None) -> set[bytes]:
    """The distinct shingles themselves."""
    words = words_of(text)
    if len(words) < SHINGLE:
        return {b" ".join(words)} if words else set()
    return {b" ".join(words[at : at + SHINGLE]) for at in range(len(words) - SHINGLE + 1)}


def hashed_shingles(text: str) -> np.ndarray:
    """Ascending 64-bit hashes of the distinct shingles."""
    words = words_of(text)
    if not words:
        return np.empty(0, dtype=np.uint64)
    width = min(SHINGLE, len(words))
    hashes = hash_windows(hash_words(words), width)
    return np.unique(hashes + np.uint64(SHINGLE - width))


def minwise(hashes: np.ndarray) -> np.ndarray:
    """``COORDINATES`` minwise hashes of a set that is not empty; memory is bounded for sets of any size."""
    return (_least(hashes, _FACTORS, _OFFSETS) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _least(hashes: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    least = np.full(len(factors), np.iinfo(np.uint64).max, dtype=np.uint64)
    step = max(1, _BLOCK * COORDINATES // len(factors))
    for at in range(0, len(hashes), step):
        block = hashes[at : at + step, None] * factors + offsets
        np.minimum(least, block.min(axis=0), out=least)
    return least


def minwise_bits(hashes: np.ndarray) -> np.ndarray:
    """A bit of each of ``BITS`` minwise hashes, in ``WORDS`` numbers."""
    return np.packbits((mix(_least(hashes, _BIT_FACTORS, _BIT_OFFSETS)) & np.uint64(1)).astype(np.uint8)).view(np.int64)


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_key (NULL for an empty set) and minwise hashes of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, tokens = [], [], []
            for text in texts_of(batch):
                hashes = hashed_shingles(text)
                sizes.append(len(hashes))
                keys.append(xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None)
                tokens.append(minwise(hashes) if len(hashes) else None)
            columns = [
                batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                pa.array(tokens, pa.list_(pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "set_key", "tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_shingles long, set_key binary, tokens array<int>"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _child(parent: Column, coordinate: Column) -> Column:
    return F.xxhash64(parent, coordinate, F.get("tokens", coordinate))


def first_level(classes: DataFrame) -> DataFrame:
    """node and id of every class in the first level of every tree."""
    children = []
    for tree in range(TREES):
        children.append(_child(F.lit(tree), F.lit(tree)))
        if tree % 3 == 0:
            children.append(_child(F.lit(tree), F.lit(TREES + tree)))
    return classes.select("id", F.explode(F.array(*children)).alias("node"))


def next_level(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Branch ``rows`` (node, id, component): each node chooses coordinates by its own hash, one or two."""
    pick = lambda salt: (F.pmod(F.xxhash64("node", F.lit(salt)), F.lit(COORDINATES - ROOT)) + ROOT).cast("int")
    second = F.pmod(F.xxhash64("node", F.lit("branches")), F.lit(2)) == 0
    children = F.array(
        _child(F.col("node"), pick("first")), F.when(second, _child(F.col("node"), pick("second")))
    )
    branched = rows.join(classes.select("id", "tokens"), "id")
    return branched.select("id", "component", F.explode(F.array_compact(children)).alias("node"))


def _alike(a: str, b: str) -> Column:
    """Whether two classes (columns n and tokens with these suffixes) can be similar, by size and estimate."""
    return _sized(a, b) & (_agreeing(a, b) >= LEAST_ESTIMATE)


def _agreeing(a: str, b: str) -> Column:
    """Number of coordinates in which two classes agree."""
    return F.size(F.filter(F.zip_with(f"tokens_{a}", f"tokens_{b}", lambda x, y: x == y), lambda same: same))


def estimate(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with their ``agreeing`` coordinates, those that cannot be similar left out."""
    side = lambda name: classes.select(
        F.col("id").alias(name), F.col("n").alias(f"n_{name}"), F.col("tokens").alias(f"tokens_{name}")
    )
    both = pairs.join(side("a"), "a").join(side("b"), "b").where(_alike("a", "b"))
    return both.select("a", "b", _agreeing("a", "b").alias("agreeing"))


def confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) whose full shingle sets are similar enough, settled; ``texts`` has id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = None, set()
        for batch in batches:
            passed = []
            for left, right in zip(batch.column("text_a"), batch.column("text_b"), strict=True):
                left = left.as_py()
                if left != last:
                    last, known = left, shingles(left)
                other = shingles(right.as_py())
                common = len(known & other)
                passed.append(100 * common >= SIMILAR * (len(known) + len(other) - common))
            yield batch.select(["a", "b"]).filter(pa.array(passed, pa.bool_()))

    pairs = settled(pairs.select("a", "b"), "minhash-candidates")
    ids = settled(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "minhash-ids")
    texts = _wanted(texts, ids)
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(right, "b").join(left, "a")
    kind = texts.schema["id"].dataType.simpleString()
    links = both.select("a", "b", "text_a", "text_b").mapInArrow(run, f"a {kind}, b {kind}").distinct()
    links = settled_in_batches(links, "minhash-confirmed")
    discard(pairs, ids)
    return links


def _wanted(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``texts`` whose id is among ``ids`` (settled), where they lie if the list is short."""
    return texts.join(small(ids, IDS), "id", "left_semi")


def roots(parents: DataFrame) -> DataFrame:
    """id and component of every row of ``parents`` (id, component < id; one row per id): where the chain of parents
    ends, found by pointer doubling."""
    parents = settled(parents, "minhash-parents")
    while True:
        above = parents.select(F.col("id").alias("component"), F.col("component").alias("_above"))
        jumped = parents.select("id", "component").join(above, "component", "left")
        last, parents = parents, settled(
            jumped.select("id", F.coalesce("_above", "component").alias("component"), F.col("_above").isNotNull().alias("_moved")),
            "minhash-roots",
        )
        discard(last)
        if parents.where("_moved").isEmpty():
            return parents.select("id", "component")


def components(links: DataFrame) -> DataFrame:
    """id and component (smallest id) of every id that ``links`` (a, b) connect, by alternating star contractions.

    Each round points the larger neighbours of an id at its smallest neighbour, then its smaller ones; links are done
    when every id has one link, to an id that is no id's larger end.
    """
    links = settled(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "minhash-links",
    )
    while True:
        centres = links.select(F.col("b").alias("a")).distinct().join(links, "a", "left_semi")
        if centres.isEmpty() and links.groupBy("a").count().where("count > 1").isEmpty():
            return links.select(F.col("a").alias("id"), F.col("b").alias("component"))
        either = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = either.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = either.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b")))
            .distinct()
        )
        last, links = links, settled(small, "minhash-links")
        discard(last)


def hub_links(rows: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """id and component (another id) for each id of ``rows`` (node, id, size) that one comparison could link.

    The hub of a node is the id whose nodes are largest in sum, thus the one that shares most tokens with the others:
    of copies that were each edited apart it is the original, although two copies need not be similar. Each id is
    compared with the hub whose tokens agree best with its own. Hubs rank above the ids they are compared with, so the
    links are a forest.
    """
    weight = rows.groupBy("id").agg(F.sum("size").alias("weight"))
    ranked = rows.select("node", "id").join(weight, "id")
    hubs = ranked.groupBy("node").agg(F.max(F.struct("weight", "id"))["id"].alias("hub"))
    stars = rows.select("node", "id").join(hubs, "node").where("id <> hub")
    stars = stars.select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    best = estimate(stars, classes).groupBy("b").agg(F.max_by("a", F.struct("agreeing", "a")).alias("a"))
    return confirm(best, texts).select(F.col("b").alias("id"), F.col("a").alias("component"))


def _mixed(rows: DataFrame) -> DataFrame:
    """``rows`` (node, id, component) of the nodes that hold several components, with the node's size, its main
    component and the number of its rows outside that, settled."""
    parts = rows.groupBy("node", "component").agg(F.count(F.lit(1)).alias("_n"))
    nodes = parts.groupBy("node").agg(
        F.sum("_n").alias("size"), F.max(F.struct("_n", "component")).alias("_main")
    ).where("size > _main._n")
    others = F.col("size") - F.col("_main._n")
    nodes = nodes.select("node", "size", F.col("_main.component").alias("main"), others.alias("others"))
    nodes = settled(nodes, "minhash-nodes")
    mixed = settled(rows.drop("size").join(nodes, "node"), "minhash-mixed")
    discard(nodes)
    return mixed


def _merged(joined: DataFrame, links: DataFrame) -> DataFrame:
    """``joined`` (id, component) after ``links`` (a, b), of which most connect no new components."""
    of = lambda end: joined.select(F.col("id").alias(end), F.col("component").alias(f"_{end}"))
    between = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(
        F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b")
    )
    moved = components(between)
    onward = moved.select(F.col("id").alias("component"), F.col("component").alias("_onward"))
    kept = joined.join(onward, "component", "left").select("id", F.coalesce("_onward", "component").alias("component"))
    return kept.unionByName(moved.join(joined, "id", "left_anti"))


def _linked(joined: DataFrame, pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``joined`` (id, component) after all links among ``pairs`` (a, b, agreeing), settled.

    Of the pairs between two components the one that agrees best is confirmed first. Where it is a link the others add
    nothing, as their ends are in one component then; where it is none, all the others are confirmed. Pairs are looked up
    by their ids once; which components have become one since is looked up per two components, not per pair.
    """
    once = pairs.groupBy(F.least("a", "b"), F.greatest("a", "b")).agg(F.max(F.struct("agreeing", "a", "b")).alias("pair"))
    found = _apart(once.select("pair.*"), joined)
    between = F.least("_a", "_b").alias("_a"), F.greatest("_a", "_b").alias("_b")
    first = settled(found.select("agreeing", "a", "b", *between), "minhash-apart")
    best = first.groupBy("_a", "_b").agg(F.max(F.struct("agreeing", "a", "b")).alias("best"), F.count(F.lit(1)).alias("_n"))
    best = settled(best.select("_a", "_b", "_n", "best.a", "best.b"), "minhash-best")
    joined = settled(_merged(joined, confirm(best, texts)), "minhash-joined")
    # a component is called by one of its ids
    parts = best.where("_n > 1").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
    still = _apart(parts, joined).select(F.col("a").alias("_a"), F.col("b").alias("_b"))
    others = first.join(still, ["_a", "_b"], "left_semi").join(best, ["a", "b"], "left_anti")
    others = settled(others.select("a", "b"), "minhash-others")
    discard(first, best)
    if not others.isEmpty():
        joined = settled(_merged(joined, confirm(others, texts)), "minhash-joined")
    discard(others)
    return joined


def _apart(pairs: DataFrame, joined: DataFrame) -> DataFrame:
    """``pairs`` (a, b, ...) whose ends lie in different components, with these, ``_a`` and ``_b``."""
    of = lambda end: joined.select(F.col("id").alias(end), F.col("component").alias(f"_{end}"))
    found = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
    return found.withColumns({f"_{end}": F.coalesce(f"_{end}", end) for end in "ab"}).where("_a <> _b")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept (smallest id of its component) of every row of ``docs``."""
    sketched = settled_in_batches(sketches(docs), "minhash-sketches")
    classes = settled(
        sketched.where("set_key IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("set_key")
        .agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("tokens").alias("tokens")),
        "minhash-classes",
    )
    placed = first_level(classes)
    shared = settled(placed.groupBy("node").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "minhash-shared")
    # settled, so that the join's sides are plain shuffles and a large node can be split
    rows = settled(placed.join(shared, "node"), "minhash-nodes")
    discard(shared)

    # one text per id; ids that several rows share bring several
    members = settled(rows.select("id").distinct(), "minhash-members")
    texts = settled(_wanted(docs.select(F.col("doc_id").alias("id"), "text"), members), "minhash-texts")
    # what follows is about classes that share a node; the others' tokens need not be shuffled again
    met = settled(_wanted(classes, members), "minhash-met")
    discard(members)
    joined = roots(hub_links(rows, met, texts))
    component = F.coalesce("component", "id").alias("component")
    now = lambda nodes: nodes.select("node", "id").join(joined, "id", "left").select("node", "id", component)

    mixed = _mixed(now(rows))
    discard(rows)
    found, left = [_exhaustive(mixed, met)], _large(mixed)
    large = left.count()
    while large:
        deeper = _mixed(next_level(left, met))
        found.append(_exhaustive(deeper, met))
        rest = _large(deeper)
        before, large = large, rest.count()
        discard(left, deeper)
        left = rest
        if large > (1 - SHRINK) * before:
            break
    discard(mixed)
    if large:  # texts that share much
        links = hub_links(left, met, texts).select(F.col("component").alias("a"), F.col("id").alias("b"))
        joined = settled(_merged(joined, links), "minhash-joined")
        mixed = _mixed(now(left))
        found.append(_exhaustive(mixed, met))
        rest = settled(_large(mixed).select("id", "component").distinct(), "minhash-rest")
        if not rest.isEmpty():
            found.append(rare_pairs(rest, texts))
        discard(mixed, rest)
    joined = _linked(joined, reduce(DataFrame.unionByName, found), texts)
    discard(left, texts, met, *found)

    final = classes.select("set_key", "id").join(joined, "id", "left").select("set_key", "id", component)
    smallest = final.groupBy("component").agg(F.min("id").alias("component_id"))
    of_class = final.join(smallest, "component").select("set_key", "component_id")
    least = F.coalesce("component_id", "doc_id")
    return sketched.join(of_class, "set_key", "left").select(
        "doc_id", "n_shingles", least.alias("component_id"), F.col("doc_id").eqNullSafe(least).alias("kept")
    )


def _large(mixed: DataFrame) -> DataFrame:
    """The rows of nodes that are too large to be compared exhaustively, settled."""
    large = mixed.where(F.col("others") > LEAF)
    return settled(large.select("node", "id", "component", "size"), "minhash-left")


def _exhaustive(mixed: DataFrame, classes: DataFrame) -> DataFrame:
    """All pairs of different components in each small node whose tokens agree often enough, compared where the node
    lies, settled. The rows of a node's main component meet the others only, so a large pure group is passed once."""
    near = mixed.where(F.col("others") <= LEAF)
    full = near.select("node", "id", "component", "main").join(classes.select("id", "n", "tokens"), "id")
    pairs = _compared(full, full, ["node"], ["n", "tokens"], _alike("a", "b"), _agreeing("a", "b"))
    return settled(pairs.distinct(), "minhash-pairs")


def _compared(
    rows: DataFrame, whole: DataFrame, keys: Sequence[str], about: Sequence[str], alike: Column, agreeing: Column
) -> DataFrame:
    """Pairs (a, b) of ``rows`` outside the main component with rows of ``whole`` (both: keys, id, component, main and
    what is known ``about`` them) that have the same ``keys`` and are ``alike``, and how far they are ``agreeing``."""
    columns = ("id", "component", *about)
    side = lambda df, name, *more: df.select(*keys, *more, *(F.col(c).alias(f"{c}_{name}") for c in columns))
    both = side(rows.where("component <> main"), "a").join(side(whole, "b", "main"), list(keys))
    once = F.col("component_b").eqNullSafe(F.col("main")) | (F.col("id_a") < F.col("id_b"))
    both = both.where((F.col("component_a") != F.col("component_b")) & once & alike)
    return both.select(F.col("id_a").alias("a"), F.col("id_b").alias("b"), agreeing.alias("agreeing"))


def _sized(a: str, b: str) -> Column:
    n_a, n_b = F.col(f"n_{a}"), F.col(f"n_{b}")
    return 100 * F.least(n_a, n_b) >= SIMILAR * F.greatest(n_a, n_b)


def _alike_rest(a: str, b: str) -> Column:
    """Whether two classes that share a shingle, at place ``at`` in the order of each, can be similar: if it is the first
    that they share, all others come after it in both. The bits of many minwise hashes then tell more."""
    most = F.least(F.col(f"n_{a}") - F.col(f"at_{a}"), F.col(f"n_{b}") - F.col(f"at_{b}"))
    enough = (100 + SIMILAR) * most >= SIMILAR * (F.col(f"n_{a}") + F.col(f"n_{b}"))
    return enough & _sized(a, b) & (_differing(a, b) <= BITS - LEAST_BITS)


def _differing(a: str, b: str) -> Column:
    """Number of bits in which two classes differ."""
    words = (F.get(f"bits_{a}", F.lit(at)).bitwiseXOR(F.get(f"bits_{b}", F.lit(at))) for at in range(WORDS))
    return sum(F.bit_count(word) for word in words)


def prefix(n: int) -> int:
    """How many of its rarest shingles a set of ``n`` has to show to share one with every similar set: similar sets share
    ``SIMILAR`` per cent of either of them at least."""
    return n - -(-SIMILAR * n // 100) + 1


def _ranks(texts: DataFrame) -> np.ndarray:
    """How frequent the shingles of each of the ``BUCKETS`` are, as a rank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for text in texts_of(batch):
                np.add.at(counts, (hashed_shingles(text) % np.uint64(BUCKETS)).astype(np.int64), 1)
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(counts[met])], names=["bucket", "n"])

    counts = np.zeros(BUCKETS, dtype=np.int64)
    found = texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return np.unique(counts, return_inverse=True)[1].astype(np.int32)


def rare_pairs(rest: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components of ``rest`` (id, component), among them all that are similar, and about how
    many coordinates are ``agreeing``.

    Every set meets the others in the blocks of its rarest shingles (``prefix`` of them); the order is by the count of a
    shingle's bucket, so what a source repeats in every text comes last. The shingles' order decides on the size of the
    blocks only.
    """
    own = settled(texts.join(rest, "id"), "minhash-rest-texts")
    ranks = _ranks(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, text in enumerate(texts_of(batch)):
                hashes = hashed_shingles(text)
                ordered = hashes[np.lexsort((hashes, ranks[(hashes % np.uint64(BUCKETS)).astype(np.int64)]))]
                nodes = ordered[: prefix(len(hashes))].view(np.int64)
                sizes, bits = pa.array(np.full(len(nodes), len(hashes))), pa.array([minwise_bits(hashes)])
                same = pa.array(np.zeros(len(nodes), dtype=np.int32))
                own_ids = [batch.column(name).slice(at, 1).take(same) for name in ("id", "component")]
                columns = [pa.array(nodes), *own_ids, sizes, pa.array(np.arange(len(nodes))), bits.take(same)]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "id", "component", "n", "at", "bits"])

    kind = texts.schema["id"].dataType.simpleString()
    blocks = own.select("text", "id", "component").mapInArrow(
        run, f"node long, id {kind}, component {kind}, n long, at long, bits array<long>"
    )
    blocks = settled(blocks, "minhash-blocks")
    rows = _mixed(blocks)
    parts = lambda count: F.greatest(F.lit(1), F.ceil(F.col(count) / CELL)).cast("int")
    each = lambda count: F.explode(F.sequence(F.lit(0), count - 1))
    down, across = parts("others"), parts("size")
    left = rows.withColumns({"down": F.pmod(F.xxhash64("id", F.lit("down")), down), "across": each(across)})
    right = rows.withColumns({"across": F.pmod(F.xxhash64("id", F.lit("across")), across), "down": each(down)})
    # two bits differ by chance where the hashes do, so half of the differing coordinates do not show
    agreeing = F.lit(COORDINATES) - (_differing("a", "b") * (2 * COORDINATES) / BITS).cast("int")
    pairs = _compared(left, right, ["node", "down", "across"], ["n", "at", "bits"], _alike_rest("a", "b"), agreeing)
    pairs = settled(pairs.distinct(), "minhash-rare")
    discard(own, blocks, rows)
    return pairs


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each group, with all its columns: the one with the smallest id.

    Of rows that share an id, and of rows without an id, those stay that no group drops.
    """
    found = near_duplicates(docs).groupBy("doc_id").agg(F.bool_or("kept").alias("kept"))
    dropped = found.where("NOT kept").select("doc_id")
    return docs.join(dropped, "doc_id", "left_anti")
