"""The prefix trie of conversations, by ROLLUP over columns of turn ids.

A turn is named by a digest of its role and text, so texts are read once and never shuffled. A conversation is cut into
blocks of ``WIDTH`` turns, one row each with the turn ids in columns, and under the name of the node that the block
before ends in: the exclusive or of two 64-bit hashes of every earlier turn at its position, 128 bits in all. All blocks of
all conversations are therefore independent of each other, and one ``GROUP BY block, node, ROLLUP (t1, ..., tn)`` yields
every prefix of every length; ``grouping_id`` tells how long it is.

A node belongs to its smallest member, which is also the smallest member of the nodes on its way down that it is in. So
what is summed over a subtree (leaves, saved bytes) is laid on the members' own blocks, added up from their ends, and
rolled up in the same way: no step walks down the trie, however deep it is.

Skew: roll-ups and counts are combined in the map tasks; positions are numbered in ranges of turns, and sums along a
conversation in ranges of blocks, so that one conversation may hold most of the turns. Lists of members are sorted in
ranges over all tasks, joined to pieces there, and only then digested node by node, as a stream.

Defined results: NULL role or text is empty; turns are ordered by turn (NULL first), equal ones by a digest of role and
text, so repeated rows are turns of their own; rows without a conversation id belong to no conversation; without any
conversation there are no nodes, not even the root. Other columns are ignored, whatever they are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repolume.functions.ranking import with_position
from repolume.llm.common import settled

WIDTH = 8  # turns of a block
BLOCKS = 1024  # of one conversation that one task adds up
PIECE = 4096  # ids that are joined before they are digested
_KEY = ["depth", "k0", "k1"]  # names a node
_SLOTS = range(1, WIDTH + 1)


# ---- turns --------------------------------------------------------------------------------------------------------


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, at (position from 0) and turn_id of every row of ``conversations`` (conv_id, turn, role, text).

    ``turn_id`` is 16 bytes of a digest of role and text, and the text's length in UTF-8 bytes.
    """
    role, text = (F.coalesce(F.col(name), F.lit("")) for name in ("role", "text"))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    turn_id = F.unhex(F.concat(F.substring(digest, 1, 32), F.lpad(F.hex(F.octet_length(text).cast("long")), 16, "0")))
    turns = conversations.where("conv_id IS NOT NULL").select("conv_id", "turn", turn_id.alias("turn_id"))
    placed = with_position(settled(turns, "trie-turns"), ["turn", "turn_id"], ["conv_id"], "at")
    return placed.select("conv_id", "at", "turn_id")


def text_bytes(turn_id: Column) -> Column:
    return F.conv(F.hex(F.substring(turn_id, 17, 8)), 16, 10).cast("long")


def rebuild(turns: DataFrame, family: int = 5, most: int = 8) -> DataFrame:
    """Conversations that share beginnings: every id c begins with the first h turns of conversation c - c % family and
    goes on with its own turns after its first h, where h = crc32(c) % (most + 1).

    ``turns`` is (conv_id, at, turn_id); a conversation that is left without turns has one row whose ``at`` is NULL.
    """
    turns = settled(turns, "trie-ordered")
    head = F.sort_array(F.collect_list(F.struct("at", "turn_id"))).alias("head")  # ``most`` entries at most
    heads = turns.where(F.col("at") < most).groupBy(F.col("conv_id").alias("base")).agg(head)
    members = turns.where("at = 0").select(
        "conv_id", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % family).alias("base"),
    )
    members = members.join(heads, "base", "left").select(
        "conv_id", "h", F.slice(F.coalesce("head", F.array()), F.lit(1), F.col("h").cast("int")).alias("head")
    )
    members = settled(members, "trie-members")
    begun = members.select("conv_id", F.explode("head").alias("_turn")).select("conv_id", "_turn.at", "_turn.turn_id")
    own = turns.join(members.select("conv_id", "h", F.size("head").alias("_taken")), "conv_id").where("at >= h")
    own = own.select("conv_id", (F.col("at") - F.col("h") + F.col("_taken")).alias("at"), "turn_id")
    empty = members.select("conv_id", F.lit(None).cast("long").alias("at"), F.lit(None).cast("binary").alias("turn_id"))
    return begun.unionByName(own).unionByName(empty)


# ---- blocks -------------------------------------------------------------------------------------------------------


def _hashes(turn_id: Column, at: Column) -> tuple[Column, Column]:
    return F.xxhash64(turn_id, at), F.xxhash64(F.lit("second"), turn_id, at)


def _slot(at: Column) -> Column:
    return at % WIDTH + 1


def blocks_of(turns: DataFrame) -> DataFrame:
    """conv_id, block, k0 and k1 (name of the node before the block), t1, t2, ..., and o0, o1 (the block's own part of
    the name). Every conversation has a block 0."""
    slots = [F.max(F.when(_slot(F.col("at")) == slot, F.col("turn_id"))).alias(f"t{slot}") for slot in _SLOTS]
    block = F.coalesce(F.floor(F.col("at") / WIDTH), F.lit(0)).cast("long").alias("block")
    # the row without a position has no part in the name
    hashed = turns.select("conv_id", block, "at", "turn_id")
    own = [F.bit_xor(F.when(F.col("at").isNotNull(), value)) for value in _hashes(F.col("turn_id"), F.col("at"))]
    own = [F.coalesce(value, F.lit(0).cast("long")).alias(f"o{at}") for at, value in enumerate(own)]
    blocks = settled(hashed.groupBy("conv_id", "block").agg(*slots, *own), "trie-blocks")
    return along(blocks, {"k0": ("o0", F.bit_xor), "k1": ("o1", F.bit_xor)}, last_first=False)


def along(blocks: DataFrame, columns: dict[str, tuple], last_first: bool) -> DataFrame:
    """``blocks`` with new ``columns`` {name: (column, aggregate)}: the aggregate over the blocks of the conversation
    before this one (``last_first``: after it), 0 if there are none.

    Conversations of many blocks are added up in ranges first.
    """
    order = lambda name: F.col(name).desc() if last_first else F.col(name)
    zero = F.lit(0).cast("long")
    blocks = blocks.withColumn("_range", F.floor(F.col("block") / BLOCKS))
    inside = Window.partitionBy("conv_id", "_range").orderBy(order("block")).rowsBetween(Window.unboundedPreceding, -1)
    ranges = Window.partitionBy("conv_id").orderBy(order("_range")).rowsBetween(Window.unboundedPreceding, -1)
    long = blocks.where("_range = 1 AND block % {n} = 0".format(n=BLOCKS)).select("conv_id")
    totals = blocks.join(long, "conv_id", "left_semi").groupBy("conv_id", "_range")
    totals = totals.agg(*(how(column).alias(f"_{name}") for name, (column, how) in columns.items()))
    starts = totals.select(
        "conv_id", "_range", *(F.coalesce(how(f"_{name}").over(ranges), zero).alias(f"_{name}") for name, (_, how) in columns.items())
    )
    here = blocks.withColumns({name: F.coalesce(how(column).over(inside), zero) for name, (column, how) in columns.items()})
    joined = here.join(settled(starts, "trie-starts"), ["conv_id", "_range"], "left")
    for name, (_, how) in columns.items():
        add = (lambda a, b: a.bitwiseXOR(b)) if how is F.bit_xor else (lambda a, b: a + b)
        joined = joined.withColumn(name, add(F.col(name), F.coalesce(f"_{name}", zero)))
    return joined.drop("_range", *(f"_{name}" for name in columns))


def roll_up(blocks: DataFrame, sums: dict[str, str]) -> DataFrame:
    """depth, k0, k1, p0, p1 (names of the node and of its parent), last (turn id) and ``sums`` {name: SQL aggregate} of
    every node that ``blocks`` pass. {level} in an aggregate is the node's depth within the block."""
    slots = ", ".join(f"t{slot}" for slot in _SLOTS)
    many = {name: f"CASE level {' '.join(f'WHEN {level} THEN {name}_{level}' for level in range(WIDTH + 1))} END"
            for name, how in sums.items() if "{level}" in how}
    aggregates = [
        f"{how.format(level=level)} AS {name}_{level}" if name in many else f"{how} AS {name}"
        for name, how in sums.items() for level in (range(WIDTH + 1) if name in many else (0,))
    ]
    rolled = blocks.sparkSession.sql(
        f"SELECT block, k0, k1, {slots}, {WIDTH} - bit_count(grouping_id()) AS level, {', '.join(aggregates)} "
        f"FROM {{blocks}} GROUP BY block, k0, k1, ROLLUP ({slots})",
        blocks=blocks,
    )
    # a prefix that goes on beyond the end of the conversation is none; where a block begins, the one before ends
    last = F.element_at(F.array(*(F.col(f"t{slot}") for slot in _SLOTS)), F.greatest("level", F.lit(1)))
    rolled = rolled.withColumn("last", last).where("CASE WHEN level = 0 THEN block = 0 ELSE last IS NOT NULL END")
    at = F.col("block") * WIDTH
    names = {}
    for part in (0, 1):
        node = parent = F.col(f"k{part}")
        for slot in _SLOTS:
            value = _hashes(F.col(f"t{slot}"), at + (slot - 1))[part]
            node = node.bitwiseXOR(F.when(F.col("level") >= slot, value).otherwise(F.lit(0).cast("long")))
            parent = parent.bitwiseXOR(F.when(F.col("level") > slot, value).otherwise(F.lit(0).cast("long")))
        names |= {f"_k{part}": node, f"p{part}": parent}
    rolled = rolled.withColumns(names)
    return rolled.select(
        (at + F.col("level")).cast("long").alias("depth"), F.col("_k0").alias("k0"), F.col("_k1").alias("k1"), "p0", "p1",
        F.when(F.col("level") > 0, F.col("last")).alias("last"),
        *(F.expr(many[name]).alias(name) if name in many else F.col(name) for name in sums),
    )


# ---- nodes --------------------------------------------------------------------------------------------------------


def prefix_trie(turns: DataFrame) -> DataFrame:
    """A row per node of the trie of ``turns`` (conv_id, at, turn_id; at NULL: the conversation exists): conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    blocks = settled(blocks_of(turns), "trie-paths")
    nodes = roll_up(blocks.drop("o0", "o1"), {"conv_id": "min(conv_id)", "n_convs": "count(1)"})
    nodes = settled(nodes.withColumn("bytes", F.coalesce(text_bytes(F.col("last")), F.lit(0))).drop("last"), "trie-nodes")
    children = nodes.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("p0").alias("k0"), F.col("p1").alias("k1")
    ).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = settled(nodes.join(children, _KEY, "left").fillna(0, ["n_children"]), "trie-children")
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("k0").alias("p0"), F.col("k1").alias("p1"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    ends = blocks.groupBy("conv_id").agg(
        F.sum(sum(F.col(f"t{slot}").isNotNull().cast("long") for slot in _SLOTS)).alias("depth"),
        F.bit_xor("o0").alias("k0"), F.bit_xor("o1").alias("k1"),
    )
    found = (
        nodes.join(_subtrees(blocks, nodes), _KEY)
        .join(member_digests(settled(ends, "trie-ends")), _KEY, "left")
        .join(parents, ["depth", "p0", "p1"], "left")
    )
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def _subtrees(blocks: DataFrame, nodes: DataFrame) -> DataFrame:
    """n_leaves and saved_tokens of every node: what each node adds is laid on the blocks of its smallest member."""
    depth = F.greatest(F.col("depth") - 1, F.lit(0))  # the root counts to the first block, but has no text
    saved = [
        F.sum(F.when((F.col("depth") > 0) & (_slot(depth) == slot), (F.col("n_convs") - 1) * F.col("bytes"))).alias(f"v{slot}")
        for slot in _SLOTS
    ]
    values = nodes.groupBy("conv_id", F.floor(depth / WIDTH).alias("block")).agg(
        *saved, F.sum((F.col("n_children") == 0).cast("long")).alias("leaves")
    )
    owners = nodes.select("conv_id").distinct()
    rows = blocks.drop("o0", "o1").join(owners, "conv_id", "left_semi").join(values, ["conv_id", "block"], "left")
    rows = rows.fillna(0, [*(f"v{slot}" for slot in _SLOTS), "leaves"])
    rows = settled(rows.withColumn("own", sum(F.col(f"v{slot}") for slot in _SLOTS)), "trie-values")
    rows = along(rows, {"later": ("own", F.sum), "leaves_later": ("leaves", F.sum)}, last_first=True)
    # from each level of the block to the end of the conversation
    rest = {f"s{level}": F.col("later") + sum(F.col(f"v{slot}") for slot in _SLOTS if slot >= max(level, 1)) for level in range(WIDTH + 1)}
    rows = rows.withColumns(rest | {"leaves": F.col("leaves") + F.col("leaves_later")})
    return roll_up(rows, {"n_leaves": "sum(leaves)", "saved_tokens": "sum(s{level})"}).drop("p0", "p1", "last")


def member_digests(ends: DataFrame) -> DataFrame:
    """depth, k0, k1 and ends_sha256 of every node of ``ends`` (depth, k0, k1, conv_id): the SHA-256 of its members' ids,
    ascending, joined by commas.

    Sorted ranges of all ids are joined to pieces in many tasks; the pieces of a node are then digested in their order,
    one batch at a time.
    """
    order = [*_KEY, "conv_id"]
    names = [*_KEY, "first", "piece"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            rows = zip(*(batch.column(name).to_pylist() for name in order), strict=True)
            for key, members in groupby(rows, key=lambda row: row[:3]):
                ids = [row[3] for row in members]
                for at in range(0, len(ids), PIECE):
                    made.append((*key, ids[at], ",".join(map(str, ids[at : at + PIECE]))))
            if made:
                yield pa.RecordBatch.from_arrays([*map(pa.array, zip(*made))], names=names)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for *own, _, piece in zip(*(batch.column(name).to_pylist() for name in names), strict=True):
                if own != key:
                    if key:
                        done.append((*key, state.hexdigest()))
                    key, state = own, hashlib.sha256(piece.encode())
                else:
                    state.update(b"," + piece.encode())
            if done:
                yield pa.RecordBatch.from_arrays([*map(pa.array, zip(*done))], names=[*_KEY, "ends_sha256"])
        if key:
            yield pa.RecordBatch.from_arrays([*map(pa.array, zip((*key, state.hexdigest())))], names=[*_KEY, "ends_sha256"])

    schema = "depth long, k0 long, k1 long"
    ordered = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    joined = ordered.mapInArrow(pieces, f"{schema}, first long, piece string")
    sorted_pieces = joined.repartition(*_KEY).sortWithinPartitions(*_KEY, "first")
    return sorted_pieces.mapInArrow(digests, f"{schema}, ends_sha256 string")
