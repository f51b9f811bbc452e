"""Shards of nearly equal bytes by Karmarkar-Karp differencing, as a distributed reduction tree.

Rows with equal texts form one indivisible group. The groups are dealt by hash into bundles of bounded size; in each
bundle the multi-way differencing method keeps the two partial partitions with the largest spread on top of a heap and
merges them oppositely ordered (the fullest part of one meets the emptiest of the other) until one partition of the
bundle is left. The bundles' partitions are then partial partitions themselves and are merged by the same rule,
``FAN_IN`` at a time, level after level, until one is left. A task never holds more than a bundle or ``FAN_IN``
partitions, and only sizes and part numbers travel: texts stay where they are.

Defined results: a NULL text has size 1 and forms one group with the other NULL texts; an empty text likewise, apart
from the NULLs; repeated rows take a slot each; no documents give no rows; with fewer groups than shards some shards
stay empty. A group that is larger than a shard's fair share is not split: its shard is as large as the group.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repolume.llm.common import settled

BUNDLE = 4096  # groups that one task differences
FAN_IN = 256  # partial partitions that one task merges
ROWS_PER_SLOT_RANGE = 100_000


def difference(partitions: Sequence[Sequence[int]]) -> list[list[int]]:
    """Merge partial partitions (each: the sizes of its parts) into one.

    Returns for each partition the part of the result that each of its parts went to.
    """
    width = len(partitions[0]) if partitions else 0
    # a heap entry: -spread, age, sizes ascending, and for each part the (partition, part) pairs it holds, as a tree
    heap = []
    for at, sizes in enumerate(partitions):
        order = sorted(range(width), key=lambda part: (sizes[part], part))
        ranked = [sizes[part] for part in order]
        heap.append((ranked[0] - ranked[-1], at, ranked, [(at, part) for part in order]))
    heapq.heapify(heap)
    age = len(heap)
    while len(heap) > 1:
        _, _, sizes, holds = heapq.heappop(heap)
        _, _, others, more = heapq.heappop(heap)
        merged = sorted(
            ((size + other, (hold, another)) for size, other, hold, another in
             zip(sizes, reversed(others), holds, reversed(more), strict=True)),
            key=lambda pair: pair[0],
        )
        ranked = [pair[0] for pair in merged]
        heapq.heappush(heap, (ranked[0] - ranked[-1], age, ranked, [pair[1] for pair in merged]))
        age += 1
    went = [[0] * width for _ in partitions]
    for part, tree in enumerate(heap[0][3] if heap else []):
        open_nodes = [tree]
        while open_nodes:
            left, right = open_nodes.pop()
            if isinstance(left, tuple):
                open_nodes += (left, right)
            else:
                went[left][right] = part
    return went


def _bundles(shards: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def pack(groups: pd.DataFrame) -> pd.DataFrame:
        groups = groups.sort_values("text_key", kind="stable")
        went = difference([[0] * (shards - 1) + [int(size)] for size in groups["bytes"]])
        return groups.assign(part=np.array([parts[-1] for parts in went], dtype="int32"))[
            ["text_key", "node", "part", "bytes"]
        ]

    return pack


def _merge(shards: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def merge(parts: pd.DataFrame) -> pd.DataFrame:
        sizes = parts.pivot(index="node", columns="part", values="bytes").reindex(columns=range(shards)).fillna(0)
        went = difference(sizes.astype("int64").to_numpy().tolist())
        return pd.DataFrame(
            {
                "node": np.repeat(sizes.index.to_numpy(), shards),
                "part": np.tile(np.arange(shards, dtype="int32"), len(sizes)),
                "parent": int(parts["parent"].iloc[0]),
                "parent_part": np.array(went, dtype="int32").reshape(-1),
            }
        )

    return merge


def pack_groups(groups: DataFrame, shards: int, bundle: int = BUNDLE, fan_in: int = FAN_IN) -> DataFrame:
    """text_key and shard of every group (text_key, bytes; the key is unique)."""
    groups = settled(groups, "sharding-groups")
    nodes = max(1, math.ceil(groups.count() / bundle))
    key = groups.schema["text_key"].dataType.simpleString()
    packed = settled(
        groups.withColumn("node", F.pmod(F.xxhash64("text_key"), F.lit(nodes)))
        .groupBy("node")
        .applyInPandas(_bundles(shards), f"text_key {key}, node long, part int, bytes long"),
        "sharding-bundles",
    )
    parts = settled(packed.groupBy("node", "part").agg(F.sum("bytes").alias("bytes")), "sharding-parts")
    # home: which part of the current level each part of a bundle has become
    home = parts.select(
        F.col("node").alias("bundle"), F.col("part").alias("bundle_part"), "node", F.col("part").alias("shard")
    )
    while nodes > 1:
        nodes = math.ceil(nodes / fan_in)
        merged = settled(
            parts.withColumn("parent", F.floor(F.col("node") / fan_in))
            .groupBy("parent")
            .applyInPandas(_merge(shards), "node long, part int, parent long, parent_part int"),
            "sharding-merged",
        )
        step = merged.select("node", F.col("part").alias("shard"), "parent", "parent_part")
        home = settled(
            home.join(step, ["node", "shard"]).select(
                "bundle", "bundle_part", F.col("parent").alias("node"), F.col("parent_part").alias("shard")
            ),
            "sharding-home",
        )
        parts = settled(
            parts.join(merged, ["node", "part"])
            .groupBy(F.col("parent").alias("node"), F.col("parent_part").alias("part"))
            .agg(F.sum("bytes").alias("bytes")),
            "sharding-parts",
        )
    places = home.select(F.col("bundle").alias("node"), F.col("bundle_part").alias("part"), "shard")
    return packed.join(places, ["node", "part"]).select("text_key", "shard")


def with_slots(rows: DataFrame, per_range: int = ROWS_PER_SLOT_RANGE) -> DataFrame:
    """``rows`` (doc_id, shard and others) with a gapless ``slot`` from 0 in each shard.

    Rows are numbered in hash ranges of their id; each range starts where the counts of the earlier ones end, so a
    shard of any size is numbered by many tasks.
    """
    ranges = max(1, math.ceil(rows.count() / per_range))
    ranged = rows.withColumn("_range", F.pmod(F.xxhash64("doc_id"), F.lit(ranges)))
    earlier = Window.partitionBy("shard").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("shard", "_range")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("shard", "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy("shard", "_range").orderBy("doc_id", "size", "text_crc32")
    numbered = ranged.withColumn("_at", F.row_number().over(inside) - 1)
    return (
        numbered.join(starts, ["shard", "_range"])
        .withColumn("slot", F.col("_start") + F.col("_at"))
        .drop("_range", "_start", "_at")
    )


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row of ``docs`` (doc_id, text)."""
    sized = settled(
        docs.select(
            "doc_id",
            (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
            F.coalesce(F.unhex(F.sha2("text", 256)), F.lit(b"")).alias("text_key"),
        ),
        "sharding-sizes",
    )
    groups = sized.groupBy("text_key").agg(F.sum("size").alias("bytes"))
    placed = settled(
        sized.join(pack_groups(groups, shards), "text_key").select("doc_id", "size", "text_crc32", "shard"),
        "sharding-placed",
    )
    return with_slots(placed)
