"""Fit small models by parameter mixing: shards learn side by side from one state, and their states are averaged.

Every shard starts from the same state, passes over its own samples and leaves its state in the shared folder, cut into
pieces; the pieces are averaged by Spark and joined to the shards again, so only the start, and the last mean if it is asked for, pass
the driver, whatever the numbers of samples and rounds. A shard's samples are put in the order of ``place``, a hash of id and text, so a lost task, or
a rerun, repeats its shard from the same state with the same result, in whatever order shuffled blocks arrive.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repolume.llm.common import discard, learns, settled

SHARD_ROWS = 5_000  # samples of one shard
SAMPLE = 20_000  # labelled documents that a model is fitted on at most
PIECE = 1 << 15  # numbers of a state that lie in one row

State = list[np.ndarray]


def labelled_sample(
    docs: DataFrame, labels: DataFrame, column: str, modulus: int, held: int, limit: int = SAMPLE
) -> DataFrame:
    """shard, place, label (0 or 1) and text of at most ``limit`` labelled documents, those with the smallest id hashes.

    Labels come only from rows whose id's crc32 does not leave ``held``; NULL ids and labels are left out. An id with
    contradicting labels counts as 1. Documents that share a labelled id are all samples.
    """
    usable = labels.where(F.col(column).isin(0, 1) & F.col("doc_id").isNotNull() & learns(F.col("doc_id"), modulus, held))
    chosen = usable.groupBy("doc_id").agg(F.max(column).alias("label"))
    chosen = settled(chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit), "labels")
    shards = max(1, math.ceil(chosen.count() / SHARD_ROWS))
    # at most ``limit`` rows of two numbers
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    shard = F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int").alias("shard")
    return joined.select(shard, F.xxhash64("doc_id", "text").alias("place"), "label", "text")


def mixed(
    samples: DataFrame, learn: Callable[[pd.DataFrame, State, int], State], start: State, rounds: int
) -> State:
    """The state after ``rounds`` of ``learn(samples of a shard, state, round)`` on each shard and averaging."""
    pieces = mixed_pieces(samples, learn, start, rounds)
    flat = np.concatenate([part.astype("<f4").ravel() for part in start])
    if pieces is not None:
        found = pd.DataFrame(pieces.collect(), columns=["piece", "state"])
        flat = joined(found["piece"], found["state"])
    ends = np.cumsum([part.size for part in start])[:-1]
    return [part.reshape(old.shape).astype(float) for part, old in zip(np.split(flat, ends), start, strict=True)]


def mixed_pieces(
    samples: DataFrame, learn: Callable[[pd.DataFrame, State, int], State], start: State, rounds: int
) -> DataFrame | None:
    """piece and state: what ``mixed`` returns, as 4-byte numbers one after another, ``PIECE`` in a row; None without
    samples."""
    spark = samples.sparkSession
    state = np.concatenate([part.astype("<f4").ravel() for part in start])
    shapes, ends = [part.shape for part in start], np.cumsum([part.size for part in start])[:-1]
    pieces = math.ceil(state.size / PIECE)
    last = samples.agg(F.max("shard")).first()[0]  # none without samples

    def one_shard(rows: pd.DataFrame, flat: np.ndarray, turn: int) -> pd.DataFrame:
        rows = rows.sort_values("place", kind="stable", ignore_index=True)
        parts = [part.reshape(shape).astype(float) for part, shape in zip(np.split(flat, ends), shapes, strict=True)]
        learned = np.concatenate([part.astype("<f4").ravel() for part in learn(rows, parts, turn)])
        blobs = [learned[at : at + PIECE].tobytes() for at in range(0, learned.size, PIECE)]
        shard, count = int(rows["shard"].iloc[0]), len(rows)
        return pd.DataFrame({"shard": shard, "n": count, "piece": range(len(blobs)), "state": blobs})

    def from_start(shared) -> Callable[[pd.DataFrame], pd.DataFrame]:
        return lambda rows: one_shard(rows, shared.value, 0)

    def from_mean(turn: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
        # a shard may have got no sample
        return lambda rows, mean: one_shard(rows, joined(mean["piece"], mean["state"]), turn) if len(rows) else nothing()

    mean, kind = None, "shard int, n long, piece int, state binary"
    for turn in range(rounds if last is not None else 0):
        if mean is None:
            shared = spark.sparkContext.broadcast(state)
            learned = settled(samples.groupBy("shard").applyInPandas(from_start(shared), kind), "fit-round")
            shared.destroy()
        else:
            shards = F.explode(F.sequence(F.lit(0), F.lit(last))).alias("shard")
            known = mean.select(shards, "piece", "state").groupBy("shard")
            learned = samples.groupBy("shard").cogroup(known).applyInPandas(from_mean(turn), kind)
            learned = settled(learned, "fit-round")
            discard(mean)
        # about a megabyte in a task, so that the last mean is read in small parts
        dealt = learned.repartition(math.ceil(pieces / 8), "piece").groupBy("piece")
        mean = settled(dealt.applyInPandas(averaged, "piece int, state binary"), "fit-mean")
        discard(learned)
    return mean


def nothing() -> pd.DataFrame:
    return pd.DataFrame({"shard": [], "n": [], "piece": [], "state": []})


def averaged(rows: pd.DataFrame) -> pd.DataFrame:
    """One piece of the mean of the shards' states, by their numbers of samples and in the order of the shards."""
    flat = 0.0
    for row in rows.sort_values("shard").itertuples():
        flat = flat + (np.frombuffer(row.state, dtype="<f4") * int(row.n)).astype(float)
    return pd.DataFrame({"piece": [rows["piece"].iloc[0]], "state": [(flat / rows["n"].sum()).astype("<f4").tobytes()]})


def joined(piece: pd.Series, state: pd.Series) -> np.ndarray:
    """The state whose pieces these are, in whatever order."""
    return np.concatenate([np.frombuffer(state.iloc[at], dtype="<f4") for at in np.argsort(piece.to_numpy())])


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))
