"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are its distinct words, pairs of neighbours and pairs with one word between, hashed to ``DIMS``
coordinates. Every coordinate has its own learning rate; the L1 term keeps coordinates at exactly 0 until the evidence
for them exceeds it, so the learned weights are few and travel to every task as two short arrays.

Defined results: a NULL or empty text has no features, its score is that of the intercept; repeated rows are scored
alike; an id with contradicting labels counts as toxic; without labels every score is close to 0; no documents give no rows. Other columns are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repolume.llm.common import hash_words, learns, mix, settled, slices, texts_of
from repolume.llm.fitting import PIECE, State, labelled_sample, mixed_pieces, sigmoid

BITS = 20
DIMS = 1 << BITS
ALPHA, BETA, L1, L2 = 1.0, 1.0, 8.0, 0.0
ROUNDS, PASSES = 2, 3
SAMPLE = 12_000  # labelled documents that are learned from at most, smallest hash of the id first
THRESHOLD = 0.3
UNSURE = 20.0  # without labels nothing is called toxic
MODULUS, HELD_OUT = 4, 2

# lower case for A-Z; punctuation separates words
_FOLD = bytes.maketrans(
    (string.ascii_uppercase + string.punctuation).encode(),
    (string.ascii_lowercase + " " * len(string.punctuation)).encode(),
)


def occurrences(text: str) -> np.ndarray:
    """The coordinates of a text's features as often as they occur."""
    hashes = hash_words(text.encode("utf-8", "surrogatepass").translate(_FOLD).split())
    grams = [mix(hashes)]
    if len(hashes) > 1:
        grams.append(mix(hashes[:-1] * np.uint64(3) + hashes[1:] * np.uint64(5)))
    if len(hashes) > 2:
        grams.append(mix(hashes[:-2] * np.uint64(7) + hashes[2:] * np.uint64(11)))
    return (np.concatenate(grams) >> np.uint64(64 - BITS)).astype(np.int64)


def coordinates(text: str) -> np.ndarray:
    """The distinct coordinates of a text's features; the last of all, ``DIMS``, is the intercept."""
    return np.append(np.unique(occurrences(text)), DIMS)


class Scorer:
    """The score of a text by a model: its coordinates and weights, without the zeros."""

    def __init__(self, model: tuple[np.ndarray, np.ndarray]) -> None:
        self.dense = np.zeros(DIMS + 1)
        self.dense[model[0]] = model[1]

    def __call__(self, text: str) -> float:
        weighty = (at := occurrences(text))[self.dense[at] != 0.0]
        return float(sigmoid(self.dense[np.unique(weighty)].sum() + self.dense[DIMS]))


def weights_at(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The weights that the state (sums z, squared gradients n) stands for."""
    beyond = np.sign(z) * np.maximum(np.abs(z) - L1, 0.0)
    return -beyond / ((BETA + np.sqrt(n)) / ALPHA + L2)


def learn(rows: pd.DataFrame, state: State, turn: int) -> State:
    """FTRL-proximal passes over one shard's samples."""
    z, n = state
    samples = [(np.asarray(at), float(label)) for at, label in zip(rows["at"], rows["label"], strict=True)]
    order = np.random.default_rng(1000 * turn + int(rows["shard"].iloc[0]))
    for _ in range(PASSES):
        for pick in order.permutation(len(samples)):
            at, label = samples[pick]
            squared = n[at]
            weight = weights_at(z[at], squared)
            gradient = sigmoid(weight.sum()) - label
            grown = squared + gradient * gradient
            z[at] += gradient - (np.sqrt(grown) - np.sqrt(squared)) / ALPHA * weight
            n[at] = grown
    return [z, n]


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates and weights of the fitted model, without the zeros."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [coordinates(text).astype(np.int32) for text in texts_of(batch)]
            columns = [*batch.select(["shard", "place", "label"]).columns, pa.array(found, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["shard", "place", "label", "at"])

    sample = labelled_sample(docs, labels, "toxic", MODULUS, HELD_OUT, SAMPLE)
    sample = settled(sample.mapInArrow(hashed, "shard int, place long, label int, at array<int>"), "toxicity-sample")
    if sample.isEmpty():
        return np.array([DIMS]), np.array([-UNSURE])
    pieces = mixed_pieces(sample, learn_pairs, [np.zeros((DIMS + 1, 2), dtype="<f4")], ROUNDS)
    found = [] if pieces is None else pieces.mapInArrow(nonzero, "piece int, at binary, weight binary").collect()
    found.sort(key=lambda row: row["piece"])
    at = np.frombuffer(b"".join(row["at"] for row in found), dtype="<i8")
    return at, np.frombuffer(b"".join(row["weight"] for row in found), dtype="<f8")


def learn_pairs(rows: pd.DataFrame, state: State, turn: int) -> State:
    """``learn`` with the sum and the squared gradients of a coordinate side by side, so that they lie in one piece."""
    return [np.stack(learn(rows, [part.copy() for part in state[0].T], turn), axis=1)]


def nonzero(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Coordinates and weights that are not zero, of each piece of a state of pairs."""
    for batch in batches:
        for row in batch.to_pylist():
            z, n = np.frombuffer(row["state"], dtype="<f4").astype(float).reshape(-1, 2).T
            at = np.flatnonzero(np.abs(z) > L1)
            columns = [[row["piece"]], [(at + row["piece"] * (PIECE // 2)).astype("<i8").tobytes()], [weights_at(z[at], n[at]).tobytes()]]
            types = (pa.int32(), pa.binary(), pa.binary())
            columns = [pa.array(column, kind) for column, kind in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["piece", "at", "weight"])


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """doc_id and score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score_of = Scorer(shared.value)
        for batch in batches:
            scores = [score_of(text) for text in texts_of(batch)]
            columns = [batch.column("doc_id"), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted (score of at least ``THRESHOLD``) of every document."""
    return score(docs, fit(docs, labels)).select(
        "doc_id", (~learns(F.col("doc_id"), MODULUS, HELD_OUT)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted to be toxic, with all their columns and rows; scored where they lie."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score_of = Scorer(shared.value)
        for batch in slices(batches):
            clean = [score_of(text) < THRESHOLD for text in texts_of(batch)]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
