"""Quality by attention-based multiple-instance learning.

A document is a bag of passages, runs of ``PASSAGE_WORDS`` words with the white space between them. Every passage is
encoded: its shares of byte classes and hashed byte pairs, how often its words and the document's lines repeat, and its
word lengths pass through a learned layer. A gated attention, learned from labels of whole documents only, weighs the
passages; the weighted sum is the document's representation, which is scored. (The model is that of Ilse, Tomczak and
Welling, "Attention-based Deep Multiple Instance Learning", 2018.)

Defined results: a NULL or empty text is one passage without words; a very long text has as many passages as it
needs; repeated rows are scored alike; without labels every score is that of the untrained model; no documents give no
rows. Other columns are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repolume.llm.common import learns, settled, texts_of
from repolume.llm.fitting import State, labelled_sample, mixed, sigmoid

PASSAGE_WORDS = 64
PAIRS = 32  # hashed classes of byte pairs
HIDDEN, GATE = 24, 12
ROUNDS, PASSES, BATCH, RATE = 4, 4, 32, 0.01
THRESHOLD = 0.5
MODULUS, HELD_OUT = 3, 1

_GROUPS = (
    "aeiou", "bcdfghjklmnpqrstvwxyz", "AEIOU", "BCDFGHJKLMNPQRSTVWXYZ", string.digits, " \t\x0b\x0c\r", "\n", ".", ",",
    "!", "?", "#", "*", "$", "%", "&", "|", "<>", "@", "/\\", "'\"`", "()[]{}", "-_=+~", ":;",
)
CLASSES = len(_GROUPS) + 2  # and bytes of multi-byte characters, and control bytes
_CLASS = np.full(256, len(_GROUPS) + 1, dtype=np.int64)
_CLASS[128:] = len(_GROUPS)
for _at, _group in enumerate(_GROUPS):
    _CLASS[np.frombuffer(_group.encode(), dtype=np.uint8)] = _at
_IS_WHITE = np.zeros(256, dtype=bool)
_IS_WHITE[[9, 10, 11, 12, 13, 32]] = True
FEATURES = CLASSES + PAIRS + 5


def passages(text: str) -> np.ndarray:
    """One row of ``FEATURES`` numbers for every passage."""
    raw = text.encode("utf-8", "surrogatepass") or b" "
    data = np.frombuffer(raw, dtype=np.uint8)
    white = _IS_WHITE[data]
    starts = np.flatnonzero(~white & np.concatenate(([True], white[:-1])))
    firsts = starts[::PASSAGE_WORDS].copy()
    if len(firsts) == 0:
        firsts = np.zeros(1, dtype=np.int64)
    firsts[0] = 0
    count = len(firsts)
    lengths = np.diff(np.append(firsts, len(data)))
    owner = np.repeat(np.arange(count), lengths)
    classes = np.bincount(owner * CLASSES + _CLASS[data], minlength=count * CLASSES).reshape(count, CLASSES)
    pair = (data[:-1].astype(np.int64) * 31 + data[1:] * 17) % PAIRS
    pairs = np.bincount(owner[:-1] * PAIRS + pair, minlength=count * PAIRS).reshape(count, PAIRS)
    words = raw.split()
    ids: dict[bytes, int] = {}
    numbers = np.fromiter((ids.setdefault(word, len(ids)) for word in words), dtype=np.int64, count=len(words))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    extra = np.zeros((count, 5))
    if words:
        belongs = np.arange(len(words)) // PASSAGE_WORDS
        n_words = np.bincount(belongs, minlength=count)
        often = np.bincount(numbers)[numbers] > 1
        follows = np.zeros(len(words), dtype=bool)
        if len(words) > 1:
            runs = numbers[:-1] * len(ids) + numbers[1:]
            follows[:-1] = pd.Series(runs).duplicated(keep=False).to_numpy()
        extra[:, 0] = np.bincount(belongs, often, minlength=count) / n_words
        extra[:, 1] = np.bincount(belongs, follows, minlength=count) / n_words
        extra[:, 2] = np.minimum(lengths / n_words / 16.0, 4.0)
        extra[:, 3] = min(len(words), 2000) / 2000.0
        extra[:, 4] = 1.0 - len(set(lines)) / len(lines)
    whole = lengths[:, None]
    return np.hstack([np.sqrt(classes / whole), np.sqrt(pairs / whole), extra]).astype(np.float32)


def untrained() -> State:
    """Encoder, gate (tanh and sigmoid), attention and output layers, each with its intercepts as the last row."""
    draw = np.random.default_rng(5)
    layer = lambda into, out: np.vstack([draw.normal(0, into**-0.5, (into, out)), np.zeros((1, out))])
    return [layer(FEATURES, HIDDEN), layer(HIDDEN, GATE), layer(HIDDEN, GATE), layer(GATE, 1), layer(HIDDEN, 1)]


def _apply(layer: np.ndarray, x: np.ndarray) -> np.ndarray:
    return x @ layer[:-1] + layer[-1]


def forward(state: State, x: np.ndarray, starts: np.ndarray):
    """Logits of the bags that begin at ``starts`` in the passages ``x``, and what the gradients need."""
    encoder, tanh_gate, sigmoid_gate, attention, output = state
    encoded = np.tanh(_apply(encoder, x))
    left, right = np.tanh(_apply(tanh_gate, encoded)), sigmoid(_apply(sigmoid_gate, encoded))
    raw = _apply(attention, left * right)[:, 0]
    owner = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(x))))
    lifted = np.exp(raw - np.maximum.reduceat(raw, starts)[owner])
    share = lifted / np.add.reduceat(lifted, starts)[owner]
    bags = np.add.reduceat(encoded * share[:, None], starts, axis=0)
    return _apply(output, bags)[:, 0], (encoded, left, right, share, bags, owner)


def gradients(state: State, x: np.ndarray, starts: np.ndarray, labels: np.ndarray) -> State:
    """Gradients of the mean logistic loss of the bags."""
    _, tanh_gate, sigmoid_gate, attention, output = state
    logits, (encoded, left, right, share, bags, owner) = forward(state, x, starts)
    slope = ((sigmoid(logits) - labels) / len(labels))[:, None]
    back = lambda given, over: np.vstack([given.T @ over, over.sum(axis=0, keepdims=True)])
    d_bags = slope @ output[:-1].T
    d_encoded = d_bags[owner] * share[:, None]
    d_share = (d_bags[owner] * encoded).sum(axis=1)
    d_raw = (share * (d_share - np.add.reduceat(share * d_share, starts)[owner]))[:, None]
    d_gate = d_raw @ attention[:-1].T
    d_left, d_right = d_gate * right * (1 - left**2), d_gate * left * right * (1 - right)
    d_encoded = d_encoded + d_left @ tanh_gate[:-1].T + d_right @ sigmoid_gate[:-1].T
    return [
        back(x, d_encoded * (1 - encoded**2)), back(encoded, d_left), back(encoded, d_right),
        back(left * right, d_raw), back(bags, slope),
    ]


def learn(rows: pd.DataFrame, state: State, turn: int) -> State:
    """Passes of Adam over one shard's documents."""
    bags = [np.frombuffer(raw, dtype="<f4").reshape(-1, FEATURES) for raw in rows["passages"]]
    labels = rows["label"].to_numpy(dtype=float)
    first, second = [np.zeros_like(part) for part in state], [np.zeros_like(part) for part in state]
    order = np.random.default_rng(1000 * turn + int(rows["shard"].iloc[0]))
    step = 0
    for _ in range(PASSES):
        shuffled = order.permutation(len(bags))
        for begin in range(0, len(bags), BATCH):
            picks = shuffled[begin : begin + BATCH]
            chosen = [bags[pick] for pick in picks]
            starts = np.concatenate(([0], np.cumsum([len(bag) for bag in chosen])[:-1]))
            step += 1
            for at, part in enumerate(gradients(state, np.concatenate(chosen), starts, labels[picks])):
                first[at] = 0.9 * first[at] + 0.1 * part
                second[at] = 0.99 * second[at] + 0.01 * part**2
                rate = RATE / (1 + turn) * (1 - 0.99**step) ** 0.5 / (1 - 0.9**step)
                state[at] = state[at] - rate * first[at] / (np.sqrt(second[at]) + 1e-8)
    return state


def fit(docs: DataFrame, labels: DataFrame) -> State:
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [passages(text).astype("<f4").tobytes() for text in texts_of(batch)]
            columns = [*batch.select(["shard", "place", "label"]).columns, pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["shard", "place", "label", "passages"])

    sample = labelled_sample(docs, labels, "quality", MODULUS, HELD_OUT)
    sample = settled(sample.mapInArrow(encoded, "shard int, place long, label int, passages binary"), "quality-sample")
    return mixed(sample, learn, untrained(), ROUNDS)


def score(docs: DataFrame, state: State) -> DataFrame:
    """doc_id, score and n_passages of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(state)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = np.zeros(1, dtype=np.int64)
        for batch in batches:
            scores, counts = [], []
            for text in texts_of(batch):
                x = passages(text)
                scores.append(float(sigmoid(forward(shared.value, x, start)[0][0])))
                counts.append(len(x))
            columns = [batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "n_passages"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, n_passages long")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted (score of at least ``THRESHOLD``) and n_passages of every document."""
    return score(docs, fit(docs, labels)).select(
        "doc_id", (~learns(F.col("doc_id"), MODULUS, HELD_OUT)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_passages",
    )
