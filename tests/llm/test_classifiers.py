import random
import zlib

import numpy as np
import pandas as pd
import pytest

from repolume.llm import fitting, quality_mil, toxicity
from tests.conftest import rows

BAD = ("zorgh", "blathk", "vrumpf")


def word(draw):
    return "".join(draw.choice("aeioubcdlmnrst") for _ in range(draw.randint(2, 8)))


@pytest.fixture(scope="module")
def toxic_texts():
    draw = random.Random(9)
    texts = []
    for i in range(1500):
        words = [word(draw) for _ in range(draw.randint(5, 80))]
        if i % 4 == 0:
            words[draw.randrange(len(words))] = draw.choice(BAD)
            words.append(draw.choice(BAD) + ".")
        texts.append((i, " ".join(words), i % 4 == 0))
    return texts


EXTRA = ((9000, None), (9001, ""), (9002, "harmless words " * 50_000 + "Zorgh! blathk vrumpf"), (9003, "just words"), (9003, "just words"), (None, "zorgh"))


def test_toxic_held_out_documents_are_found(documents, labels, toxic_texts):
    docs = documents(*[(i, text) for i, text, _ in toxic_texts], *EXTRA)
    marks = labels(*[(i, None, int(toxic)) for i, _, toxic in toxic_texts], (None, 1, 1), (77, 1, None))
    found = toxicity.toxicity(docs, marks)
    got = {row["doc_id"]: row for row in found.collect()}
    held = [i for i, *_ in toxic_texts if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i]["held_out"] == (i in set(held)) for i, *_ in toxic_texts)
    right = sum(got[i]["predicted"] == (i % 4 == 0) for i in held)
    assert right >= 0.97 * len(held)
    assert got[9002]["predicted"] == 1 and got[9000]["score"] == got[9001]["score"] < 0.3
    assert all(0 <= row["score"] <= 1 and row["predicted"] == (row["score"] >= 0.3) for row in got.values())
    assert len(found.collect()) == docs.count()
    kept = toxicity.drop_toxic(docs, marks)
    assert kept.columns == docs.columns
    assert rows(kept, "doc_id") == rows(found.where("predicted = 0"), "doc_id")


def plain_ftrl(samples, dims):
    """FTRL-proximal coordinate by coordinate, as the update is written in the paper."""
    z, n = [0.0] * dims, [0.0] * dims

    def weight(i):
        if abs(z[i]) <= toxicity.L1:
            return 0.0
        return -(z[i] - np.sign(z[i]) * toxicity.L1) / ((toxicity.BETA + n[i] ** 0.5) / toxicity.ALPHA + toxicity.L2)

    for at, label in samples:
        old = {i: weight(i) for i in at}
        gradient = 1 / (1 + np.exp(-sum(old.values()))) - label
        for i in at:
            sigma = ((n[i] + gradient**2) ** 0.5 - n[i] ** 0.5) / toxicity.ALPHA
            z[i] += gradient - sigma * old[i]
            n[i] += gradient**2
    return z, n


def test_learning_is_ftrl_proximal():
    draw = np.random.default_rng(2)
    samples = [(np.flatnonzero(draw.random(40) < 0.3), int(draw.random() < 0.5)) for _ in range(300)]
    table = pd.DataFrame({"at": [at for at, _ in samples], "label": [label for _, label in samples], "shard": 0})
    z, n = toxicity.learn(table, [np.zeros(40), np.zeros(40)], 0)
    order = np.random.default_rng(0)
    picks = [pick for _ in range(toxicity.PASSES) for pick in order.permutation(len(samples))]
    plain = plain_ftrl([samples[pick] for pick in picks], 40)
    assert np.allclose(z, plain[0]) and np.allclose(n, plain[1]) and (toxicity.weights_at(z, n) != 0).any()


def test_models_do_not_depend_on_the_order_of_rows(documents, labels, toxic_texts):
    texts = [(i, text) for i, text, _ in toxic_texts[:600]] + [(5, "another zorgh text"), (5, "and one more")]
    marks = [(i, int(not toxic), int(toxic)) for i, _, toxic in toxic_texts[:600]] + [(8, 0, 0), (8, 1, 1)]
    one = documents(*texts), labels(*marks)
    other = documents(*texts[::-1]).repartition(7, "text"), labels(*marks[::-1]).repartition(5)
    for module in (toxicity, quality_mil):
        assert all(np.array_equal(a, b) for a, b in zip(module.fit(*one), module.fit(*other), strict=True))


def test_the_weights_are_few(documents, labels, toxic_texts):
    docs = documents(*[(i, text) for i, text, _ in toxic_texts])
    at, weight = toxicity.fit(docs, labels(*[(i, None, int(toxic)) for i, _, toxic in toxic_texts]))
    assert 0 < len(at) < 5000 and np.all(weight != 0)


def test_without_labels_or_documents(documents, labels):
    docs, none = documents((1, "zorgh"), (2, None)), labels((1, 1, 1)).where("false")
    assert {row["predicted"] for row in toxicity.toxicity(docs, none).collect()} == {0}
    assert toxicity.drop_toxic(docs, none).count() == 2
    assert quality_mil.quality(docs, none).count() == 2
    assert toxicity.toxicity(docs.where("false"), none).count() == 0 and quality_mil.quality(docs.where("false"), none).count() == 0


def test_gradients_are_those_of_finite_differences():
    draw = np.random.default_rng(1)
    state = quality_mil.untrained()
    x, starts, labels_ = draw.random((9, quality_mil.FEATURES)), np.array([0, 4, 5]), np.array([1.0, 0.0, 1.0])

    def loss(state):
        logits = quality_mil.forward(state, x, starts)[0]
        return np.mean(np.log1p(np.exp(-logits)) * labels_ + np.log1p(np.exp(logits)) * (1 - labels_))

    for layer, found in enumerate(quality_mil.gradients(state, x, starts, labels_)):
        for _ in range(6):
            at = tuple(draw.integers(0, size) for size in state[layer].shape)
            ends = []
            for step in (1e-5, -1e-5):
                moved = [part.copy() for part in state]
                moved[layer][at] += step
                ends.append(loss(moved))
            assert abs((ends[0] - ends[1]) / 2e-5 - found[at]) < 1e-6


def test_passages():
    assert quality_mil.passages("").shape == (1, quality_mil.FEATURES)
    assert quality_mil.passages("  " + "word " * 65).shape == (2, quality_mil.FEATURES)
    long = quality_mil.passages("ä b\n" * 100_000)
    assert long.shape[0] == 3125 and np.isfinite(long).all()


def test_documents_of_poor_passages_are_found(documents, labels):
    draw = random.Random(4)
    texts = []
    for i in range(1200):
        lines = [" ".join(word(draw) for _ in range(12)) for _ in range(draw.randint(2, 15))]
        if i % 3 == 0:  # one bad stretch in the middle
            lines.insert(len(lines) // 2, " ".join(word(draw) + "###" for _ in range(70)))
        texts.append((i, "\n".join(lines)))
    docs = documents(*texts, *EXTRA)
    found = quality_mil.quality(docs, labels(*[(i, int(i % 3 != 0), 0) for i, _ in texts]))
    got = {row["doc_id"]: row for row in found.collect()}
    held = [i for i, _ in texts if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(got[i]["held_out"] == (i in set(held)) for i, _ in texts)
    assert sum(got[i]["predicted"] == (i % 3 != 0) for i in held) >= 0.97 * len(held)
    assert found.count() == docs.count() and all(0 <= row["score"] <= 1 for row in got.values())


def test_states_are_averaged_without_the_driver(spark, monkeypatch):
    """Round by round as one process does it; a shard has no sample, and of the states only the last mean is collected."""
    monkeypatch.setattr(fitting, "PIECE", 4)

    def learn(rows, state, turn):
        by = float(rows["value"].sum()) + turn
        return [state[0] * 1.5 + by, state[1] - by / 3]

    values = {0: [1, 2, 3], 2: [10], 3: [7, 9]}
    samples = spark.createDataFrame([(s, i, v) for s, of in values.items() for i, v in enumerate(of)], "shard int, place long, value int")
    start = [np.arange(6.0).reshape(2, 3), np.ones(5)]
    monkeypatch.setattr("pyspark.sql.DataFrame.toLocalIterator", lambda *_: pytest.fail("states pass the driver"))
    found = fitting.mixed(samples, learn, start, 3)
    state = start
    for turn in range(3):
        learned = [(len(of), learn(pd.DataFrame({"value": of}), state, turn)) for of in values.values()]
        sums = [sum((part[at].astype("<f4") * n).astype(float) for n, part in learned) for at in range(2)]
        state = [(part / 6).astype("<f4").astype(float) for part in sums]
    assert all(np.array_equal(a, b) for a, b in zip(found, state, strict=True))
    assert all(np.array_equal(a, b) for a, b in zip(fitting.mixed(samples.limit(0), learn, start, 3), start, strict=True))


def test_the_driver_gets_no_state_of_toxicity(documents, labels, toxic_texts, monkeypatch):
    """The weights are those of the whole state; only those that are not zero are collected."""
    docs = documents(*[(i, text) for i, text, _ in toxic_texts])
    marks = labels(*[(i, None, int(toxic)) for i, _, toxic in toxic_texts])
    seen = []

    def watched(samples, learn, start, rounds):
        seen.append(fitting.mixed(samples, learn, start, rounds))
        return fitting.mixed_pieces(samples, learn, start, rounds)

    monkeypatch.setattr(toxicity, "mixed_pieces", watched)
    at, weight = toxicity.fit(docs, marks)
    z, n = seen[0][0].T
    dense = toxicity.weights_at(z, n)
    assert np.array_equal(at, np.flatnonzero(dense)) and np.array_equal(weight, dense[at]) and 0 < at.size < toxicity.DIMS / 100
