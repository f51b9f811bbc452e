import zlib
from collections import defaultdict
from itertools import product

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from repolume.llm import packing
from repolume.llm.packing import cut_document, digests, hilbert, last_cuts, pack, token_ids
from repolume.llm.queries import QUERIES

CONTENT = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
LIBRARY = Tokenizer.from_str(CONTENT)
LIBRARY.encode_special_tokens = True


def encode(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def check(pieces, texts, length=1024):
    """``pieces`` hold every id of ``texts`` ((doc_id, text), ids unique) once, in whole sequences."""
    own, sequences = defaultdict(list), defaultdict(list)
    for row in pieces:
        own[row["doc_id"]].append(row)
        sequences[row["sequence_id"]].append(row)
    assert set(own) == {doc_id for doc_id, _ in texts}
    for doc_id, text in texts:
        ids, at = encode(text), 0
        for row in sorted(own[doc_id], key=lambda row: row["start"]):
            assert row["start"] == at and row["doc_tokens"] == len(ids) and row["length"] > 0
            assert row["ids_crc32"] == crc(ids[at : at + row["length"]])
            at += row["length"]
        assert at == len(ids)
    assert sorted(sequences) == list(range(len(sequences)))
    sizes = []
    for sequence_id in sorted(sequences):
        at = 0
        for row in sorted(sequences[sequence_id], key=lambda row: row["offset"]):
            assert row["offset"] == at
            at += row["length"]
        sizes.append(at)
    whole = sum(sizes) // length
    assert sizes[:whole] == [length] * whole
    assert all(size & (size - 1) == 0 and size < length for size in sizes[whole:])


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = QUERIES["op11_packing"](spark, "/root/testdata/sf0.01").collect()
    check(rows, [tuple(row) for row in docs.select("doc_id", "text").collect()])


def test_reruns_agree(spark):
    runs = [QUERIES["op11_packing"](spark, "/root/testdata/sf0.001").collect() for _ in range(2)]
    assert sorted(map(tuple, runs[0])) == sorted(map(tuple, runs[1]))


def test_defined_cases(spark, documents):
    long = "word salad, " * 30_000
    rows = [(1, None), (2, ""), (3, "some text"), (4, "<|endoftext|>"), (5, long), (6, " " * 50_000), (7, "some text")]
    found = digests(pack(documents(*rows), CONTENT, public_tokenizers.PATTERN)).collect()
    check(found, rows)


def test_repeated_rows_and_missing_ids(spark, documents):
    rows = [(1, "same text")] * 5 + [(None, "no id")] * 3
    found = digests(pack(documents(*rows), CONTENT, public_tokenizers.PATTERN, length=8)).collect()
    ids = sum(row["length"] for row in found)
    assert ids == 5 * len(encode("same text")) + 3 * len(encode("no id"))
    places = [(row["sequence_id"], row["offset"] + at) for row in found for at in range(row["length"])]
    assert len(set(places)) == ids
    assert {row["doc_id"] for row in found} == {1, None}


def test_no_documents(spark, documents):
    assert pack(documents((1, "x")).where("false"), CONTENT, public_tokenizers.PATTERN).count() == 0


def test_neighbours_are_alike(spark, documents):
    """Documents of two vocabularies are not interleaved."""
    kinds = ["red green blue yellow", "north south east west"]
    rows = [(at, " ".join([kinds[at % 2], kinds[at % 2]])) for at in range(200)]
    found = digests(pack(documents(*rows), CONTENT, public_tokenizers.PATTERN)).collect()
    order = sorted(found, key=lambda row: (row["sequence_id"], row["offset"]))
    sides = [row["doc_id"] % 2 for row in order]
    assert sum(a != b for a, b in zip(sides, sides[1:])) == 1


@pytest.mark.parametrize("dimensions, bits", [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_each_point_once_by_single_steps(dimensions, bits):
    points = np.array(list(product(range(1 << bits), repeat=dimensions))).T
    key = hilbert(points, bits)
    assert sorted(key) == list(range(1 << bits * dimensions))
    steps = np.abs(np.diff(points[:, np.argsort(key)], axis=1)).sum(axis=0)
    assert (steps == 1).all()


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=60))
def test_ids_are_the_tokenizers(text):
    assert [*token_ids(text, CONTENT, public_tokenizers.PATTERN), 0] == encode(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=20), st.sampled_from([1, 8, 16]))
def test_cuts(sizes, length):
    cuts, first, held = last_cuts(sum(sizes), length), 0, defaultdict(int)
    for n in sizes:
        at = 0
        for start, size, sequence, offset in cut_document(first, n, cuts, length):
            assert start == at and size > 0 and held[sequence] == offset
            held[sequence] += size
            at += size
        assert at == n
        first += n
    assert all(size == length or size & (size - 1) == 0 for size in held.values())
    assert sorted(held) == list(range(len(held)))


def test_white_space_at_the_end_does_not_need_the_slow_tokenizer(monkeypatch):
    fast, _ = packing._encoders(CONTENT, public_tokenizers.PATTERN)
    monkeypatch.setattr(packing, "_encoders", lambda *_: (fast, None))
    for text in ("a" + " \n" * 600_000, "\0<|none|>\0 <|endoftext|>", "it's  é 東\t 12"):
        assert [*token_ids(text, CONTENT, public_tokenizers.PATTERN), 0] == encode(text)


def test_coordinates_of_ids_are_looked_up_where_they_are_known():
    ids = np.array([0, 1, 65_535, 7, 7, 300], dtype="<u4")
    wide = packing.project(np.append(ids, np.uint32(65_536)))
    want = np.bincount((packing.mix(ids.astype(np.uint64)) % np.uint64(packing.FEATURES)).astype(np.int64), minlength=packing.FEATURES)
    met = np.flatnonzero(want)
    weights = np.log1p(want[met])
    want = np.rint(weights @ packing._PROJECTION[met] / np.sqrt((weights**2).sum()) * packing.STEPS)
    assert (packing.project(ids) == want).all() and wide.shape == (packing.DIMENSIONS,)
