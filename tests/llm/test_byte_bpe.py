import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from repolume.llm.byte_bpe import (
    _library, _merge_long, decode, decoded_bytes, encode, encode_and_decode, encoded_head, fold_merges, merge_word,
    rank_table, read_ranks,
)
from repolume.llm.common import quick, slices

RANKS = read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
QUICK = tiktoken.Encoding("own", pat_str=quick(public_tokenizers.PATTERN), mergeable_ranks=RANKS, special_tokens={})
TEXTS = (
    "Hello, world! It's 2024's   end.\n\n\tÉlan vital — naïve café 東京 🎉 \x00  x", None, "", " ", "\n \n  a", "a" * 500,
    "the the The THE", "<|endoftext|> we'll I'd", "x" * 30_000 + " " + "long tail " * 3000, "é​  ß",
)


@settings(max_examples=300, deadline=None)
@given(st.text(min_size=1, max_size=80))
def test_words_are_merged_as_the_library_does(text):
    word = text.encode()
    assert merge_word(word, RANKS) == LIBRARY._encode_single_piece(word) == _merge_long(word, RANKS)


def test_higher_order_functions_merge_alike(spark):
    draw = random.Random(2)
    words = ["".join(draw.choice("abeinrstéß .") for _ in range(draw.randint(1, 20))) for _ in range(300)] + ["a", "the", " the"]
    found = spark.createDataFrame([(word,) for word in words], "word string").select(
        "word", fold_merges(F.encode("word", "UTF-8"), RANKS).alias("ids")
    )
    assert all(row["ids"] == LIBRARY._encode_single_piece(row["word"].encode()) for row in found.collect())


@pytest.mark.parametrize("head", [0, 5, 1 << 17])
def test_texts_are_encoded_as_the_library_does_and_decode_to_themselves(documents, head):
    docs = documents(*enumerate(TEXTS), (3, " "), (None, "null id"))
    encoded = encode(docs, RANKS, public_tokenizers.PATTERN, head)
    assert encoded.columns == [*docs.columns, "ids"]
    for row in decode(encoded, RANKS).collect():
        text = row["text"] or ""
        assert row["ids"] == LIBRARY.encode_ordinary(text) and row["n_tokens"] == len(row["ids"])
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, row["ids"])).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    if head:
        native = encoded.select("text", decoded_bytes(F.col("ids"), RANKS).alias("bytes"))
        assert all(bytes(row["bytes"]) == (row["text"] or "").encode() for row in native.collect())


@pytest.mark.parametrize("head, ids", [(0, True), (5, False), (1 << 17, True)])
def test_one_pass_gives_what_two_give(documents, head, ids):
    docs = documents(*enumerate(TEXTS), (3, " "), (None, "null id"), (20, " " * 40_000 + "x"))
    found = encode_and_decode(docs, RANKS, public_tokenizers.PATTERN, ["doc_id", "source", "ids2", "text"], ids, head)
    assert found.columns == ["doc_id", "source", "ids2", "text", *["ids"] * ids, "n_tokens", "ids_sha256", "decoded_sha256"]
    got = found.collect()
    assert len(got) == docs.count()
    for row in got:
        text = row["text"] or ""
        want = merge_all(text)
        assert not ids or row["ids"] == want
        assert row["n_tokens"] == len(want) and row["ids2"] == 7
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def merge_all(text):
    """The library's ids, or those of its words where its pattern gives up."""
    try:
        return LIBRARY.encode_ordinary(text)
    except ValueError:
        return [i for word in regex.findall(public_tokenizers.PATTERN, text) for i in merge_word(word.encode(), RANKS)]


def test_the_head_is_bounded_and_has_the_most_frequent_words(documents):
    docs = documents((1, "a a a a b b b c c d e"))
    assert {row["word"] for row in encoded_head(docs, RANKS, r"\w", 3).collect()} == {"a", "b", "c"}
    assert {row["word"] for row in encoded_head(docs, RANKS, r"\w", 4).collect()} == {"a", "b", "c"}


def test_no_documents(documents):
    empty = documents((1, "a")).where("false")
    assert encode_and_decode(empty, RANKS, public_tokenizers.PATTERN).count() == 0
    assert decode(encode(empty, RANKS, public_tokenizers.PATTERN), RANKS).count() == 0


def test_the_ranks_are_in_no_plan(documents):
    docs = documents(*enumerate(TEXTS))
    head = encoded_head(docs, RANKS, public_tokenizers.PATTERN)
    assert len(head._jdf.queryExecution().toString()) < 100_000
    assert all(row["ids"] == LIBRARY._encode_single_piece(row["word"].encode()) for row in head.collect())


def test_the_table_of_ranks_holds_every_piece_once(spark):
    maps = rank_table(spark, RANKS).first()["table"]
    assert sorted((bytes.fromhex(key), rank) for some in maps for key, rank in some.items()) == sorted(RANKS.items())


@settings(max_examples=1000, deadline=None)
@given(st.text(st.sampled_from("aZsdmtlrve'éß東٣7½_-!#🎉\u0301\u200b\x00 \t\n\r\x0b\x1c\x85\xa0\u2003"), max_size=40))
def test_the_quick_pattern_cuts_alike(text):
    pattern = public_tokenizers.PATTERN
    assert quick(pattern) != pattern and quick("[a-z]+") == "[a-z]+"
    assert regex.findall(quick(pattern), text) == regex.findall(pattern, text)
    assert QUICK.encode_ordinary(text) == LIBRARY.encode_ordinary(text)


def test_a_run_of_white_space_is_a_word_of_any_length():
    """The library's own pattern has no room for so long a run, and does not say so by an error that can be handled."""
    run = " " * 1_100_000
    assert _library(RANKS, public_tokenizers.PATTERN)(run) == _merge_long(run.encode(), RANKS)


def test_results_are_handed_back_in_small_batches(spark):
    texts = [f"text number {n}, {'x' * (n % 7)}" for n in range(600)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(600)), "text": texts})
    parts = list(slices(iter([batch, batch.slice(0, 0)])))
    assert [part.num_rows for part in parts] == [256, 256, 88] and pa.Table.from_batches(parts).to_pylist() == batch.to_pylist()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    found = {r.doc_id: list(r.ids) for r in encode_and_decode(docs, RANKS, public_tokenizers.PATTERN, ids=True).collect()}
    assert found == {n: LIBRARY.encode(text) for n, text in enumerate(texts)}
