from pyspark.sql import functions as F

from repolume.llm.exact_dedup import drop_copies, exact_dedup
from tests.conftest import rows

TEXTS = (
    (1, "Same Text"), (5, "same text"), (3, "SAME TEXT"), (2, "Élan"), (4, "élan"), (6, None), (7, ""), (8, " "),
    (9, "x" * 300_000), (10, "X" * 300_000), (11, "alone"),
)
EXPECTED = {1: (5, 3), 5: (5, 3), 3: (5, 3), 2: (2, 1), 4: (4, 1), 6: (7, 2), 7: (7, 2), 8: (8, 1), 9: (10, 2), 10: (10, 2),
            11: (11, 1)}


def decided(df):
    return {row["doc_id"]: (row["keep_id"], row["group_size"]) for row in df.collect()}


def test_largest_id_of_equal_texts_stays(documents):
    found = exact_dedup(documents(*TEXTS))
    assert decided(found) == EXPECTED
    assert all(row["kept"] == (row["doc_id"] == row["keep_id"]) for row in found.collect())


def test_equal_digests_of_different_texts_are_told_apart_by_the_texts(documents):
    weak = lambda text: F.lit(b"same") if text is None else F.substring(F.unhex(F.sha2(text, 256)), 1, 0)
    assert decided(exact_dedup(documents(*TEXTS), weak)) == EXPECTED


def test_repeated_rows_and_null_ids(documents):
    found = rows(exact_dedup(documents((1, "a"), (1, "a"), (None, "A"), (None, "b"))), "doc_id", "keep_id", "group_size", "kept")
    assert found == sorted([(1, 1, 3, True), (1, 1, 3, True), (None, 1, 3, False), (None, None, 1, True)], key=repr)


def test_no_documents(documents):
    empty = documents((1, "a")).where("false")
    assert exact_dedup(empty).count() == 0 and drop_copies(empty).count() == 0


def test_dropping_keeps_whole_rows(documents):
    docs = documents(*TEXTS, (11, "alone"))
    kept = drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(row["doc_id"] for row in kept.collect()) == [2, 4, 5, 7, 8, 10, 11]
    assert {row["digest"] for row in kept.collect()} == {7}
