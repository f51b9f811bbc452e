import random
import time

import pytest
from pyspark.sql import functions as F

from repolume.functions import scalars as S
from repolume.operators import filters as O
from tests.conftest import rows


@pytest.mark.parametrize(
    "white, black, kept",
    [(["b"], ["c"], ["ab"]), ([], None, ["ab", "bc", "cd"]), (None, [], ["ab", "bc", "cd"]), (["B"], None, []),
     (["a", "d"], None, ["ab", "cd"])],
)
def test_select_repositories(frame, white, black, kept):
    df = frame("name string", *[{"name": n} for n in ("ab", "bc", "cd")])
    assert [r[0] for r in rows(O.select_repositories(df, white, black))] == kept


def test_branch_names(frame):
    refs = ["refs/heads/main", "refs/remotes/origin/main", "refs/remotes/origin/dev", "refs/remotes/origin/HEAD", "refs/tags/v1"]
    df = frame("repo_full_name string, ref string", *[{"repo_full_name": "r", "ref": ref} for ref in refs])
    assert rows(O.clean_branch_names(df)) == [("r", "dev", False), ("r", "main", True)]


def test_simple_filters(frame):
    df = frame("n string, flag boolean", {"n": "GitHub", "flag": True}, {"n": "x", "flag": False}, {"n": None, "flag": None})
    assert rows(O.pull_requests_only(df, "flag"), "n") == [("GitHub",)]
    assert len(rows(O.present(df, "n"))) == 2
    assert sorted(r[0] for r in rows(O.equal_or_rest(df, "n", "GitHub"), "is_equal")) == [False, False, True]


def test_datetime_format(frame):
    df = frame("a string", {"a": "2024-01-01 10:00:00"}, {"a": "bad"})
    lenient = S.apply_datetime_format(df, "a", "b", strict=False)
    assert [r[1] is None for r in lenient.collect()] == [False, True]
    with pytest.raises(Exception):
        S.apply_datetime_format(df, "a").collect()


def test_scalars(frame):
    df = frame("u string, l string", {"u": "https://api/repos/o/r/issues/12", "l": "a.b"}, {"u": "https://api/o/r/12", "l": None})
    got = rows(df.select(S.url_repository(F.col("u")), S.url_number(F.col("u")), S.split_list(F.col("l"), ".")))
    assert got == [("o/r", 12, ["a", "b"]), (None, None, None)]
    assert df.select(S.edit_distance(F.lit("kitten"), F.lit("sitting")), S.edit_distance(F.lit(None).cast("string"), F.lit("ab"))).first() == (3, 2)


def test_edit_distance_of_long_texts_is_the_plain_one(spark):
    draw = random.Random(6)
    pairs = [("", "x" * 300), ("a" * 300, "a" * 300), ("a" * 300, "a" * 299), ("ab" * 200, "ba" * 200), (None, "é" * 400), ("x" * 700, "y" * 700)]
    for _ in range(60):
        old = [draw.choice("abé\U0001f600 ") for _ in range(draw.randint(257, 900))]
        new = list(old)
        for _ in range(draw.choice([0, 1, 5, 40, 400])):
            at = draw.randrange(len(new))
            new[at : at + draw.randint(0, 2)] = draw.choice("abé\U0001f600 ") * draw.randint(0, 3)
        pairs.append(("".join(old), "".join(new)))
    df = spark.createDataFrame(pairs, "old string, new string")
    plain = F.levenshtein(F.coalesce("old", F.lit("")), F.coalesce("new", F.lit("")))
    assert df.where(~S.edit_distance(F.col("old"), F.col("new")).eqNullSafe(plain)).count() == 0


def test_neighbouring_edits_of_a_megabyte_take_little_time(spark):
    draw = random.Random(7)
    old = [draw.choice("abcdefgh \n") for _ in range(1_000_000)]
    new = list(old)
    for at in range(500_000, 504_000, 400):
        new[at] = "#"
    df = spark.createDataFrame([("".join(old), "".join(new))], "old string, new string")
    begin = time.monotonic()
    assert df.select(S.edit_distance(F.col("old"), F.col("new"))).first()[0] == 10
    assert time.monotonic() - begin < 30
