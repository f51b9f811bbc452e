import random

import pyarrow as pa
import pytest

from repolume.llm import common, minhash
from repolume.llm.minhash import components, drop_near_duplicates, hashed_shingles, minwise_bits, near_duplicates, prefix, roots, shingles
from tests.conftest import rows


def expected(texts):
    """Smallest id of each document's component, by comparing all pairs."""
    sets = {i: shingles(text) for i, text in texts}
    least = {i: i for i in sets}

    def find(i):
        return i if least[i] == i else find(least[i])

    for i in sets:
        for j in sets:
            common = len(sets[i] & sets[j])
            if j < i and common and 100 * common >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                least[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def corpus():
    draw = random.Random(7)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(5))
    edited = lambda words, share: " ".join(word() if draw.random() < share else w for w in words)
    texts = []
    passage = [word() for _ in range(60)]
    for _ in range(60):
        words = [word() for _ in range(draw.randint(3, 120))]
        texts += [edited(words, share) for share in (0, 0, 0.01, 0.03, 0.05)]
        texts.append(" ".join(words + passage))
    original = [word() for _ in range(100)]
    texts += [edited(original, 0.025) for _ in range(150)] + [" ".join(original)]
    texts += ["one two three four", "ONE two\tthree  four", "one two three", "Ünï code ü", "ünï code ü", " ", None, ""]
    texts.append(" ".join(word() for _ in range(40_000)))
    draw.shuffle(texts)
    return list(enumerate(texts))


def test_components_are_those_of_all_pairs(documents):
    texts = corpus()
    found = near_duplicates(documents(*texts))
    got = {row["doc_id"]: (row["n_shingles"], row["component_id"]) for row in found.collect()}
    assert got == expected(texts)
    assert all(row["kept"] == (row["doc_id"] == row["component_id"]) for row in found.collect())
    assert rows(near_duplicates(documents(*texts))) == rows(found)


def test_repeated_rows_null_ids_and_no_documents(documents):
    text = "a b c d e f g h i j"
    docs = documents((1, text), (1, text), (3, text), (None, text), (None, None), (5, "z z z z z z"), (1, "q r s t u v"), (0, "q r s t u v"))
    found = rows(near_duplicates(docs), "doc_id", "component_id", "kept")
    # rows that share an id are grouped by their texts
    assert found == sorted(
        [(1, 1, True)] * 2 + [(3, 1, False), (None, 1, False), (1, 0, False), (None, None, True), (5, 5, True), (0, 0, True)], key=repr
    )
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns and rows(kept, "doc_id", "text")[0] == (0, "q r s t u v")
    assert [row["doc_id"] for row in kept.collect() if row["text"] == text] == [1, 1, None]
    assert near_duplicates(docs.where("false")).count() == 0


def test_long_chains_are_one_component(spark):
    draw = random.Random(1)
    ids = list(range(300))
    draw.shuffle(ids)
    links = [(ids[i], ids[i + 1]) for i in range(299) if i != 150] + [(5000, 4999), (5000, 5000)]
    found = rows(components(spark.createDataFrame(links, "a long, b long")))
    left, right = set(ids[:151]), set(ids[151:])
    want = {(i, min(part)) for part in (left, right, {4999, 5000}) for i in part if i != min(part)}
    assert set(found) == want
    chain = spark.createDataFrame([(i, i - 1) for i in range(1, 100)], "id long, component long")
    assert sorted(map(tuple, roots(chain).collect())) == [(i, 0) for i in range(1, 100)]


def test_texts_that_share_much_are_joined_wholly(documents, monkeypatch):
    """A source whose texts share most of their words, with pairs among them that no hub joins: no node is dropped."""
    monkeypatch.setattr(minhash, "LEAF", 1)
    monkeypatch.setattr(minhash, "CELL", 7)
    draw = random.Random(11)
    words = lambda count: ["".join(draw.choice("abcdefgh") for _ in range(6)) for _ in range(count)]
    frame, texts = words(140), []
    for _ in range(60):
        own = words(30)
        texts += [" ".join(frame + own), " ".join(frame + own[:12] + words(18))]
    texts += [" ".join(frame + words(30)) for _ in range(100)]
    draw.shuffle(texts)
    texts = list(enumerate(texts))
    want = expected(texts)
    assert len({component for _, component in want.values()}) == 60 + 100
    got = {row["doc_id"]: (row["n_shingles"], row["component_id"]) for row in near_duplicates(documents(*texts)).collect()}
    assert got == want


def test_prefixes_share_a_shingle_with_every_similar_set():
    for n in (*range(1, 60), 1000):
        for m in range(-(-3 * n // 4), 4 * n // 3 + 1):
            shared = -(-3 * (n + m) // 7)  # what two similar sets of these sizes share at least
            assert shared > n - prefix(n) and shared > m - prefix(m)


def test_bits_tell_similar_sets_from_others():
    draw = random.Random(5)
    words = lambda count: ["".join(draw.choice("abcdefgh") for _ in range(6)) for _ in range(count)]
    agreeing = {0.75: [], 0.6: []}
    for similar, found in agreeing.items():
        for _ in range(40):
            common = words(400)
            own = round(400 * (1 - similar) / (2 * similar))
            a, b = (minwise_bits(hashed_shingles(" ".join(common + words(own)))) for _ in range(2))
            found.append(minhash.BITS - sum(bin(int(x) & (1 << 64) - 1).count("1") for x in a ^ b))
    assert min(agreeing[0.75]) >= minhash.LEAST_BITS > max(agreeing[0.6])


def test_one_pair_of_two_components_is_enough_where_it_is_a_link(spark, monkeypatch):
    asked = []

    def confirm(pairs, texts):
        asked.append({tuple(row) for row in pairs.select("a", "b").collect()})
        return pairs.select("a", "b").where("b <> 40 OR a = 7")  # of 40's links only one holds

    monkeypatch.setattr(minhash, "confirm", confirm)
    joined = spark.createDataFrame([(one, 0) for one in range(1, 20)], "id long, component long")
    pairs = [(one, other, 60 - one) for one in range(20) for other in (30, 40)] + [(30, 7, 64), (3, 4, 64)]
    found = minhash._linked(joined, spark.createDataFrame(pairs, "a long, b long, agreeing int"), None)
    assert {tuple(row) for row in found.collect()} == {(one, 0) for one in [*range(1, 20), 30, 40]}
    assert asked == [{(30, 7), (0, 40)}, {(one, 40) for one in range(1, 20)}]


def test_components_are_looked_up_once_for_all_their_pairs(spark, monkeypatch):
    """A large group whose ids are each alike many others that are no links: only the first look at them is by id."""
    looked, apart = [], minhash._apart

    def counted(pairs, joined):
        looked.append(pairs.count())
        return apart(pairs, joined)

    monkeypatch.setattr(minhash, "_apart", counted)
    monkeypatch.setattr(minhash, "confirm", lambda pairs, texts: pairs.select("a", "b").where("least(a, b) = 7 AND greatest(a, b) > 109"))
    joined = spark.createDataFrame([(one, 0) for one in range(1, 50)], "id long, component long")
    pairs = [(one, other, 40 + one % 7) for one in range(50) for other in range(100, 112)]
    pairs += [(b, a, agreeing) for a, b, agreeing in pairs]  # met from both ends
    found = minhash._linked(joined, spark.createDataFrame(pairs, "a long, b long, agreeing int"), None)
    assert {tuple(row) for row in found.collect()} == {(one, 0) for one in [*range(1, 50), 110, 111]}
    assert looked == [50 * 12, 12]


def test_texts_go_to_python_in_small_batches(documents, monkeypatch, spark):
    key, seen, settled = "spark.sql.execution.arrow.maxBytesPerBatch", {}, common.settled
    before = spark.conf.get(key)

    def observed(df, label):
        seen[label] = spark.conf.get(key)
        return settled(df, label)

    monkeypatch.setattr(common, "settled", observed)
    text = " ".join(f"w{at}" for at in range(40))
    found = rows(minhash.near_duplicates(documents((1, text), (2, f"{text} more"), (3, "other"))), "doc_id", "component_id")
    assert found == [(1, 1), (2, 1), (3, 3)]
    assert seen == {"minhash-sketches": "4m", "minhash-confirmed": "4m"} and spark.conf.get(key) == before


def test_batches_are_bounded_and_the_setting_is_put_back(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    wide = spark.range(2000, numPartitions=1).selectExpr("repeat('x', 1000) AS text")
    sizes = lambda batches: (pa.RecordBatch.from_pydict({"n": [batch.num_rows]}) for batch in batches)
    found = common.settled_in_batches(wide.mapInArrow(sizes, "n long"), "batches", "100k")
    assert [sum(r.n for r in found.collect()), max(r.n for r in found.collect()) < 200] == [2000, True]
    with pytest.raises(Exception, match="gone"):
        common.settled_in_batches(wide.selectExpr("raise_error('gone') AS gone"), "batches", "100k")
    assert spark.conf.get(key) == before
