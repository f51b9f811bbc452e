import random

from repolume.llm.sharding import difference, pack_groups, shard_documents


def test_differencing_beats_or_meets_the_best_of_greedy_and_keeps_every_part():
    draw = random.Random(3)
    for width in (2, 3, 8):
        sizes = [draw.randint(1, 10_000) for _ in range(200)]
        went = difference([[0] * (width - 1) + [size] for size in sizes])
        parts = [0] * width
        for size, parts_of in zip(sizes, went, strict=True):
            assert sorted(parts_of) == list(range(width))
            parts[parts_of[-1]] += size
        greedy = [0] * width
        for size in sorted(sizes, reverse=True):
            greedy[greedy.index(min(greedy))] += size
        assert max(parts) - min(parts) <= max(greedy) - min(greedy)


def test_differencing_follows_the_two_way_example_by_hand():
    # 8 7 6 5 4: differences 1 6 5 4 -> 1 1 4 -> 3 1 -> 2
    went = difference([[0, size] for size in (8, 7, 6, 5, 4)])
    sums = [0, 0]
    for size, parts in zip((8, 7, 6, 5, 4), went, strict=True):
        sums[parts[1]] += size
    assert sorted(sums) == [14, 16]


def test_a_tree_of_many_bundles_places_every_group_once(spark):
    groups = spark.range(3000).selectExpr("unhex(sha2(cast(id AS string), 256)) AS text_key", "1 + id * id % 977 AS bytes")
    placed = pack_groups(groups, 5, bundle=40, fan_in=4).join(groups, "text_key").groupBy("shard").sum("bytes", ).collect()
    sizes = [row[1] for row in placed]
    assert len(sizes) == 5 and sum(sizes) == groups.groupBy().sum("bytes").first()[0]
    assert max(sizes) - min(sizes) <= 5


def test_equal_texts_share_a_shard_and_slots_have_no_gaps(documents):
    texts = [(i, f"text number {i % 40} " * (1 + i % 7)) for i in range(400)]
    docs = documents(*texts, (400, None), (401, None), (402, ""), (403, "y" * 100_000), (None, "z"), (5, "text"), (5, "text"))
    found = shard_documents(docs, 8).collect()
    assert len(found) == 407
    by_text = {}
    lookup = dict(texts)
    for row in found:
        if row["doc_id"] in lookup and row["doc_id"] != 5:
            by_text.setdefault(lookup[row["doc_id"]], set()).add(row["shard"])
    assert all(len(shards) == 1 for shards in by_text.values())
    slots = {}
    for row in found:
        slots.setdefault(row["shard"], []).append(row["slot"])
    assert all(sorted(group) == list(range(len(group))) for group in slots.values())
    sizes = {row["doc_id"]: row["size"] for row in found}
    assert sizes[400] == sizes[402] == 1 and sizes[403] == 100_001


def test_no_documents(documents):
    assert shard_documents(documents((1, "a")).where("false"), 8).count() == 0
