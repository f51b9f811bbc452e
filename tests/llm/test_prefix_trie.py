import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from repolume.llm import prefix_trie as module
from repolume.llm.prefix_trie import ordered_turns, prefix_trie, rebuild

SCHEMA = "conv_id long, turn long, role string, text string, at long, block int, k0 int, level int"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


@pytest.fixture
def conversations(spark):
    """Rows of (conv_id, turn, role, text), with extra columns of clashing names."""
    return lambda rows: spark.createDataFrame([(*row, 1, 2, 3, 4) for row in rows], SCHEMA)


def lists(rows):
    """The turns (role, text) of each conversation, in order."""
    found = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            found[conv_id].append((turn is not None, turn or 0, digest, (role, text)))
    return {conv_id: [turn[3] for turn in sorted(turns)] for conv_id, turns in found.items()}


def rebuilt(convs):
    def one(c):
        h = zlib.crc32(str(c).encode()) % 9
        return convs.get(c - c % 5, [])[:h] + convs[c][h:]

    return {c: one(c) for c in convs}


def brute(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for depth in range(len(turns) + 1):
            members[tuple(turns[:depth])].append(c)
    rows = []
    for path, ids in members.items():
        below = [other for other in members if other[: len(path)] == path]
        leaf = lambda node: not any(len(o) == len(node) + 1 and o[: len(node)] == node for o in members)
        ends = ",".join(str(c) for c in sorted(ids) if len(convs[c]) == len(path))
        rows.append((
            min(ids), len(path), min(members[path[:-1]]) if path else None, len(ids),
            sum(len(o) == len(path) + 1 for o in below), sum(map(leaf, below)),
            sum((len(members[o]) - 1) * len(o[-1][1].encode()) for o in below if o), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(rows, key=str)


def found(df):
    assert df.columns == list(COLUMNS)
    return sorted((tuple(row) for row in df.collect()), key=str)


def some(seed, convs, turns, texts=3):
    draw = random.Random(seed)
    return [
        (c, at, draw.choice(["user", "assistant"]), draw.choice(["", "a", "bb", "ß", "long " * 20][:texts]))
        for c in range(convs) for at in range(draw.randrange(1, turns))
    ]


@pytest.mark.parametrize("seed, convs, turns", [(1, 30, 6), (2, 12, 40)])
def test_as_brute_force(conversations, seed, convs, turns):
    rows = some(seed, convs, turns)
    # a beginning of some blocks that most share, and exact copies
    rows = [(c, at - 20, "user", f"common {at}") for c in range(convs) if c % 3 for at in range(20)] + rows
    rows += [(c + 100, *rest) for c, *rest in rows if c < 4]
    assert found(prefix_trie(ordered_turns(conversations(rows)))) == brute(lists(rows))


def test_rebuilt_conversations(conversations):
    rows = [row for row in some(3, 40, 12) if row[0] not in (5, 20)]  # beginnings that are absent
    expected = rebuilt(lists(rows))
    assert any(not turns for turns in expected.values())
    assert found(prefix_trie(rebuild(ordered_turns(conversations(rows))))) == brute(expected)


def test_nulls_ties_and_repeated_rows(conversations):
    rows = [
        (1, None, None, None), (1, 0, "user", "x"), (1, 0, "user", "y"), (1, 0, "user", "x"), (2, None, "", ""),
        (2, 0, "user", "y"), (None, 0, "user", "x"), (None, None, None, None), (-3, 1, "u", "ser"), (-4, 1, "us", "er"),
    ]
    assert found(prefix_trie(ordered_turns(conversations(rows)))) == brute(lists(rows))


def test_no_conversations(conversations):
    for rows in ([], [(None, 0, "user", "x")]):
        df = conversations(rows or [(1, 0, "a", "b")]).where("true" if rows else "false")
        assert found(prefix_trie(rebuild(ordered_turns(df)))) == []


def test_long_conversations_are_added_up_in_ranges(conversations, monkeypatch):
    monkeypatch.setattr(module, "BLOCKS", 2)
    rows = [(1, at, "user", f"{at // 3}") for at in range(90)] + [(2, at, "user", f"{at // 3}") for at in range(70)]
    rows += [(2, 70, "user", "other"), (3, 0, "user", "0"), (4, 0, "user", "0")]
    assert found(prefix_trie(ordered_turns(conversations(rows)))) == brute(lists(rows))


def test_lists_of_members_are_digested_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(module, "PIECE", 3)
    ends = spark.range(-7, 200).selectExpr("id % 2 AS depth", "0L AS k0", "1L AS k1", "id AS conv_id")
    got = {row["depth"]: row["ends_sha256"] for row in module.member_digests(ends.repartition(5)).collect()}
    want = defaultdict(list)
    for at in range(-7, 200):
        want[int(at % 2 if at >= 0 else -((-at) % 2))].append(str(at))
    assert got == {depth: hashlib.sha256(",".join(ids).encode()).hexdigest() for depth, ids in want.items()}
