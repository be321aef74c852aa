from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from oracle import assert_oracle

from specloom.llm.prefixtrie import TernaryTree, medians, number_turns, prefix_trie
from specloom.llm.queries import QUERIES, rebuilt_conversations

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def brute(convs):
    """Node rows from a dict of conversation -> list of (role, text)."""
    nodes = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    rows = []
    for prefix, members in nodes.items():
        d = len(prefix)
        subtree = [p for p in nodes if p[:d] == prefix]
        inner = {p[:-1] for p in nodes if p}
        ends = sorted(c for c in members if len(convs[c]) == d)
        rows.append(
            (
                min(members),
                d,
                min(nodes[prefix[:-1]]) if d else None,
                len(members),
                sum(len(p) == d + 1 for p in subtree),
                sum(p not in inner for p in subtree),
                sum((len(nodes[p]) - 1) * len(p[-1][1].encode()) for p in subtree if p),
                len(ends),
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(map(str, rows))


def result(df):
    return sorted(str(tuple(r)) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "n_ends", "ends_sha256").collect())


def trie(spark, convs, **sizes):
    rows = [(c, i, r, t) for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    members = spark.createDataFrame([(c, len(t)) for c, t in convs.items()], "conv_id bigint, turns_in_all bigint")
    return prefix_trie(number_turns(spark.createDataFrame(rows, SCHEMA)), members, **sizes)


def test_tree_is_balanced_and_walk_is_from_above():
    tree = TernaryTree()
    codes = list(range(1023))
    for i in medians(1023):
        tree.add(codes, i, i + 1)

    def height(v):
        return 0 if v < 0 else 1 + max(height(tree.low[v]), height(tree.high[v]))

    assert height(0) == 10 and sorted(medians(7)) == list(range(7))
    tree = TernaryTree()
    ends = [tree.add([5, 6, 5, 7, 5, 6, 8], a, b) for a, b in [(0, 2), (2, 4), (4, 7), (0, 2), (0, 0)]]
    assert ends[0] == ends[3] and ends[4] == -1 and len(tree.code) == 4
    seen = set()
    for v in tree.walk():
        assert tree.up[v] == -1 or tree.up[v] in seen
        seen.add(v)
    assert len(seen) == 4


@pytest.mark.parametrize(("segment", "shard_turns", "seed"), [(256, 200_000, 1), (2, 3, 2), (1, 1, 3), (3, 10, 4)])
def test_against_prefixes(spark, segment, shard_turns, seed):
    rnd = random.Random(seed)
    convs = {}
    for c in range(60):
        size = rnd.choice([0, 1, 2, 3, 5, 9])
        turns = [(rnd.choice(["u", "a"]), rnd.choice(["", "x", "né"])) for _ in range(size)]
        if c and rnd.random() < 0.5:
            old = convs[rnd.randrange(c)]
            turns = old[: rnd.randint(0, len(old))] + turns[: rnd.choice([0, 2, 9])]
        convs[c] = turns
    convs = {c * 7 - 20: t for c, t in convs.items()}
    assert result(trie(spark, convs, segment=segment, shard_turns=shard_turns)) == brute(convs)


def test_long_copies_and_a_long_tail(spark):
    long = [("u", str(i % 7)) for i in range(40)]
    convs = {1: long, 2: list(long), 3: long[:25], 4: long[:25] + [("a", "other")] * 30, 5: [], 6: [("u", "0")]}
    assert result(trie(spark, convs, segment=4, shard_turns=9)) == brute(convs)


def test_odd_rows(spark):
    rows = [
        (10, 1, "a", "two"),
        (10, None, None, "first"),
        (10, 1, "a", "two"),
        (10, 0, "b", None),
        (None, 0, "a", "lost"),
        (3, 5, "", ""),
        (-3, 0, "x", "y"),
    ]
    df = spark.createDataFrame([(*r, "z", 1) for r in rows], SCHEMA + ", pos string, size int")
    got = number_turns(df).collect()
    convs = {10: [("", "first"), ("b", ""), ("a", "two"), ("a", "two")], 3: [("", "")], -3: [("x", "y")]}
    assert sorted((r.conv_id, r.pos, r["size"]) for r in got) == sorted((c, i, len(t)) for c, turns in convs.items() for i, (_, t) in enumerate(turns))
    members = spark.createDataFrame([(c, len(t)) for c, t in convs.items()], "conv_id bigint, turns_in_all bigint")
    assert result(prefix_trie(number_turns(df), members)) == brute(convs)
    empty = df.where("false")
    assert prefix_trie(*rebuilt_conversations(empty)).collect() == []


def test_hot_conversation_is_numbered_in_ranges(spark):
    rows = [(c, i, "u", str(i * 31 % 17)) for c, n in ((0, 300), (1, 310), (2, 3)) for i in range(n)]
    df = spark.createDataFrame(rows, SCHEMA)
    plain = result(prefix_trie(*rebuilt_conversations(df), segment=64))
    spark.conf.set("specloom.hotRows", "50")
    try:
        assert result(prefix_trie(*rebuilt_conversations(df.repartition(5)), segment=64)) == plain
    finally:
        spark.conf.unset("specloom.hotRows")


def test_rebuilt_by_remainder_of_five(spark):
    rows = [(c, i, "u", f"{c}.{i}") for c in (-10, -7, -5, -1, 0, 1, 2, 4, 6, 9) for i in range(1 + abs(c) % 4 * 3)]
    turns, members = rebuilt_conversations(spark.createDataFrame(rows, SCHEMA))
    sizes = {r.conv_id: r.turns_in_all for r in members.collect()}
    places = defaultdict(list)
    for r in turns.collect():
        places[r.conv_id].append(r.pos)
    import zlib

    own = defaultdict(list)
    for c, i, *_ in rows:
        own[c].append(i)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c > 0 else -1)
        assert sizes[c] == len(own.get(base, [])[:h]) + len(own[c][h:])
        assert sorted(places[c]) == list(range(sizes[c]))


def test_oracle(spark):
    assert_oracle(spark, "op11_trie", QUERIES)
    got = QUERIES["op11_trie"](spark, "/root/testdata/sf0.001")
    assert got.agg(F.max("n_convs")).first()[0] == 20
