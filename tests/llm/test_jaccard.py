from __future__ import annotations

import random
import re

import numpy as np
import pytest

from specloom.llm import jaccard
from specloom.llm.components import connected_components
from specloom.llm.jaccard import Bands, shingle_set, shingle_sets, signatures, similar_groups
from specloom.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_set(text, width=5):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    n = min(width, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def plain_groups(rows, percent=80, width=5):
    """component_id by all pairs."""
    sets = [plain_set(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    holders: dict = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    tried = set()
    for own in holders.values():
        for a in own:
            for b in own:
                if a < b and (a, b) not in tried:
                    tried.add((a, b))
                    shared = len(sets[a] & sets[b])
                    if 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                        parent[root(a)] = root(b)
    low: dict = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[root(i)] = min(doc, low.get(root(i), doc))
    return [(doc, len(sets[i]), (low.get(root(i)) if sets[i] else doc)) for i, (doc, _) in enumerate(rows)]


def varied(seed, n=60, sizes=(1, 3, 5, 9, 14, 20, 33, 60, 90, 130, 400)):
    """Texts with copies at every distance from the threshold, chains and shared passages."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    passage = rng.choices(words, k=70)
    out = []
    for _ in range(n):
        base = rng.choices(words, k=rng.choice(sizes))
        if rng.random() < 0.3:
            base = base[: len(base) // 2] + passage + base[len(base) // 2 :]
        out.append(base)
        for _ in range(rng.choice([0, 1, 1, 6])):
            copy = list(rng.choice([base, out[-1]]))
            for _ in range(rng.randrange(1 + len(copy) // 25 + 1)):
                at = rng.randrange(len(copy) + 1)
                kind = rng.random()
                copy[at : at + (kind < 0.6)] = rng.choices(words, k=1) if kind < 0.8 else []
            out.append(copy)
    return [rng.choice([" ", "\n", "  \t"]).join(w.upper() if rng.random() < 0.1 else w for w in t) for t in out]


def test_sets_equal_plain_sets():
    texts = [*varied(1, 20), "", "  ", "one", "a B\x0bc\x0c d\re f", "é É ü Ü ß x y z", "a\xa0b c d e f g", "x " * 50, "\x00a b\x1cc d e f"]
    seen: dict = {}
    for t in texts:
        s = shingle_set(t)
        want = plain_set(t)
        assert s.size == len(want) and (np.diff(s.astype(object)) > 0).all()
        seen.setdefault(frozenset(want), s)
        assert (seen[frozenset(want)] == s).all()
    assert shingle_set(None).size == 0


def test_blocks_do_not_change_sets(monkeypatch):
    texts = varied(2, 10) + ["y" * 500 + " z q"]
    texts += [None, "", " \n", "a b", "  lead and trail  "]
    whole = [shingle_set(t) for t in texts]
    together = list(shingle_sets(texts))
    monkeypatch.setattr(jaccard, "BLOCK", 64)
    cut = list(shingle_sets(texts))
    assert len(together) == len(cut) == len(texts)
    assert all(np.array_equal(a, b) and np.array_equal(a, c) for a, b, c in zip(whole, together, cut, strict=True))


@pytest.mark.parametrize("percent", [80, 90, 100])
def test_similar_sets_share_a_signature(percent):
    rng = np.random.default_rng(3)
    bands = Bands(percent)
    for low in range(1, 3000):
        high = low * 100 // percent
        assert any(a <= low and high <= b for a, b in ((bands.low[i], bands.high[i]) for i in bands.of(low)))
    for _ in range(1500):
        size = int(rng.choice([1, 2, 4, 5, 6, 9, 12, 17, 24, 31, 40, 64, 100, 150, 300, 900]))
        a = np.unique(rng.integers(0, 2**63, size=size).astype(np.uint64))
        # As far apart as the similarity allows.
        lost = int(rng.integers(0, size))
        while lost and 100 * (size - lost) < percent * size:
            lost -= 1
        gained = 0
        while 100 * (size - lost) >= percent * (size + gained + 1) and rng.random() < 0.98:
            gained += 1
        b = np.unique(np.concatenate([rng.permutation(a)[lost:], rng.integers(0, 2**63, size=gained).astype(np.uint64)]))
        assert set(signatures(a, bands).tolist()) & set(signatures(b, bands).tolist())


def test_sketch_is_a_lower_bound():
    rng = np.random.default_rng(8)
    for size in (1, 5, 40, 300, 3000):
        for lost in (0, 1, size // 5, size):
            a = rng.integers(0, 2**63, size=size).astype(np.uint64)
            b = np.concatenate([a[lost:], rng.integers(0, 2**63, size=lost + 2).astype(np.uint64)])
            x, y = (np.unpackbits(np.frombuffer(jaccard.sketch_of(s), dtype=np.uint8)) for s in (a, b))
            assert (x != y).sum() <= np.setxor1d(a, b).size


def test_spanning_forest():
    far = jaccard._FAR
    d = np.full((5, 5), far)
    for i, j, w in [(0, 1, 3), (1, 2, 1), (0, 2, 2), (3, 4, 7)]:
        d[i, j] = d[j, i] = w
    assert sorted(tuple(sorted(e)) for e in jaccard._spanning(d)) == [(0, 2), (1, 2), (3, 4)]


@pytest.mark.parametrize("block", [1024, 3])
def test_groups_against_all_pairs(spark, block, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", block)
    texts = varied(4, 70)
    rows = [(1000 + 7 * i % 911, t) for i, t in enumerate(texts)] + [(5, None), (6, ""), (7, " \n"), (8, "solo"), (9, "Solo"), (None, "solo"), (None, "none other")]
    rows += [rows[0]] * 30 + [(10, "a b c d e f " * 3000), (11, "a b c d e f " * 3001)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id bigint, text string, n int, name int").repartition(5)
    got = sorted(map(str, (tuple(r)[:3] for r in similar_groups(df).collect())))
    assert got == sorted(map(str, plain_groups(rows)))
    assert similar_groups(df.where("false")).count() == 0
    assert tuple(similar_groups(df.where("text is null")).first())[:3] == (5, 0, 5)


@pytest.mark.parametrize("block", [1024, 50])
def test_hot_near_copies(spark, block, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", block)
    rng = random.Random(6)
    words = [f"v{i}" for i in range(500)]
    base = rng.choices(words, k=120)
    rows = []
    for i in range(300):
        copy = list(base)
        for _ in range(rng.randrange(9)):
            copy[rng.randrange(120)] = rng.choice(words)
        rows.append((i, " ".join(copy)))
    got = sorted(tuple(r)[:3] for r in similar_groups(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect())
    assert got == sorted(plain_groups(rows))


def test_components(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(5, i) for i in range(200, 260)]
    got = {r.node: r.label for r in connected_components(spark.createDataFrame([*chain, *star, (9, 9)], "a bigint, b bigint")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 5 for i in [5, *range(200, 260)]}}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = QUERIES["op8_jaccard"](spark, sf)
    assert got.columns[:3] == ["doc_id", "n_shingles", "component_id"] and dict(got.dtypes)["n_shingles"] == "bigint"
    assert sorted(tuple(r)[:3] for r in got.collect()) == sorted(plain_groups(rows))
