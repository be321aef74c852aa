from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from specloom.llm import suffixdedup
from specloom.llm.queries import QUERIES
from specloom.llm.suffixdedup import Anchors, Trie, common_prefix, dedup_spans, repeated


def plain(texts, length):
    """Spans of each text by a table of all its strings."""
    where: dict = {}
    raws = [(t or "").encode() for t in texts]
    for raw in raws:
        for i in range(len(raw) - length + 1):
            s = raw[i : i + length]
            where[s] = where.get(s, 0) + 1
    out = []
    for raw in raws:
        spans: list = []
        for i in range(len(raw) - length + 1):
            if where[raw[i : i + length]] > 1:
                if spans and spans[-1][1] >= i:
                    spans[-1][1] = i + length
                else:
                    spans.append([i, i + length])
        kept, at = b"", 0
        for a, b in spans:
            kept, at = kept + raw[at:a], b
        out.append(([tuple(s) for s in spans], kept + raw[at:]))
    return out


def corpus(seed, n=50):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeéß ", k=rng.randrange(2, 9)))
    passages = [" ".join(word() for _ in range(rng.choice([12, 30, 90]))) for _ in range(4)]
    texts = []
    for _ in range(n):
        t = " ".join(word() for _ in range(rng.randrange(60)))
        for _ in range(rng.choice([0, 0, 1, 2])):
            at = rng.randrange(len(t) + 1)
            t = t[:at] + rng.choice(passages) + t[at:]
        texts.append(t)
        if rng.random() < 0.4:
            copy = list(t)
            for _ in range(rng.choice([0, 1, 3])):
                if copy:
                    copy[rng.randrange(len(copy))] = rng.choice("xyz")
            texts.append("".join(copy))
    return [*texts, None, "", "a" * 500, "ab" * 300, "x", texts[0], texts[0], " ".join([passages[0]] * 3)]


@pytest.mark.parametrize("length", [16, 40, 75])
@pytest.mark.parametrize("block", [1 << 18, 1])
def test_against_plain(spark, length, block, monkeypatch):
    monkeypatch.setattr(suffixdedup, "BLOCK", block)
    monkeypatch.setattr(suffixdedup, "SORT_STARTS", 100 * block)
    texts = corpus(length)
    want = plain(texts, length)
    df = spark.createDataFrame([(i, t, 3, 4) for i, t in enumerate(texts)], "i int, text string, spans int, rep int").repartition(4)
    for hot in (10**6, 2):
        got = {r.i: ([tuple(s) for s in r.spans], r.kept) for r in dedup_spans(df, length=length, hot_contexts=hot).collect()}
        for i, t in enumerate(texts):
            assert got[i][0] == want[i][0], (i, t)
            assert (bytes(got[i][1]) if t is not None else got[i][1]) == (want[i][1] if t is not None else None)


def test_anchors_own_every_start():
    rng = np.random.default_rng(1)
    for raw in (rng.integers(0, 3, size=5000), np.zeros(900), np.arange(400), np.arange(399)):
        rows = Anchors(400).of(raw.astype(np.uint8))
        owned = np.concatenate([np.arange(a, b + 1) for a, b in rows[1:3].T]) if rows.shape[1] else np.zeros(0)
        assert sorted(owned.tolist()) == list(range(max(0, raw.size - 399)))
        assert all(a <= p <= a + 200 and b <= p for p, a, b in rows[:3].T)


def test_trie_orders_and_groups():
    rng = random.Random(2)
    strings = ["".join(rng.choices("ab", k=12)).encode() for _ in range(300)]
    trie = Trie()
    for i, s in enumerate(strings):
        trie.add(s, i)
    groups = list(trie.ordered())
    assert [strings[g[0]] for g in groups] == sorted(set(strings))
    assert all(strings[i] == strings[g[0]] for g in groups for i in g) and sum(map(len, groups)) == 300
    assert common_prefix(b"abcd", b"abxd") == 2 and common_prefix(b"ab", b"ab") == 2 and common_prefix(b"", b"a") == 0


@pytest.mark.parametrize("shallow", [0, 8, 24, 64])
def test_sort_against_sets(shallow):
    rng = np.random.default_rng(3)
    base = rng.integers(97, 99, size=60).astype(np.uint8).tobytes()
    data = b"".join(base[: rng.integers(20, 60)] + rng.integers(97, 99, size=30).astype(np.uint8).tobytes() for _ in range(40))
    starts = np.arange(len(data) - 30)
    groups = rng.integers(0, 3, size=starts.size)
    got = repeated(data, starts, groups, 30, shallow)
    names = [(g, data[p : p + 30]) for g, p in zip(groups.tolist(), starts.tolist(), strict=True)]
    assert got.tolist() == [names.count(x) > 1 for x in names]


def test_empty(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id int, text string")
    assert dedup_spans(df.where("false")).count() == 0
    assert dedup_spans(df).collect()[0].asDict() == {"doc_id": 1, "text": "a", "spans": [], "kept": bytearray(b"a")}
    with pytest.raises(ValueError):
        dedup_spans(df, length=4)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = plain([t for _, t in docs], 400)
    got = QUERIES["op3_suffix"](spark, sf)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    rows = {r.doc_id: r for r in got.collect()}
    assert len(rows) == len(docs) and any(s for s, _ in want)
    for (doc, text), (spans, kept) in zip(docs, want, strict=True):
        n = len((text or "").encode())
        assert tuple(rows[doc]) == (doc, n, n - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
