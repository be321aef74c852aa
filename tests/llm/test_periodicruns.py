from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from specloom.llm.periodicruns import Extension, SuffixTree, candidate_pieces, find_runs, periodic_runs
from specloom.llm.queries import QUERIES


def brute(words, least=6, power=4):
    """Runs by trying every period."""
    n, out = len(words), []
    for q in range(1, n // power + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j + q - i
            if j > i and size >= max(least, power * q) and not any(words[i : j + q - d] == words[i + d : j + q] for d in range(1, q)):
                out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def as_rows(found):
    return [tuple(r) for r in found.T.tolist()]


def test_tree_ranks_and_extensions():
    rnd = random.Random(5)
    for _ in range(200):
        text = [1 + rnd.randrange(rnd.choice([1, 2, 4])) for _ in range(rnd.randint(1, 40))] + [0]
        n = len(text)
        rank, other, turns = SuffixTree(text, 5).tour(1)
        assert np.argsort(rank).tolist() == sorted(range(n), key=lambda i: text[i:])
        assert np.argsort(other).tolist() == sorted(range(n), key=lambda i: [5 - c if c else 0 for c in text[i:]])
        a, b = (np.array([rnd.randrange(n) for _ in range(50)]) for _ in range(2))
        a, b = a[a != b], b[a != b]
        want = [next(k for k in range(n) if max(i, j) + k == n or text[i + k] != text[j + k]) for i, j in zip(a, b, strict=True)]
        assert Extension(rank, turns).of(a, b).tolist() == want


@pytest.mark.parametrize("seed", range(4))
def test_runs_against_every_period(seed):
    rnd = random.Random(seed)
    for _ in range(150):
        texts = []
        for _ in range(rnd.randint(0, 5)):
            symbols, words = rnd.choice([1, 2, 3, 9]), []
            size = rnd.randint(0, 70)
            while len(words) < size:
                root = [rnd.randrange(symbols) for _ in range(rnd.randint(1, 6))]
                words += root * rnd.randint(1, 9) if rnd.random() < 0.5 else root
            texts.append([b"%d" % w for w in words])
        for words, found in zip(texts, find_runs(texts), strict=True):
            assert as_rows(found) == brute(words)


def test_pieces_hold_every_run():
    rnd = random.Random(3)
    words = [rnd.randrange(400) for _ in range(900)] + list(range(500, 540)) * 6 + [rnd.randrange(400) for _ in range(900)]
    begin, end = candidate_pieces(np.zeros(len(words), dtype=np.int64), np.array(words))
    assert (end - begin).sum() < 300
    (start, size, q), = brute(words)
    assert q == 40 and any(a <= start and start + size <= b for a, b in zip(begin, end, strict=True))


def test_long_period_and_one_word():
    rnd = random.Random(8)
    root = [b"%d" % rnd.randrange(60) for _ in range(700)]
    assert as_rows(find_runs([root * 5 + root[:100]])[0]) == [(0, 3600, 700)]
    assert as_rows(find_runs([[b"a"] * 20000])[0]) == [(0, 20000, 1)]


def test_texts_with_odd_blanks_nulls_and_copies(spark):
    rows = [
        (1, None),
        (2, ""),
        (3, " \t\n"),
        (4, "a a a a a"),
        (5, "x a a a a a a y"),
        (5, "x a a a a a a y"),
        (None, "A a A a A a A a\x0bb"),
        (7, "p q p q p q p q p q p q"),
        (8, "a b c\x1fa " * 9),
        (9, "one two three " * 4000),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("runs", F.lit("kept"))
    got = df.select("doc_id", "text", "runs", periodic_runs(F.col("text")).alias("found")).collect()
    assert len(got) == len(rows)
    for r in got:
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        runs = brute(words)
        assert [tuple(x) for x in r.found.runs] == runs and r.runs == "kept"
        assert r.found.collapsed == " ".join(collapsed(words, runs))
    assert df.where("false").select(periodic_runs(F.col("text"))).collect() == []


def test_query_against_every_period(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in QUERIES["op12_periodic"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    some = 0
    for d in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", d.text or "")
        n, h = len(words), zlib.crc32(str(d.doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute(words)
        some += len(runs)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        want = (len(runs), *best, 1000 * best[1] // best[2] if runs else None)
        r = got[d.doc_id]
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == want
        assert r.runs_sha256 == digest("".join(f"{s},{m},{q}\n" for s, m, q in runs))
        assert r.collapsed_sha256 == digest(" ".join(collapsed(words, runs)))
    assert some > 5
