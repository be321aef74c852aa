from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from specloom.llm import minhash
from specloom.llm.components import connected_components, linked_labels
from specloom.llm.jaccard import shingle_set
from specloom.llm.minhash import MinHash, edited, likeness, near_groups, next_fingerprints, printed
from specloom.llm.queries import QUERIES


def jaccard(a, b):
    a, b = shingle_set(a), shingle_set(b)
    both = np.intersect1d(a, b).size
    return both / max(1, a.size + b.size - both)


def words(rnd, n, names=5000):
    return " ".join(f"w{rnd.randrange(names)}" for _ in range(n))


def test_signature_is_the_smallest_value_of_each_permutation():
    hasher = MinHash(32)
    shingles = shingle_set(words(random.Random(1), 20_000))
    x = shingles >> np.uint64(32)
    want = [min((int(a) * v + int(b)) % 2**32 for v in x.tolist()) % 2**16 for a, b in zip(hasher.a[:, 0], hasher.b[:, 0], strict=True)]
    assert hasher.signature(shingles).tolist() == want
    assert all(int(a) % 2 for a in hasher.a[:, 0])


def test_likeness_estimates_jaccard():
    rnd, hasher = random.Random(2), MinHash()
    off = []
    for share in (0.0, 0.2, 0.5, 0.8, 0.95, 1.0):
        for _ in range(10):
            a = words(rnd, 400).split()
            cut = int(share * len(a))
            b = a[:cut] + words(rnd, 400 - cut).split()
            x, y = hasher.signatures([" ".join(a), " ".join(b)])
            off.append(likeness(x, y) - jaccard(" ".join(a), " ".join(b)))
    assert np.abs(off).max() < 0.17 and abs(np.mean(off)) < 0.02


def test_short_empty_and_long_texts():
    hasher = MinHash()
    none, blank, one, same, long = hasher.signatures([None, " \n", "Word", "word ", "x " * 300_000])
    assert none is None and blank is None and printed(None) == ""
    assert likeness(none, blank) == 1.0 and likeness(none, one) == 0.0 and likeness(one, same) == 1.0
    assert len(printed(long)) == 512 and likeness(long, hasher.signatures(["x x x x x x x"])[0]) == 1.0
    assert edited("abcde", "xyz") == "abcxy" and edited("abcde", "") == "abc" and edited("a", "b") == "a" and edited("", "b") == ""


def check_next(docs, got):
    """docs: (doc_id, text) in the order of the ids, which differ."""
    hasher = MinHash()
    got = {r.doc_id: r for r in got}
    assert len(got) == len(docs)
    for (i, t), (_, n) in zip(docs, [*docs[1:], *docs[:1]], strict=True):
        t, n = t or "", n or ""
        e = edited(t, n)
        a, b, c = hasher.signatures([t, e, n])
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (printed(a), printed(b))
        assert (r.near_edited, r.near_next) == (likeness(a, b), likeness(a, c))


@pytest.mark.parametrize("n", [0, 1, 2, 3, 150])
def test_next_document_across_ranges(spark, n):
    rnd = random.Random(n)
    docs = [(i * 3 - 50, rnd.choice([None, "", "é𝄞ß", words(rnd, rnd.randint(1, 60), 30)])) for i in range(n)]
    df = spark.createDataFrame(rnd.sample(docs, n), "doc_id bigint, text string").withColumn("part", F.lit("x")).withColumn("AT", F.lit(1))
    check_next(docs, next_fingerprints(df.repartition(3)).collect())


def test_null_and_repeated_ids(spark):
    rows = [(None, "n"), (5, "b b"), (5, "a a"), (5, "a a"), (9, "z")]
    got = next_fingerprints(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(((r.doc_id, r.n_chars) for r in got), key=str) == sorted(((i, len(t)) for i, t in rows), key=str)
    last = next(r for r in got if r.doc_id == 9)
    assert last.edited_sha256 == hashlib.sha256(b"z").hexdigest()


def test_query_against_a_loop(spark):
    sf = "/root/testdata/sf0.001"
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    check_next(docs, QUERIES["op13_minhash"](spark, sf).collect())


def test_groups_against_all_pairs(spark):
    rnd = random.Random(4)
    rows = [(None, None), (1, ""), (2, " \t"), (3, "one two"), (4, "ONE two"), (4, "one two"), (5, "one three")]
    for g in range(12):
        base = words(rnd, 200).split()
        for _ in range(rnd.randint(1, 9)):
            own = list(base)
            for _ in range(rnd.randint(0, 6)):
                own[rnd.randrange(len(own))] = words(rnd, 1)
            rows.append((100 + len(rows), " ".join(own)))
    rows += [(None, rows[-1][1]), (900, rows[-1][1])]
    texts = sorted({t for _, t in rows if t}, key=str)
    label = {t: t for t in texts}

    def top(t):
        while label[t] != t:
            t = label[t]
        return t

    for i, a in enumerate(texts):
        for b in texts[:i]:
            sa, sb = shingle_set(a), shingle_set(b)
            both = np.intersect1d(sa, sb).size
            if both and 100 * both >= 80 * (sa.size + sb.size - both):
                label[top(a)] = top(b)
    low: dict = {}
    for i, t in rows:
        if t and i is not None:
            low[top(t)] = min(low.get(top(t), i), i)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("band", F.lit(1)).withColumn("k1", F.lit("x"))
    got = sorted(map(str, ((r.doc_id, r.class_id) for r in near_groups(df).collect())))
    assert got == sorted(str((i, low[top(t)] if t else i)) for i, t in rows)
    assert near_groups(df.where("false")).collect() == []
    alone = near_groups(df.where("doc_id in (1, 3, 5)")).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in alone) == [(1, 1, 0), (3, 3, 0), (5, 5, 0)]


def test_groups_of_the_documents_are_those_of_the_exact_join(spark):
    sf = "/root/testdata/sf0.01"
    want = {r.doc_id: r.component_id for r in QUERIES["op8_jaccard"](spark, sf).collect()}
    assert {r.doc_id: r.class_id for r in QUERIES["minhash_groups"](spark, sf).collect()} == want


def test_size_estimates_do_not_grow_with_the_rounds_of_components(spark):
    """The estimate of a checkpoint multiplied with each round, up to thousands of digits in the driver."""
    chain = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    labels = connected_components(chain)
    size = labels._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    assert int(size.toString() if hasattr(size, "toString") else size).bit_length() < 64
    assert sorted(map(tuple, labels.collect())) == [(i, 0) for i in range(301)]


def test_pairs_that_were_not_similar_do_not_meet_again(spark, monkeypatch):
    """A round is over all texts that are still apart, so the job took as long as the last of many rounds."""
    rnd, rows, apart = random.Random(6), [], 20
    for g in range(apart):
        base = words(rnd, 80).split()
        other = base[:60] + words(rnd, 20).split()
        rows += [(2 * g, " ".join(base)), (2 * g + 1, " ".join(other))]
    base = words(rnd, 200)
    rows += [(1000 + i, f"{base} end{i}") for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    verified, met = minhash._verified, []

    def counted(keyed, texts, pairs, *options):
        met.append(sorted(map(tuple, pairs.collect())))
        return verified(keyed, texts, pairs, *options)

    monkeypatch.setattr(minhash, "_verified", counted)
    got = {r.doc_id: (r.class_id, r.n_links) for r in near_groups(df).collect()}
    assert all(got[i] == (i, 0) for i in range(2 * apart))
    assert all(got[1000 + i][0] == 1000 for i in range(5))
    assert len(met) > 1 and len(met[0]) > apart // 2
    assert sum(len(x) for x in met) == len({p for x in met for p in x})


@pytest.mark.parametrize("local_edges", [100_000, 0])
def test_further_links_give_the_components_of_all(spark, local_edges):
    rnd = random.Random(3)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)]
    table = lambda part: spark.createDataFrame(part, "a bigint, b bigint")
    labels = connected_components(table(edges[:90]))
    for part in (edges[90:120], edges[120:], edges[:5]):
        labels = linked_labels(labels, table(part), local_edges)
    got = sorted(map(tuple, labels.collect()))
    assert got == sorted(map(tuple, connected_components(table(edges)).collect())) and len(got) > 100
