from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from specloom.llm import ann
from specloom.llm.ann import Index, exact_neighbours, fit, usable
from specloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def brute(rows, queries, k):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], dtype=np.float64)
    out = {}
    for q, v in queries:
        score = (x * np.array(v, dtype=np.float64)).sum(axis=1)
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(score[i])) for i in order]
    return out


def results(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_tree_covers_all_rows_and_leaves():
    x = np.random.default_rng(2).normal(size=(3000, 8))
    tree = fit(x, 37)
    assert tree.leaves == 37 and sorted(n for n in tree.leaf if n >= 0) == list(range(37))
    assert set(tree.assign(x).tolist()) <= set(range(37))
    assert sorted(tree.visit(x[0])) == list(range(37))
    assert fit(np.ones((50, 4)), 5).leaves == 1


def test_query_recall_against_brute_force(spark):
    got_frame = QUERIES["op9_ann"](spark, SF)
    assert got_frame.columns == ["query_id", "rank", "vec_id", "score"]
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = brute(rows, [r for r in rows if r[0] % 20 == 0], 20)
    got = results(got_frame)
    assert set(got) == set(want)
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9
    x = dict(rows)
    for q, found in got.items():
        assert len(found) == 20 and all(math.isclose(s, float((np.array(x[q], dtype=float) * np.array(x[v], dtype=float)).sum()), abs_tol=1e-12) for v, s in found)


def test_recall_with_many_leaves_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "LEAF_ROWS", 20)
    monkeypatch.setattr(ann, "BLOCK_ROWS", 64)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 30)
    monkeypatch.setattr(ann, "SAMPLE_ROWS", 900)
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(12, 16))
    rows = [(i, (centers[i % 12] + 0.3 * rng.normal(size=16)).tolist()) for i in range(1500)] + [(2000 + i, (3 * centers[0]).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    index = Index(df, k=10)
    assert 1 <= index.visits <= index.tree.leaves and (index.recall >= 0.96 or index.visits == index.tree.leaves)
    got = results(index.search(df.where("vec_id % 20 = 0")))
    want = brute(rows, [r for r in rows if r[0] % 20 == 0], 10)
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9
    # Equal vectors: ties to the smaller id.
    assert [v for v, _ in got[2000]] == [v for v, _ in want[2000]] == list(range(2001, 2011))


def test_exact_scan(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=4).tolist(), i % 3) for i in range(100)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(3)
    asked = df.where("vec_id < 5").toPandas()
    got = exact_neighbours(df, asked, 7).collect()
    want = brute(rows, [r[:2] for r in rows[:5]], 7)
    assert {(r.query_id, r["rank"], r.vec_id, r.label) for r in got} == {(q, i + 1, v, v % 3) for q, x in want.items() for i, (v, _) in enumerate(x)}


@pytest.mark.parametrize("n", [0, 1, 2, 8])
def test_small_and_bad_rows(spark, n):
    good = [(i, [float(i + 1), 1.0], 9) for i in range(n)]
    bad = [(100, None, 9), (120, [0.0, 0.0], 9), (140, [1.0, None], 9), (160, [float("nan"), 1.0], 9), (180, [float("inf"), 1.0], 9), (None, [1.0, 1.0], 9), (200, [], 9)]
    df = spark.createDataFrame(good + bad, "vec_id bigint, embedding array<double>, score int")
    assert usable(df).count() == n
    got = results(Index(df, k=5).search(df.where(F.col("vec_id") % 2 == 0)))
    assert got == {q: x for q, x in brute([r[:2] for r in good], [r[:2] for r in good if r[0] % 2 == 0], 5).items() if x} if n else got == {}


def test_repeated_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.5, 0.5]), (1, [0.5, 0.5]), (2, [0.0, 1.0])], "vec_id bigint, embedding array<double>")
    got = results(Index(df, k=5).search(df.where("vec_id = 0")))
    assert [v for v, _ in got[0]] == [1, 1, 2]


def test_each_dimension_is_searched_for_itself(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 7)
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=8 if i % 3 else 5).tolist()) for i in range(300)] + [(900, [1.0]), (901, None), (902, [0.0] * 8), (903, [float("nan")] * 8)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in ann.search_each(df, df.where("vec_id % 10 = 0"), k=4).collect())
    want = []
    for q, x in rows:
        if q % 10 or x is None:
            continue
        others = [(-float(np.dot(x, y)), v) for v, y in rows if y is not None and len(y) == len(x) and v != q and any(y) and not np.isnan(y).any()]
        want += [(q, n + 1, v, round(-s, 9)) for n, (s, v) in enumerate(sorted(others)[:4])]
    near = {(q, v) for q, _, v, _ in want}
    assert len({(q, v) for q, _, v, _ in got} & near) >= 0.9 * len(near) and not any(q == 900 for q, *_ in got)
    assert ann.search_each(df.where("false"), df, 4).collect() == []
