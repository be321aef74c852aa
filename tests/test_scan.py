"""The chunked passes must agree with plain windows, whatever the size of a key."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from specloom.operators import clusters, scan
from specloom.operators.joins import lookup_join

STEPS = {
    "s": lambda: scan.running_sum(F.col("v")),
    "m": lambda: scan.running_min(F.col("v")),
    "b": lambda: scan.max_before(F.col("v")),
    "p": lambda: scan.position(),
    "prev": lambda: scan.previous(F.col("v")),
    "foll": lambda: scan.following(F.col("v")),
    "last": lambda: scan.last_known(F.col("n")),
    "next": lambda: scan.next_known(F.col("n")),
}


def skewed(spark, rows=120, seed=3):
    rnd = random.Random(seed)
    data = [("hot" if i % 3 else f"k{i % 7}", i, rnd.randint(-9, 9), rnd.choice([None, None, i])) for i in range(rows)]
    return spark.createDataFrame(data, "k string, o int, v int, n int")


def test_chunked_passes_equal_windows(spark):
    df = skewed(spark)
    steps = {n: make() for n, make in STEPS.items()}
    plain = scan.run(df, ["k"], ["o"], steps, hot=False)
    chunked = scan.run(df, ["k"], ["o"], steps, hot=True, limit=11)
    assert set(plain.columns) == set(chunked.columns)
    assert sorted(map(str, plain.collect())) == sorted(map(str, chunked.select(plain.columns).collect()))


def test_hot_key_is_noticed(spark):
    df = skewed(spark)
    assert scan.has_hot_key(df, ["k"], 50)
    assert not scan.has_hot_key(df, ["k"], 100)
    assert not scan.has_hot_key(df, ["k"], 1000)


def test_ordered_text_of_a_hot_key(spark):
    df = skewed(spark).withColumn("t", F.col("o").cast("string"))
    plain = scan.ordered_text(df, ["k"], ["o"], "t", ",", {"o": F.max("o")}, hot=False)
    chunked = scan.ordered_text(df, ["k"], ["o"], "t", ",", {"o": F.max("o")}, hot=True, limit=13)
    assert sorted(map(str, plain.collect())) == sorted(map(str, chunked.collect()))


def test_totals_of_a_hot_key(spark):
    df = skewed(spark)
    plain = scan.totals(df, ["k"], {"t": F.sum("v")}, hot=False)
    joined = scan.totals(df, ["k"], {"t": F.sum("v")}, hot=True)
    assert sorted(map(str, plain.collect())) == sorted(map(str, joined.collect()))


def anchored(values, eps):
    out, anchor, cluster = {}, None, -1
    for v in sorted(values):
        if anchor is None or v - anchor > eps:
            anchor, cluster = v, cluster + 1
        out[v] = cluster
    return out


@pytest.mark.parametrize("limit", [None, 8])
def test_anchored_clusters(spark, limit):
    rnd = random.Random(5)
    data = [(k, i, rnd.randint(0, 90)) for k in ("a", "b") for i in range(40)]
    df = spark.createDataFrame(data, "k string, id int, v int")
    got = {(r["k"], r["id"]): r["cluster_id"] for r in clusters.cluster_anchor(df, ["k"], "v", 7, limit=limit).collect()}
    for key in ("a", "b"):
        want = anchored([v for k, _, v in data if k == key], 7)
        assert all(got[(k, i)] == want[v] for k, i, v in data if k == key)


@pytest.mark.parametrize("limit", [None, 2])
def test_anchored_clusters_of_fractions(spark, limit):
    """A sum and a difference of doubles round differently; both paths go by the difference."""
    rnd = random.Random(3)
    data = {"a": [0.3, 0.35, 0.4, 0.45, 0.5], "b": sorted({round(rnd.randrange(60) / 20, 2) for _ in range(40)}), "c": [rnd.random() for _ in range(40)]}
    df = spark.createDataFrame([(k, v) for k, vs in data.items() for v in vs], "k string, v double")
    got = {(r["k"], r["v"]): r["cluster_id"] for r in clusters.cluster_anchor(df, ["k"], "v", 0.1, limit=limit).collect()}
    for k, vs in data.items():
        assert {v: got[(k, v)] for v in vs} == anchored(vs, 0.1)


def test_gap_clusters_of_a_hot_key(spark):
    df = skewed(spark)
    plain = clusters.cluster_gap(df, ["k"], "v", ["o"], 1, hot=False)
    chunked = clusters.cluster_gap(df, ["k"], "v", ["o"], 1, hot=True, limit=10)
    assert sorted(map(str, plain.collect())) == sorted(map(str, chunked.select(plain.columns).collect()))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_broadcast_join(spark, how):
    big = skewed(spark)
    small = spark.createDataFrame([("hot", 1), ("hot", 5), ("k1", 0), ("zz", 9)], "k string, w int")
    cond = F.col("v") >= F.col("w")
    a = lookup_join(big, small, ["k"], cond, how)
    b = lookup_join(big, small, ["k"], cond, how, limit=2)
    assert "Broadcast" in a._jdf.queryExecution().simpleString()
    assert sorted(map(str, a.collect())) == sorted(map(str, b.select(a.columns).collect()))
