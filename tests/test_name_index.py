"""Names among the fragments of a sheet."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from specloom.operators.name_index import find_names


def brute(fragments, names):
    out = []
    for s, n in sorted(set(names), key=str):
        if n is None:
            continue
        texts = [(f, t) for q, f, t in fragments if q == s and t is not None]
        exact, some = [f for f, t in texts if t == n], [f for f, t in texts if n in t]
        if some:
            box = min(exact) if len(exact) == 1 else min(some)
            out.append((s, n, len(exact), None if len(exact) == 1 else len(some), box))
    return sorted(map(str, out))


def found(spark, fragments, names):
    df = spark.createDataFrame(fragments, "sheet_id long, frag_id int, text string").withColumns({"minx": F.lit(1.0), "piece": F.lit("clash")})
    got = find_names(df, spark.createDataFrame(names, "sheet_id long, name string"), ["minx"])
    return sorted(str((r.sheet_id, r.name, r.n_exact, r.n_any, r.box.frag_id)) for r in got.collect())


@pytest.mark.parametrize(("seed", "broadcast"), [(1, 100_000), (2, 0)])
def test_against_every_pair(spark, seed, broadcast):
    rnd = random.Random(seed)
    words = ["Power", "Max", "Maxi", "é", "", "V", "AC", "a.b", "\u0001x", "Po", "wer P"]
    fragments = [(rnd.randrange(5), i, None if rnd.random() < 0.05 else " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 4)))) for i in range(300)]
    names = [(rnd.randrange(6), rnd.choice([*words, "Max Power", "x V", None, "Power Power", "ax"])) for _ in range(200)]
    spark.conf.set("specloom.broadcastRows", str(broadcast))
    try:
        assert found(spark, fragments, names) == brute(fragments, names)
    finally:
        spark.conf.unset("specloom.broadcastRows")


def test_empty(spark):
    assert found(spark, [], [(1, "abc")]) == [] and found(spark, [(1, 1, "abc")], []) == []


def test_many_names_in_one_sheet_meet_few_fragments(spark):
    n = 20_000
    fragments = spark.range(n).select(F.lit(1).cast("long").alias("sheet_id"), F.col("id").cast("int").alias("frag_id"), F.format_string("Item %06d", "id").alias("text"))
    names = spark.range(0, n, 4).select(F.lit(1).cast("long").alias("sheet_id"), F.format_string("m %06d", "id").alias("name"))
    got = find_names(fragments, names, [])
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()
    rows = got.select("name", "n_any", "box.frag_id").collect()
    assert len(rows) == n // 4 and all(r.n_any == 1 and r.name == f"m {r.frag_id:06d}" for r in rows)
