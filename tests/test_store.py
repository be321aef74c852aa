"""Published records: repeated, overlapping, concurrent and broken runs."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from specloom.sources.store import Store

SCHEMA = T.StructType().add("grp", "string").add("name", "string").add("n", "integer").add("deep", T.StructType().add("x", "integer"))
T0 = dt.datetime(2024, 1, 1)


def store(spark, path):
    return Store(spark, str(path), SCHEMA, ["grp", "name"], ["grp"])


def rows(spark, *items):
    return spark.createDataFrame([(g, n, i, (i,)) for g, n, i in items], SCHEMA)


def groups(spark, *names, at=T0):
    return spark.createDataFrame([(g, at) for g in names], "grp string, done_at timestamp")


def held(s):
    return sorted(((r.grp, r.name, r.n, r.deep.x) for r in s.records().collect()), key=str)


def test_first_writer_wins_and_a_second_run_writes_nothing(spark, tmp_path):
    s = store(spark, tmp_path)
    first = rows(spark, ("a", "x", 2), ("a", "x", 1), ("b", None, 3), (None, "y", 4))
    assert s.publish(first, groups(spark, "a", "b", None)) == 3
    assert s.publish(first, groups(spark).where("false")) == 0
    assert len(s.commits()) == 1
    assert s.publish(rows(spark, ("a", "x", 9), ("a", "z", 5), ("b", None, 9), (None, "y", 9)), groups(spark, "a")) == 1
    assert held(s) == [("a", "x", 1, 1), ("a", "z", 5, 5), ("b", None, 3, 3), (None, "y", 4, 4)]


def test_a_run_that_dies_leaves_nothing(spark, tmp_path):
    s = store(spark, tmp_path)
    broken = rows(spark, ("a", "x", 1), ("a", "y", 0)).withColumn("n", F.when(F.col("n") == 0, F.raise_error(F.lit("stop")).cast("int")).otherwise(F.col("n")))
    with pytest.raises(Exception, match="stop"):
        s.publish(broken, groups(spark, "a"))
    s._write(rows(spark, ("a", "x", 7)), groups(spark, "a"), "not-committed", [])
    assert held(s) == [] and s.commits() == [] and s.groups().collect() == []
    assert s.publish(rows(spark, ("a", "x", 1)), groups(spark, "a")) == 1


def test_the_later_of_two_overlapping_runs_leaves_out_what_the_other_has(spark, tmp_path):
    one, two = store(spark, tmp_path), store(spark, tmp_path)
    other = rows(spark, ("a", "x", 2), ("b", "y", 2))
    commit = two._commit

    def late(number, batch):
        if number == 0 and not one.commits():
            one.publish(rows(spark, ("a", "x", 1), ("c", "z", 1)), groups(spark, "a", "c"))
        return commit(number, batch)

    two._commit = late
    assert two.publish(other, groups(spark, "a", "b")) == 1
    assert held(one) == [("a", "x", 1, 1), ("b", "y", 2, 2), ("c", "z", 1, 1)] and len(one.commits()) == 2


def test_runs_at_the_same_time(spark, tmp_path):
    stores = [store(spark, tmp_path) for _ in range(4)]
    work = [rows(spark, *[("g", str(k), i) for k in range(i, i + 6)]) for i in range(4)]
    with ThreadPoolExecutor(4) as pool:
        counts = list(pool.map(lambda p: p[0].publish(p[1], groups(spark, "g")), zip(stores, work, strict=True)))
    got = held(stores[0])
    assert len(got) == 9 == sum(counts) and len({r[1] for r in got}) == 9


def test_stale_work_only(spark, tmp_path):
    s = store(spark, tmp_path)
    made = []

    def make(due):
        names = sorted(r.grp for r in due.collect())
        made.append(names)
        return rows(spark, *[(g, "x", len(made)) for g in names])

    def work(**times):
        return spark.createDataFrame([(g, T0 + dt.timedelta(days=d)) for g, d in times.items()], "grp string, input_time timestamp")

    now = lambda d: F.lit(T0 + dt.timedelta(days=d))
    assert s.run(work(a=0, b=0), make, now(1)) == 2
    assert s.run(work(a=0, b=0), make, now(2)) == 0
    assert s.run(work(a=0, b=5, c=0), make, now(6)) == 1
    assert s.run(work(a=0, b=5, c=0), make, now(7)) == 0
    assert made == [["a", "b"], ["b", "c"]] and len(s.commits()) == 2
    assert held(s) == [("a", "x", 1, 1), ("b", "x", 1, 1), ("c", "x", 2, 2)]
