from __future__ import annotations

import numpy as np
import pytest

from specloom.llm.sharding import Feistel, feistel_shards, locate, number_at, number_rows


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 40, 41, 1000, 4097])
def test_permutation_and_inverse(n):
    f = Feistel(n)
    x = np.arange(n)
    y = f.forward(x)
    assert sorted(y.tolist()) == list(range(n))
    assert (f.backward(y) == x).all()


def test_seed_and_address():
    assert (Feistel(500, 1).forward(np.arange(500)) != Feistel(500, 2).forward(np.arange(500))).any()
    shard, slot = locate(np.arange(103), 103, 7)
    assert (number_at(shard, slot, 103, 7) == np.arange(103)).all()
    sizes = np.bincount(shard)
    assert sizes.max() - sizes.min() <= 1
    with pytest.raises(ValueError):
        locate([103], 103, 7)


def test_rows_with_nulls_copies_and_extra_columns(spark):
    rows = [(None, "a", 1), (1, None, 1), (1, "a", 1)] + [(7, "x", 2)] * 5000 + [(i, "t", 3) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, `odd name` int")
    got = feistel_shards(df.repartition(5), 9).collect()
    assert sorted(r.row_number for r in got) == list(range(len(rows)))
    assert sorted(str(tuple(r)[:3]) for r in got) == sorted(map(str, rows))
    for k in range(9):
        slots = sorted(r.slot for r in got if r.shard == k)
        assert slots == list(range(len(slots)))
    again = feistel_shards(df.repartition(2), 9).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_empty_and_clash(spark):
    df = spark.createDataFrame([], "doc_id bigint")
    assert number_rows(df)[1] == 0
    assert feistel_shards(df, 4).count() == 0
    clash = feistel_shards(spark.createDataFrame([(1, 5), (2, 6)], "doc_id int, SHARD int"), 4).collect()
    assert sorted((r.doc_id, r.row_number) for r in clash) in ([(1, 0), (2, 1)], [(1, 1), (2, 0)]) and all(r.slot == 0 for r in clash)
    with pytest.raises(ValueError):
        feistel_shards(df, 0)


def test_any_column_name_passes(spark):
    names = ["_copies", "_bucket", "_n", "_start", "_before", "_first", "_chunk", "_place", "_number", "row", "copies"]
    df = spark.createDataFrame([(i, *[i * 10 + k for k in range(len(names))]) for i in [0, 1, 2, 2, 2, 3]], ["doc_id", *names])
    got = feistel_shards(df, 3).collect()
    assert sorted(r.row_number for r in got) == list(range(6))
    assert sorted(tuple(r)[: len(names) + 1] for r in got) == sorted(map(tuple, df.collect()))
    numbered, n = number_rows(df, "_first_number")
    assert n == 6 and sorted(r._first_number for r in numbered.collect()) == list(range(6))
