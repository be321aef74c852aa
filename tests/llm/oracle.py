"""Runs a query and its oracle text over the same tables."""

from __future__ import annotations

import duckdb

from specloom.llm.queries import ORACLES

TABLES = ["documents", "benchmark", "pages", "embeddings", "conversations"]


def assert_oracle(spark, name, queries, sf="/root/testdata/sf0.01"):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    got = queries[name](spark, sf)
    assert sorted(columns) == sorted(got.columns)
    mine = sorted(str(tuple(r[c] for c in columns)) for r in got.collect())
    theirs = sorted(str(tuple(r)) for r in want.fetchall())
    assert len(mine) == len(theirs)
    assert mine == theirs
