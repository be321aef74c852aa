"""Registered queries against their oracle text on the smallest given tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from check import compare
from specloom.plans.catalog import ORACLES, QUERIES
from specloom.plans.views import TABLES

SF = "/root/testdata/sf0.001"
LIGHT = [
    "reshape_wide",
    "rule_row_join",
    "first_filled_wins",
    "coerce_typed",
    "sink_device_json",
    "spec_diff",
    "total_per_panel",
    "inherit_defaults",
    "stale_stage",
    "html_columnize",
    "table_json_match",
    "cluster_anchor",
    "src_glyph_runs",
    "nearest_fragment",
    "src_spec_csv",
    "sink_column_json",
    "solve_bounds",
    "assign_rows",
    "resolve_colspans",
    "spec_sheets",
    "spec_end_to_end",
    "rule_row_index",
    "spec_diff_nested",
    "sink_repeatable",
    "quarantine_stop",
    "find_inside",
    "find_touching",
    "html_nested",
    "add_cell",
    "quarantine_fixes",
    "device_setups",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", LIGHT)
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF)
    res = duck.execute(oracle_sql()[name])
    want = [d[0] for d in res.description]
    assert compare(name, df.columns, [tuple(r) for r in df.collect()], want, res.fetchall()) is None
