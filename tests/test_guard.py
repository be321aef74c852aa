"""Runs that stop on the first error."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from specloom.operators import guard, mapping
from specloom.operators.mapping import Rule
from specloom.plans.job import device_outcome
from specloom.sources.sheets import write_records
from specloom.sources.store import Store
from tests.test_mapping import SHEET, mapped, rows
from tests.test_tables import CONFIG, FRAGMENT, page

RULES = [Rule(["model"], row=("includes", "Model")), Rule(["general_data.weigth"], row=("exact", "Weight"), fn="numbers")]
BAD = Rule(["pv_input.v_nom"], row=("exact", "Input Voltage"))


def test_clean_input_gives_what_the_lenient_run_gives(spark):
    df = rows(spark, *SHEET)
    assert mapped(spark, df, RULES) == [json.loads(r) for r in mapping.typed_records(mapping.fill_sheets(df, {"main": RULES}), on_error="stop").orderBy("sheet_id", "col_idx").toJSON().collect()]
    with pytest.raises(ValueError, match="on_error"):
        mapping.typed_leaves(df, on_error="ignore")


def test_a_bad_value_stops_the_job_before_the_sink_commits(spark, tmp_path):
    filled = mapping.fill_sheets(rows(spark, *SHEET), {"main": [*RULES, BAD]})
    records = mapping.typed_records(filled, on_error="stop")
    # also where the bad column itself is not read
    for df in (records, records.select("model"), records.groupBy().count()):
        with pytest.raises(Exception, match="sheet s, column 0, pv_input.v_nom"):
            df.collect()
    with pytest.raises(Exception, match="pv_input.v_nom"):
        write_records(records, str(tmp_path / "out"), [])
    assert not [p for p in (tmp_path / "out").rglob("*") if p.name.startswith("part-") and "_temporary" not in str(p)]
    named = records.withColumn("file_name", F.concat("sheet_id", "col_idx"))
    store = Store(spark, str(tmp_path / "store"), named.schema, ["file_name"], ["sheet_id"])
    with pytest.raises(Exception, match="pv_input.v_nom"):
        store.publish(named, spark.createDataFrame([("s", None)], "sheet_id string, done_at timestamp"))
    assert store.commits() == [] and store.records().collect() == []


def test_rejects_stop_the_whole_job(spark):
    fragments = spark.createDataFrame(page("d", "none"), FRAGMENT)
    config = spark.createDataFrame([("s", "d", 1, 0.0, 10.0, 202.0, 200.0, "none", False, False)], CONFIG)
    rules = {"main": [Rule(["model"], row=("includes", "Model"))]}
    fixed = spark.createDataFrame([("s", 0, "Nothing", [3])], "sheet_id string, fix_id int, row_text string, spans array<int>")
    lenient = device_outcome(fragments, config, rules, fixed=fixed)
    assert lenient.records.count() > 0 and lenient.unresolved.count() == 1 and lenient.uneven.count() == 1
    with pytest.raises(Exception, match="sheet s (fixed span: Nothing|row: cells do not fit)"):
        device_outcome(fragments, config, rules, fixed=fixed, on_error="stop").records.collect()


def test_rejects_without_rows_let_the_records_pass(spark):
    records = spark.range(5)
    none = spark.createDataFrame([], "reason string")
    assert guard.stop_on_rejects(records, none, F.col("reason")).count() == 5
    with pytest.raises(Exception, match="rejected"):
        guard.stop_on_rejects(records, spark.createDataFrame([(None,)], "reason string"), F.col("reason")).count()


def test_rows_that_were_taken_away_stop_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, "bad")], "id int, reason string")
    gone = df.where("reason is not null").select("id")
    assert [r.id for r in guard.stop_on(df.join(gone, "id", "left_anti"), F.col("reason")).collect()] == [1]
