"""How large sides of joins and frames of many passes are dealt."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from specloom.operators import find, nearest, scan
from specloom.operators import tables as T
from specloom.operators.joins import lookup_join


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def pages(spark, tmp_path):
    """Fragments and settings of many pages in files of a few kB, as equal values are written once."""
    path = str(tmp_path / "pages")
    spark.range(0, 2000, 1, 2).selectExpr("id AS doc_id", "1 AS page").write.parquet(path)
    docs = spark.read.parquet(path)
    box = {"minx": 10.0, "miny": 10.0, "maxx": 20.0, "maxy": 20.0}
    fragments = docs.select("doc_id", "page", F.explode(F.sequence(F.lit(0), F.lit(49))).alias("frag_id"), F.lit("7").alias("text"), *[F.lit(v).alias(c) for c, v in box.items()])
    sides = {c: F.lit(100.0 * (c in "wh")) for c in "xywh"}
    config = docs.select(F.col("doc_id").alias("sheet_id"), "doc_id", "page", *[v.alias(c) for c, v in sides.items()], F.lit("none").alias("sections"))
    return fragments, config.withColumns({f"multiline_{k}_header": F.lit(False) for k in ("row", "section")})


def test_sides_as_large_as_the_data_are_not_broadcast_on_an_estimate(spark, pages):
    fragments, config = pages
    requests = config.select("doc_id", "page", F.lit(0).alias("find_id"), *[F.lit(v).alias(f"q_{c}") for c, v in zip(T.BOX, (0.0, 0.0, 50.0, 50.0), strict=True)])
    anchors = fragments.select("doc_id", "page", F.col("frag_id").alias("anchor_id"), *[F.col(c).alias(f"a_{c}") for c in T.BOX])
    named = config.select("sheet_id", F.lit("row").alias("row_text"), F.lit(0).alias("line_no"))
    made = {
        "area": T.area_filter(fragments, config, 10**9),
        "find": find.find(requests, fragments, hot=False),
        "nearest": nearest.nearest_fragment(anchors, fragments, "right", pages=nearest.page_boxes(fragments)),
        "fixes": T.unresolved_fixes(named.drop("line_no"), named),
        "lookup": lookup_join(fragments, config.select("doc_id"), ["doc_id"], small_rows=10**9),
    }
    assert [name for name, df in made.items() if "Broadcast" in plan(df)] == []
    assert made["area"].count() == 100_000


def test_partitions_of_many_passes_grow_with_the_rows(spark, pages):
    fragments, config = pages
    few, many = (plan(T.lined_frame(fragments, config, T.settings_of(config, n), hot=False)) for n in (100, 20 * scan.PASS_ROWS))
    dealt = [[int(n) for n in re.findall(r"hashpartitioning\(sheet_id#\d+L?, (\d+)\), REPARTITION_BY_NUM", p)] for p in (few, many)]
    assert dealt == [[5], [20]]


def test_dealt_rows_stay_apart_from_the_join_before(spark, pages):
    """The join deals by the same key in the session's number; the frame keeps an exchange of its own."""
    fragments, config = pages
    joined = T.area_filter(fragments, config, 10**9)
    assert T.by_sheet(joined, False, 0).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) + 1


# Queries of the chain of reconstruction whose sides grow with the sheets.
CHAIN = [
    "disputed_rows",
    "resolve_cols_by_edges",
    "row_clusters",
    "section_by_center",
    "section_by_first_col",
    "span_join",
    "certain_cells",
    "colspan_expand",
    "merge_fragments",
    "quarantine_spans",
]


@pytest.mark.parametrize("name", CHAIN)
def test_query_of_many_sheets_is_planned_without_a_broadcast(spark, tmp_path, name):
    """Sheets beyond the checked number, in a file of a few kB that Spark takes for a small side."""
    text = [F.lit(v).alias(c) for c, v in (("p_name", "a b"), ("p_brand", "c"), ("p_type", "d"))]
    parts = spark.range(0, 64, 1, 2).select(F.col("id").alias("p_partkey"), *text, (F.col("id") % 50 + 1).cast("int").alias("p_size"), F.lit(1.5).alias("p_retailprice"))
    parts.write.parquet(str(tmp_path / "part.parquet"))
    # On so few rows most of the time is that of compiling them.
    conf = {"specloom.broadcastRows": "3", "spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN"}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        assert "Broadcast" not in plan(queries()[name](spark, str(tmp_path)))
    finally:
        for key in conf:
            spark.conf.unset(key)
