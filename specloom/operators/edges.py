"""Older column variant: cell edges from centres, matched to header edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specloom.operators import scan
from specloom.operators.tables import per_sheet

ROW = ["sheet_id", "row_id"]
EDGE_EPS = 15  # fixed value: a cell edge must lie within this of a column edge


def left_edges(centres: DataFrame, keys: list[str], end: str, *, hot: bool | None = None) -> DataFrame:
    """Left edge of each item from the right: e = 2 * middle - edge of the next one.

    With alternating signs that is a running sum from the right, started at the end of the area.
    """
    placed = centres.withColumn("_neg", -F.col("centre"))
    numbered = scan.run(placed, keys, ["_neg"], {"_k": scan.position()}, hot=hot)
    sign = F.when(F.col("_k") % 2 == 0, 1.0).otherwise(-1.0)
    summed = scan.run(numbered, keys, ["_neg"], {"_s": scan.running_sum(sign * 2 * F.col("centre"))}, hot=hot)
    return summed.withColumn("edge", sign * (F.col("_s") - F.col(end))).drop("_neg", "_k", "_s")


def resolve_cols_by_edges(centres: DataFrame, header: DataFrame, *, hot: bool | None = None) -> DataFrame:
    """Column range of each cluster: it starts at the first column whose left edge is less than 15
    from its own and ends where the next cluster starts; a row with an unmatched edge is dropped.

    centres: sheet_id, row_id, cluster_id, centre, area_maxx; header: sheet_id, centre, area_maxx.
    The header array has one value per column of the table.
    """
    columns = left_edges(header, ["sheet_id"], "area_maxx", hot=hot)
    arrays = columns.groupBy("sheet_id").agg(F.sort_array(F.collect_list(F.struct("centre", "edge"))).alias("_cols"))
    edges = per_sheet(left_edges(centres, ROW, "area_maxx", hot=hot), arrays, ["sheet_id"], bounded_by=header)
    near = F.array_position(F.transform("_cols", lambda c: F.abs(c["edge"] - F.col("edge")) < EDGE_EPS), F.lit(True))
    matched = edges.withColumns({"col_from": F.nullif(near, F.lit(0)).cast("int") - 1, "_n": F.size("_cols")})
    kept = scan.totals(matched, ROW, {"_open": F.count_if(F.col("col_from").isNull())}, hot=hot).filter("_open = 0")
    after = scan.run(kept, ROW, ["cluster_id"], {"_next": scan.following(F.col("col_from"))}, hot=hot)
    return after.select(*ROW, "cluster_id", "col_from", F.coalesce("_next", "_n").alias("col_to"))
