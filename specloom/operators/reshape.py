"""Wide and long forms of a sheet, sections, cell expansion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specloom.operators import scan

SHEET = ["sheet_id"]


def fill_sections(rows: DataFrame, *, hot: bool | None = None) -> DataFrame:
    """An empty section takes the last one above it in the sheet; rows before any section get ''."""
    known = scan.last_known(F.nullif(F.col("section"), F.lit("")))
    filled = scan.run(rows, SHEET, ["row_idx"], {"_section": known}, hot=hot)
    return filled.withColumn("section", F.coalesce("_section", F.lit(""))).drop("_section")


def blank_sections(rows: DataFrame, *, hot: bool | None = None) -> DataFrame:
    """A section equal to the one of the row before is left out, as in the stored wide sheet."""
    with_prev = scan.run(rows, SHEET, ["row_idx"], {"_prev": scan.previous(F.col("section"))}, hot=hot)
    repeated = F.col("section").eqNullSafe(F.col("_prev"))
    return with_prev.withColumn("section", F.when(~repeated, F.col("section"))).drop("_prev")


def column_names(count: int) -> list[str]:
    return [f"col:{i}" for i in range(count)]


def column_count(cells: DataFrame) -> int:
    """Number of value columns over all sheets (one aggregate row)."""
    return (cells.agg(F.max("col_idx").alias("m")).first()["m"] or 0) + 1


def long_to_wide(
    cells: DataFrame,
    columns: int,
    *,
    keys: Sequence[str] = ("sheet_id", "row_idx", "section", "property"),
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Cells to one row per property; the known column list keeps the pivot to one aggregation.

    With `order`, row_idx is made from it: rows come in order of first appearance.
    """
    values = [F.first(F.when(F.col("col_idx") == i, F.col("value")), ignorenulls=True).alias(n) for i, n in enumerate(column_names(columns))]
    if order is None:
        return cells.groupBy(*keys).agg(*values)
    wide = cells.groupBy(*keys).agg(*values, F.min(F.struct(*order)).alias("_at"))
    wide = wide.select("*", *[F.col(f"_at.{c}").alias(f"_o_{c}") for c in order]).drop("_at")
    steps = {"row_idx": scan.position()}
    return scan.run(wide, SHEET, [f"_o_{c}" for c in order], steps).drop(*[f"_o_{c}" for c in order])


def wide_to_long(wide: DataFrame, columns: int) -> DataFrame:
    """One row per cell; absent cells (null) are left out."""
    names = column_names(columns)
    ids = [F.col(f"`{c}`") for c in wide.columns if c not in names]
    cells = wide.unpivot(ids, [F.col(f"`{n}`") for n in names], "_name", "value")
    index = F.substring_index("_name", ":", -1).cast("int")
    return cells.withColumn("col_idx", index).drop("_name").filter(F.col("value").isNotNull())


def sheet_rows(wide: DataFrame, columns: int, *, hot: bool | None = None) -> DataFrame:
    """Stored wide sheets to mapping rows: sections repeated, values of a row as one array.

    A sheet has as many models as its widest row has columns, as its stored header would say; every
    row gets an array of that length, null where a cell is blank.
    """
    names = [F.col(f"`{n}`") for n in column_names(columns)]
    filled = F.transform(F.array(*names), lambda v, i: F.when(v.isNotNull(), i + 1).otherwise(0))
    if hot is None:
        hot = scan.has_hot_key(wide, SHEET)
    counted = scan.totals(wide.withColumn("_filled", F.array_max(filled)), SHEET, {"_width": F.max("_filled")}, hot=hot).drop("_filled")
    rows = scan.run(counted, SHEET, ["row_idx"], {"_section": scan.last_known(F.nullif(F.col("section"), F.lit("")))}, hot=hot)
    keep = [F.col(f"`{c}`") for c in wide.columns if not c.startswith("col:") and c != "section"]
    section = F.coalesce("_section", F.lit("")).alias("section")
    vals = F.slice(F.array(*names), F.lit(1), F.coalesce("_width", F.lit(0))).alias("vals")
    return rows.select(*keep, section, vals)


def expand_columns(cells: DataFrame) -> DataFrame:
    """A cell covering [col_from, col_to) is repeated to each column it covers."""
    covered = cells.filter(F.col("col_from") < F.col("col_to"))
    return covered.withColumn("col_idx", F.explode(F.sequence(F.col("col_from"), F.col("col_to") - 1))).drop("col_from", "col_to")


def concat_attributes(cells: DataFrame, *, hot: bool | None = None) -> DataFrame:
    """Values of one (column, section, property) joined by a space from top to bottom; empty values
    add nothing, and a key with none but empty ones keeps an empty text."""
    keys = ["sheet_id", "col_idx", "section", "property"]
    filled = cells.withColumn("value", F.nullif("value", F.lit("")))
    return scan.ordered_text(filled, keys, ["midy", "frag_id"], "value", " ", hot=hot)
