"""Model columns from the tables of a page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specloom.operators import scan

PAGE = ["page_id"]
NO_SECTION = "none"  # fixed value: section of rows above the first section row


def chain_tables(rows: DataFrame) -> DataFrame:
    """Rows of all tables of a page one after another, without the first table's first row, its header."""
    body = rows.filter((F.col("table_idx") > 0) | (F.col("row_idx") > 0))
    return scan.run(body, PAGE, ["table_idx", "row_idx"], {"seq": scan.position()}, hot=False)


def _total(cells: Column) -> Column:
    return F.reduce(cells, F.lit(0), lambda acc, c: acc + c["colspan"])


def columnize(rows: DataFrame) -> DataFrame:
    """Properties per model column of a page.

    The first row of the first table names the models. A single-cell row opens a section, a row of
    total width 2 holds one value for all models, other rows are spread by their colspans and
    dropped when the width does not fit. For a repeated key the last row wins.

    A page is one input record, so the ordered pass over its rows is bounded by that record.
    """
    cells, first = F.col("cells"), (F.col("table_idx") == 0) & (F.col("row_idx") == 0)
    names = F.transform(F.slice(cells, F.lit(2), F.size(cells)), lambda c: c["text"])
    section = F.when(~first & (F.size(cells) == 1), cells[0]["text"])
    steps = {
        "seq": scan.position(),
        "models": scan.last_known(F.when(first, names)),
        "section": scan.last_known(section),
    }
    ordered = scan.run(rows, PAGE, ["table_idx", "row_idx"], steps, hot=False)
    n = F.size("models")
    spread = F.flatten(F.transform(F.slice(cells, F.lit(2), F.size(cells)), lambda c: F.array_repeat(c["text"], c["colspan"])))
    values = F.when((F.size(cells) == 2) & (_total(cells) == 2), F.array_repeat(cells[1]["text"], n)).when(_total(cells) == n + 1, spread)
    body = ordered.filter((F.col("seq") > 0) & (F.size(cells) > 1)).select(
        "page_id",
        "seq",
        "models",
        F.coalesce("section", F.lit(NO_SECTION)).alias("section"),
        cells[0]["text"].alias("property"),
        F.posexplode(values).alias("col_idx", "value"),
    )
    last = F.max_by("value", "seq").alias("value")
    keyed = body.withColumn("model", F.try_element_at("models", F.col("col_idx") + 1))
    return keyed.groupBy("page_id", "col_idx", "model", "section", "property").agg(last)
