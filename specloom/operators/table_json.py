"""Row-header matching over tables extracted to JSON elsewhere."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specloom.operators.joins import lookup_join

ANY_CELL = "(.*)"  # fixed value: cell pattern when a spec gives none


def flatten_spec(spec: dict, path: str = "") -> list[tuple[str, str, str]]:
    """Nested spec to (dotted path, row header, cell pattern); driver-side config."""
    out = [(path, spec["row_h"], spec.get("cell", ANY_CELL))] if "row_h" in spec else []
    for key, inner in spec.items():
        if isinstance(inner, dict):
            out += flatten_spec(inner, f"{path}.{key}")
    return out


def spec_table(spark: SparkSession, specs: dict[str, dict]) -> DataFrame:
    rows = [(name, *entry) for name, spec in specs.items() for entry in flatten_spec(spec)]
    cols = list(zip(*rows))
    return spark.createDataFrame(pa.table(dict(zip(("specset", "prefix", "row_h", "cell_re"), cols))))


def table_lines(raw: DataFrame) -> DataFrame:
    """Lines of all blocks; a marker line -1 keeps documents in which nothing matches."""
    blocks = raw.select("doc_id", "specset", F.posexplode_outer("blocks").alias("block_idx", "block"))
    lines = blocks.select("doc_id", "specset", "block_idx", F.posexplode("block.data").alias("line_idx", "line"))
    texts = F.transform("line", lambda c: c["text"])
    marker = raw.select("doc_id", "specset", F.lit(-1).alias("block_idx"), F.lit(-1).alias("line_idx"), F.lit(None).cast("array<string>").alias("texts"))
    return lines.select("doc_id", "specset", "block_idx", "line_idx", texts.alias("texts")).unionByName(marker)


def match_tables(raw: DataFrame, specs: DataFrame) -> DataFrame:
    """Per document and spec entry: values of the last line whose first cell is the row header.

    A value is group 1 of the cell pattern, anchored at the start; other cells are dropped.
    """
    lines = table_lines(raw)
    first = F.try_element_at("texts", F.lit(1))
    found = lookup_join(lines, specs, ["specset"], (first == F.col("row_h")) | (F.col("block_idx") < 0))
    last = found.groupBy("doc_id", "prefix", "row_h", "cell_re").agg(F.max_by("texts", F.struct("block_idx", "line_idx")).alias("texts"))
    anchored = F.concat(F.lit("^(?:"), "cell_re", F.lit(")"))
    cells = F.filter(F.slice("texts", F.lit(2), F.size("texts")), lambda c: F.rlike(c, anchored))
    values = F.transform(cells, lambda c: F.call_function("regexp_extract", c, anchored, F.lit(1)))
    return last.select("doc_id", "prefix", F.coalesce(F.when(F.size("texts") > 0, values), F.array().cast("array<string>")).alias("vals"))
