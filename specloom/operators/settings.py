"""Merged stage options to the tables that table reconstruction reads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specloom.operators.incremental import split_bad
from specloom.operators.tables import SECTION_MODES
from specloom.session import stable

# Form of the "fix" and "area" options.
FIX = (
    "struct<cols: array<struct<row: string, spans: array<int>>>, "
    "add_cell: array<struct<row_text: string, col_text: string, text: string>>, joiner: array<struct<row: string, seq: string>>>"
)
AREA = "array<double>"


@dataclass(frozen=True)
class SettingsTables:
    """What one run of reconstruction takes, and the jobs whose options say no such thing."""

    config: DataFrame
    fixed: DataFrame
    added: DataFrame
    joiners: DataFrame
    rejects: DataFrame


def _option(name: str) -> Column:
    return F.try_element_at("opts", F.lit(name))


def _flag(name: str) -> Column:
    return F.coalesce(F.lower(_option(name)).try_cast("boolean"), F.lit(False))


def settings_tables(jobs: DataFrame, keys: list[str]) -> SettingsTables:
    """jobs: keys, opts map<string, string> with the options `source`, `area` ([x, y, w, h]), `page` (1),
    `sections` (none), `multiline_row_header`, `multiline_section_header` (false) and `fix`, all as
    text, lists as JSON. The keys together name a sheet; an option that is present with null counts as
    absent. A job's first fault is its reject reason; the fixes of a sheet are numbered in their order.
    """
    read = jobs.select(
        *keys,
        F.concat_ws("/", *[F.col(k).cast("string") for k in keys]).alias("sheet_id"),
        _option("source").alias("doc_id"),
        _option("area").alias("_area"),
        F.from_json(_option("area"), AREA).alias("area"),
        _option("page").alias("_page"),
        F.coalesce(_option("page"), F.lit("1")).try_cast("int").alias("page"),
        F.coalesce(_option("sections"), F.lit(SECTION_MODES[0])).alias("sections"),
        _flag("multiline_row_header").alias("multiline_row_header"),
        _flag("multiline_section_header").alias("multiline_section_header"),
        _option("fix").alias("_fix"),
        F.from_json(_option("fix"), FIX, {"mode": "PERMISSIVE"}).alias("fix"),
    )
    four = F.coalesce((F.size("area") == 4) & F.forall("area", lambda v: v.isNotNull()), F.lit(False))
    reason = (
        F.when(F.col("doc_id").isNull(), "no source")
        .when(F.col("_area").isNull(), "no area")
        .when(~four, "area is not four numbers")
        .when(F.coalesce(F.col("page") < 1, F.lit(True)), "page is no number from 1")
        .when(~F.col("sections").isin(*SECTION_MODES), "unknown kind of sections")
        .when(F.col("_fix").isNotNull() & F.get_json_object("_fix", "$").isNull(), "fix cannot be read")
    )
    # Read and judged once; all tables come from what is written here.
    good, rejects = split_bad(stable(read.withColumn("reason", reason)), F.col("reason"))
    sides = [F.get("area", F.lit(i)).alias(n) for i, n in enumerate("xywh")]
    config = good.select("sheet_id", *keys, "doc_id", "page", *sides, "sections", "multiline_row_header", "multiline_section_header")

    def listed(field: str, names: dict[str, str]) -> DataFrame:
        each = good.select("sheet_id", F.posexplode(f"fix.{field}").alias("fix_id", "_f"))
        return each.select("sheet_id", "fix_id", *[F.col(f"_f.{a}").alias(b) for a, b in names.items()])

    return SettingsTables(
        config,
        listed("cols", {"row": "row_text", "spans": "spans"}),
        listed("add_cell", {"row_text": "row_text", "col_text": "col_text", "text": "text"}),
        listed("joiner", {"row": "row_text", "seq": "seq"}),
        rejects.select(*keys, "reason"),
    )
