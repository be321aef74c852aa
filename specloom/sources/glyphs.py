"""Text fragments from glyphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specloom.operators import scan

LINE = ["doc_id", "page", "line_id"]
PAGE = ["doc_id", "page"]

# Vertical gap between lines, horizontal gap between words, replaced characters.
LINE_EPS = 2
WORD_EPS = 5
REPLACED = {"\u00a0": " "}


def _boxes() -> dict[str, Column]:
    return {"minx": F.min("minx"), "miny": F.min("miny"), "maxx": F.max("maxx"), "maxy": F.max("maxy")}


def _blank(ch: Column) -> Column:
    return F.coalesce(ch, F.lit("")).rlike(r"(?U)^\s*$")


def glyph_runs(glyphs: DataFrame, *, hot: bool | None = None) -> DataFrame:
    """A glyph without font ends a run; blanks are cut off at both ends of a run, blank runs drop.

    Inside a run an empty glyph reads as a space.
    """
    if hot is None:
        hot = scan.has_hot_key(glyphs, LINE)
    order = ["seq"]
    runs = scan.run(glyphs, LINE, order, {"run_id": scan.running_sum(F.when(F.col("has_font"), 0).otherwise(1))}, hot=hot)
    inked = ~_blank(F.col("ch"))
    lettered = scan.totals(
        runs.filter("has_font"), [*LINE, "run_id"], {"_from": F.min(F.when(inked, F.col("seq"))), "_to": F.max(F.when(inked, F.col("seq")))}, hot=hot
    ).filter("seq between _from and _to")
    text = F.when(F.coalesce("ch", F.lit("")) == "", " ").otherwise(F.col("ch"))
    return scan.ordered_text(lettered.withColumn("text", text), [*LINE, "run_id"], order, "text", "", _boxes(), hot=hot)


def loose_lines(glyphs: DataFrame, *, hot: bool | None = None) -> DataFrame:
    """Words from glyphs that belong to no line: glyphs are grouped to lines by height (a new line
    where the gap is above 2), then to words from left to right (a new word where the gap is above 5).

    glyphs: doc_id, page, glyph_id, ch and box; y grows upwards, lines come from the top.
    """
    if hot is None:
        hot = scan.has_hot_key(glyphs, PAGE)
    down = glyphs.withColumn("_down", -F.col("miny"))
    gaps = scan.run(down, PAGE, ["_down", "glyph_id"], {"_prev": scan.previous(F.col("_down"))}, hot=hot)
    starts = F.when(F.col("_down") - F.col("_prev") > LINE_EPS, 1).otherwise(0)
    lined = scan.run(gaps, PAGE, ["_down", "glyph_id"], {"line_no": scan.running_sum(starts)}, hot=hot)
    line = [*PAGE, "line_no"]
    order = ["minx", "glyph_id"]
    right = scan.run(lined, line, order, {"_right": scan.previous(F.col("maxx"))}, hot=hot)
    apart = F.when(F.col("minx") - F.col("_right") > WORD_EPS, 1).otherwise(0)
    words = scan.run(right, line, order, {"word_no": scan.running_sum(apart)}, hot=hot)
    text = F.col("ch")
    for char, plain in REPLACED.items():
        text = F.when(text == char, plain).otherwise(text)
    joined = scan.ordered_text(words.withColumn("text", text), [*line, "word_no"], order, "text", "", _boxes(), hot=hot)
    return joined.withColumn("text", F.regexp_replace("text", r"(?U)^\s+|\s+$", "")).filter("text <> ''")
