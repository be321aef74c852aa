"""Table reconstruction: positioned text fragments of many pages to sheet cells.

A fragment is (sheet_id, frag_id, text, minx, miny, maxx, maxy), y growing downwards; sheet_id is
one extraction area on one page of one document.

All fragments of a sheet (row headers, section labels, cells) stay in one frame and every step adds
columns with a window inside the sheet. The frame is shuffled once, on sheet_id; no step pairs
fragments with rows. `hot` says that some sheet is too large for one task; it is asked once, of the
input, and then every ordered pass runs over range chunks instead (see `scan`).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specloom.operators import scan
from specloom.operators.joins import at_most, shuffled
from specloom.operators.name_index import find_names
from specloom.session import broadcast_rows, stable

SHEET = ["sheet_id"]
KIND = ["sheet_id", "kind"]
ROW = ["sheet_id", "row_id"]
BOX = ["minx", "miny", "maxx", "maxy"]

# Tolerances in points.
HEADER_EPS = 5  # row headers start within this of the leftmost one
COLUMN_EPS = 5  # centres of one column lie within this of each other
SECTION_EPS = 2  # a section may lie this far below its first row
CENTRE_EPS = 2  # a centred label lies within this of the middle of the area
LINE_EPS = 2  # line gaps within this of the smallest are wraps
BOUND_EPS = 3  # forward and backward row borders must agree within this
HALF_THOUSANDTHS = 2000  # units of a point in which row borders are summed
# Where a table prints its section labels.
SECTION_MODES = ("none", "empty-line", "first-col", "table-center")
NO_SECTIONS, EMPTY_LINE, FIRST_COL, TABLE_CENTER = SECTION_MODES


def midx() -> Column:
    return (F.col("minx") + F.col("maxx")) / 2


def midy() -> Column:
    return (F.col("miny") + F.col("maxy")) / 2


def union_box() -> dict[str, Column]:
    return {"minx": F.min("minx"), "miny": F.min("miny"), "maxx": F.max("maxx"), "maxy": F.max("maxy")}


def top_to_bottom(sep: str = " ") -> Column:
    """Texts of a group in top-to-bottom order; the group is one cell of the result."""
    pieces = F.array_sort(F.collect_list(F.struct(midy().alias("midy"), "frag_id", "text")))
    return F.array_join(F.transform(pieces, lambda p: p["text"]), sep)


@dataclass(frozen=True)
class Settings:
    """What the extraction settings ask for, from one aggregate over them."""

    rows: int
    modes: frozenset[str]
    wrapped: bool
    # About how many fragments the sheets have; tasks are cut by it.
    fragments: int = 0


def settings_of(config: DataFrame, fragments: int = 0) -> Settings:
    wrapped = F.bool_or(F.coalesce(F.col("multiline_row_header"), F.lit(False)) | F.coalesce(F.col("multiline_section_header"), F.lit(False)))
    modes = [F.bool_or(F.col("sections") == m).alias(m) for m in SECTION_MODES]
    found = config.agg(F.count(F.lit(1)).alias("rows"), wrapped.alias("wrapped"), *modes).first()
    return Settings(found["rows"], frozenset(m for m in SECTION_MODES if found[m]), bool(found["wrapped"]), fragments)


# ---- area, added cells ----------------------------------------------------------


def per_sheet(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner", bounded_by: DataFrame | int | None = None) -> DataFrame:
    """Join with a table of about one row per sheet: broadcast while its checked size allows,
    otherwise a shuffle on the key that adaptive execution may split.

    `bounded_by` is a cheaper table that has at least as many rows, or a count known already.
    """
    limit = broadcast_rows(big.sparkSession)
    few = bounded_by <= limit if isinstance(bounded_by, int) else at_most(small if bounded_by is None else bounded_by, limit)
    return big.join(F.broadcast(small) if few else shuffled(small), on, how)


def area_filter(fragments: DataFrame, config: DataFrame, rows: int | None = None) -> DataFrame:
    """Fragments inside the area of each extraction; area amounts are cut to whole points."""
    x, y, w, h = (F.col(c).cast("int") for c in ("x", "y", "w", "h"))
    area = config.select(
        "sheet_id",
        "doc_id",
        "page",
        "sections",
        "multiline_row_header",
        "multiline_section_header",
        x.cast("double").alias("area_minx"),
        y.cast("double").alias("area_miny"),
        (x + w).cast("double").alias("area_maxx"),
        (y + h).cast("double").alias("area_maxy"),
    )
    inside = (
        (F.col("area_minx") <= F.col("minx"))
        & (F.col("maxx") <= F.col("area_maxx"))
        & (F.col("area_miny") <= F.col("miny"))
        & (F.col("maxy") <= F.col("area_maxy"))
    )
    return per_sheet(fragments, area, ["doc_id", "page"], bounded_by=rows).filter(inside)


def by_sheet(frame: DataFrame, hot: bool, rows: int = 0) -> DataFrame:
    """The one shuffle of the frame; windows on the sheet and on finer keys reuse it. `rows` is about how
    many rows it has: what follows is many passes over each partition, so their number grows with it."""
    return frame if hot else scan.dealt(frame, SHEET, rows)


def find_text(fragments: DataFrame, names: DataFrame) -> DataFrame:
    """The one fragment of the sheet with a text: unique exact match, else unique substring match.

    names: sheet_id, name. Names that are ambiguous have a null `box`, those that occur nowhere no row.
    """
    hits = find_names(fragments.select("sheet_id", "frag_id", "text", *BOX), names, BOX)
    return hits.select("sheet_id", "name", F.when((F.col("n_exact") == 1) | (F.col("n_any") == 1), F.col("box")).alias("box"))


def locate_added(fragments: DataFrame, fixes: DataFrame) -> DataFrame:
    """fixes (sheet_id, fix_id, row_text, col_text, text) with the boxes of the fragments that they name.
    Both names of all fixes are looked up at once, and the result is written once."""
    names = fixes.select("sheet_id", F.explode(F.array("row_text", "col_text")).alias("name"))
    named = stable(find_text(fragments, names).filter("box is not null"))
    boxes = [named.select("sheet_id", F.col("name").alias(c), F.col("box").alias(f"{c}_box")) for c in ("row_text", "col_text")]
    return fixes.join(shuffled(boxes[0]), ["sheet_id", "row_text"], "left").join(shuffled(boxes[1]), ["sheet_id", "col_text"], "left")


def add_cell(fragments: DataFrame, fixes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cells at the crossing of two named fragments, and the fixes whose names were not found."""
    return split_added(locate_added(fragments, fixes))


def split_added(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    found = F.col("row_text_box").isNotNull() & F.col("col_text_box").isNotNull()
    cells = placed.filter(found).select(
        "sheet_id",
        (-1 - F.col("fix_id")).alias("frag_id"),
        "text",
        F.col("col_text_box.minx").alias("minx"),
        F.col("row_text_box.miny").alias("miny"),
        F.col("col_text_box.maxx").alias("maxx"),
        F.col("row_text_box.maxy").alias("maxy"),
    )
    return cells, placed.filter(~found).select("sheet_id", "fix_id", "row_text", "col_text", "text")


# ---- sections and row headers -----------------------------------------------------


def centre_labels(frame: DataFrame, *, hot: bool | None = None) -> DataFrame:
    """Flag fragments in the middle of the area that share no height with any other fragment.

    Sorted by top edge, a fragment overlaps one before it if the lowest bottom so far is below its
    top, and one after it if the next top is above its bottom. Boxes without height never overlap.
    """
    tall = F.col("maxy") > F.col("miny")
    # keyed by height or not as well, so boxes without height stay out of the ordering
    steps = {"_lowest": scan.max_before(F.col("maxy")), "_below": scan.following(F.col("miny"))}
    keyed = frame.withColumn("_tall", tall)
    ordered = scan.run(keyed, [*SHEET, "_tall"], ["miny", "frag_id"], steps, hot=hot)
    free = ~tall | (
        F.coalesce(F.col("_lowest") <= F.col("miny"), F.lit(True)) & F.coalesce(F.col("_below") >= F.col("maxy"), F.lit(True))
    )
    centred = F.abs(midx() - (F.col("area_minx") + F.col("area_maxx")) / 2.0) < CENTRE_EPS
    label = (F.col("sections") == TABLE_CENTER) & centred & free
    return ordered.withColumn("is_label", label).drop("_tall", "_lowest", "_below")


def header_column(frame: DataFrame, *, hot: bool | None = None) -> DataFrame:
    """Give every fragment a kind: row, section, or cell.

    Row headers are the leftmost cluster (measured from its first member); with sections in the
    first column that cluster holds the sections and the next one the row headers.
    """
    first = scan.totals(frame, SHEET, {"_m1": F.min("minx")}, hot=hot)
    beyond = F.when(F.col("minx") - F.col("_m1") > HEADER_EPS, F.col("minx"))
    second = scan.totals(first, SHEET, {"_m2": F.min(beyond)}, hot=hot)
    in_first = F.col("minx") - F.col("_m1") <= HEADER_EPS
    in_second = ~in_first & (F.col("minx") - F.col("_m2") <= HEADER_EPS)
    by_column = F.col("sections") == FIRST_COL
    kind = (
        F.when(F.col("is_label"), "section")
        .when(by_column & in_first, "section")
        .when(F.when(by_column, in_second).otherwise(in_first), "row")
        .otherwise("cell")
    )
    return second.withColumn("kind", kind).drop("_m1", "_m2")


def multiline_runs(frame: DataFrame, keys: list[str], *, hot: bool | None = None) -> DataFrame:
    """Number lines that wrap: gaps as small as the smallest ones (within 2) join two lines."""
    order = ["midy", "frag_id"]
    gaps = scan.run(frame.withColumn("midy", midy()), keys, order, {"_bottom": scan.previous(F.col("maxy"))}, hot=hot)
    gaps = gaps.withColumn("_gap", F.col("miny") - F.col("_bottom"))
    low = scan.totals(gaps, keys, {"_low": F.min("_gap")}, hot=hot)
    wrap = F.max(F.when(F.col("_gap") - F.col("_low") <= LINE_EPS, F.col("_gap")))
    top = scan.totals(low, keys, {"_wrap": wrap}, hot=hot)
    starts = F.when(F.coalesce(F.col("_gap") < F.col("_wrap") + 0.001, F.lit(False)), 0).otherwise(1)
    return scan.run(top, keys, order, {"line": scan.running_sum(starts)}, hot=hot).drop("_bottom", "_gap", "_low", "_wrap")


def merge_multiline(lines: DataFrame, *, hot: bool | None = None) -> DataFrame:
    """Lines of one column per sheet, wrapped ones joined."""
    return merge_fragments(multiline_runs(lines, SHEET, hot=hot), ["sheet_id", "line"]).drop("line")


def merge_fragments(fragments: DataFrame, keys: list[str], sep: str = " ", first: list[str] | None = None) -> DataFrame:
    """Fragments of one cell to one fragment: text in top-to-bottom order, boxes united."""
    kept = [F.min_by(c, F.struct(midy(), "frag_id")).alias(c) for c in first or []]
    boxes = [a.alias(n) for n, a in union_box().items()]
    return fragments.groupBy(*keys).agg(F.min("frag_id").alias("frag_id"), top_to_bottom(sep).alias("text"), *boxes, *kept)


def merge_wrapped(frame: DataFrame, *, hot: bool | None = None) -> DataFrame:
    """Join wrapped row headers or section labels on the sheets whose configuration asks for it."""
    flagged = F.coalesce(
        F.when(F.col("kind") == "row", F.col("multiline_row_header")).when(F.col("kind") == "section", F.col("multiline_section_header")), F.lit(False)
    )
    numbered = multiline_runs(frame.withColumn("_flag", flagged), [*KIND, "_flag"], hot=hot)
    unit = F.when(F.col("_flag"), F.struct(F.lit(0).alias("a"), F.col("line").cast("long").alias("b"))).otherwise(
        F.struct(F.lit(1).alias("a"), F.col("frag_id").cast("long").alias("b"))
    )
    rest = [c for c in frame.columns if c not in ("sheet_id", "kind", "frag_id", "text", *BOX)]
    return merge_fragments(numbered.withColumn("_unit", unit), [*KIND, "_unit"], first=rest).drop("_unit")


def enter_phantoms(frame: DataFrame) -> DataFrame:
    """A centred label also enters as a row without text, so that row ranges stop at it."""
    own = F.struct(F.col("kind"), F.col("text"), F.lit(False).alias("phantom"))
    extra = F.struct(F.lit("row").alias("kind"), F.lit("").alias("text"), F.lit(True).alias("phantom"))
    entries = F.when((F.col("kind") == "section") & (F.col("sections") == TABLE_CENTER), F.array(own, extra)).otherwise(F.array(own))
    rest = [c for c in frame.columns if c not in ("kind", "text")]
    return frame.select(*rest, F.inline(entries)).withColumn("midy", midy())


def row_headers(frame: DataFrame, *, wrapped: bool, hot: bool | None = None) -> DataFrame:
    """Wrapped lines joined, phantom rows entered, lines of each kind numbered."""
    entered = enter_phantoms(frame)
    if wrapped:
        entered = _merge_own(entered, hot)
    lean = entered.select("sheet_id", "kind", "frag_id", "text", *BOX, "phantom", "sections", "area_miny", "area_maxy", midy().alias("midy"))
    return scan.run(lean, KIND, ["midy", "frag_id", "phantom"], {"line_no": scan.position()}, hot=hot)


def _merge_own(entered: DataFrame, hot: bool | None) -> DataFrame:
    """Phantom rows take no part in the merge of wrapped lines."""
    kind = F.when(F.col("phantom"), "phantom").otherwise(F.col("kind"))
    merged = merge_wrapped(entered.withColumn("kind", kind), hot=hot)
    return merged.withColumn("kind", F.when(F.col("kind") == "phantom", "row").otherwise(F.col("kind")))


def is_row() -> Column:
    return F.col("kind") == "row"


def is_cell() -> Column:
    return F.col("kind") == "cell"


def sections_by_column(frame: DataFrame, *, hot: bool | None = None) -> DataFrame:
    """Label of each row header: the labels at or above it, but at most one more per row.

    With c = labels so far, the count after row i is min(i + 1, i + min over j <= i of (c_j - j)).
    The text then follows by sorting labels and rows by that count.
    """
    section = F.col("kind") == "section"
    placed = frame.withColumns({"_pos": F.when(section, F.col("midy") - SECTION_EPS).otherwise(F.col("midy")), "_prio": F.when(section, 0).otherwise(1)})
    counted = scan.run(placed, SHEET, ["_pos", "_prio", "kind", "line_no"], {"_c": scan.running_sum(F.when(section, 1).otherwise(0))}, hot=hot)
    lagged = scan.run(counted, KIND, ["line_no"], {"_low": scan.running_min(F.col("_c") - F.col("line_no"))}, hot=hot)
    rank = F.least(F.col("line_no") + 1, F.col("line_no") + F.col("_low")) - 1
    ranked = lagged.withColumn("section_id", F.when(section, F.col("line_no")).when(is_row(), rank).cast("int"))
    label = F.when(section, F.struct(F.col("text").alias("t")))
    named = scan.run(ranked, SHEET, ["section_id", "_prio", "kind", "line_no"], {"_label": scan.last_known(label)}, hot=hot)
    return named.withColumn("label", F.when(is_row(), F.col("_label.t"))).drop("_pos", "_prio", "_c", "_low", "_label")


def sections_by_empty_line(frame: DataFrame, *, hot: bool | None = None) -> DataFrame:
    """A row header that no cell uses is the section label of the rows below it."""
    used = scan.totals(frame, ROW, {"_cells": F.count_if(is_cell())}, hot=hot)
    label = F.when(is_row() & (F.col("_cells") == 0), F.struct(F.col("text").alias("t")))
    out = scan.run(used, KIND, ["line_no"], {"_s": scan.last_known(label)}, hot=hot)
    return out.withColumn("line_label", F.when(is_row(), F.col("_s.t"))).drop("_cells", "_s")


# ---- rows -------------------------------------------------------------------------


def neighbour_span(frame: DataFrame, *, hot: bool | None = None) -> DataFrame:
    """Height range of a row: from the middle of the row above to the middle of the row below.

    The first two rows start at the top of the area, the last one ends at its bottom.
    """
    steps = {"_above": scan.previous(F.col("midy")), "_below": scan.following(F.col("midy"))}
    out = scan.run(frame, KIND, ["line_no"], steps, hot=hot).filter(is_row())
    start = F.when(F.col("line_no") > 1, F.col("_above")).otherwise(F.col("area_miny"))
    return out.withColumns({"span_start": start, "span_stop": F.coalesce("_below", "area_maxy")}).drop("_above", "_below")


def _before(frame: DataFrame, position: Column, priority: Column, what: Column, name: str, hot: bool | None) -> DataFrame:
    """Number of rows of one sort at or before a position; ties go by priority."""
    placed = frame.withColumns({"_pos": position, "_prio": priority})
    out = scan.run(placed, SHEET, ["_pos", "_prio", "kind", "line_no"], {name: scan.running_sum(F.when(what, 1).otherwise(0))}, hot=hot)
    return out.drop("_pos", "_prio")


def span_join(frame: DataFrame, *, hot: bool | None = None) -> DataFrame:
    """Candidate rows lo..hi of each cell: rows whose height range contains it.

    The ranges run from middle to middle, so the candidates follow from two counts: `a` middles at
    or above the cell's top and `b` middles above its bottom. Both are running counts over rows and
    cells sorted together; no pair of a cell and a row is ever built.
    """
    above = _before(frame, F.when(is_row(), F.col("midy")).otherwise(F.col("miny")), F.when(is_row(), 0).otherwise(1), is_row(), "_a", hot)
    below = _before(above, F.when(is_row(), F.col("midy")).otherwise(F.col("maxy")), F.when(is_row(), 1).otherwise(0), is_row(), "_b", hot)
    counted = scan.totals(below, SHEET, {"n_rows": F.count_if(is_row())}, hot=hot)
    lo = F.greatest(F.col("_b") - 1, F.lit(0))
    hi = F.least(F.greatest(F.col("_a"), F.lit(1)), F.col("n_rows") - 1)
    return counted.withColumns({"lo": F.when(is_cell(), lo.cast("int")), "hi": F.when(is_cell(), hi.cast("int"))}).drop("_a", "_b")


def mark_disputed(frame: DataFrame, *, hot: bool | None = None) -> DataFrame:
    """Flag rows that are candidates of a cell with more than one: cells that start at or before
    the row, less those that end before it."""
    disputed = is_cell() & (F.col("lo") < F.col("hi"))
    at_row = F.when(is_row(), F.col("line_no"))
    opened = _before(frame, F.coalesce(at_row, F.col("lo")), F.when(is_row(), 1).otherwise(0), disputed, "_opened", hot)
    closed = _before(opened, F.coalesce(at_row, F.col("hi")), F.when(is_row(), 0).otherwise(1), disputed, "_closed", hot)
    return closed.withColumn("disputed", is_row() & (F.col("_opened") > F.col("_closed"))).drop("_opened", "_closed")


def solve_bounds(frame: DataFrame, *, hot: bool | None = None) -> DataFrame:
    """Upper and lower border of each row.

    The border between two undisputed rows is the midpoint of their middles. Unknown borders are
    mirrored across the middles, b_i = 2 m_(i-1) - b_(i-1); with c_i = (-1)^i b_i that is a prefix
    sum, so c_i - S_i stays the same from a known border on, in both directions. Sums run over whole
    half thousandths of a point, so they do not depend on the order in which chunks add them.
    """
    middle = F.round(F.col("midy") * 1000).cast("long") * 2
    near = scan.run(frame.withColumn("_m", middle), KIND, ["line_no"], {"_m0": scan.previous(F.col("_m")), "_d0": scan.previous(F.col("disputed"))}, hot=hot)
    known = F.when(is_row() & ~F.col("_d0") & ~F.col("disputed"), ((F.col("_m0") + F.col("_m")) / 2).cast("long"))
    sign = F.when(F.col("line_no") % 2 == 0, 1).otherwise(-1)
    summed = scan.run(near.withColumn("_b", known), KIND, ["line_no"], {"_S": scan.running_sum(F.coalesce(2 * sign * F.col("_m0"), F.lit(0).cast("long")))}, hot=hot)
    const = sign * F.col("_b") - F.col("_S")
    both = scan.run(summed, KIND, ["line_no"], {"_fwd": scan.last_known(const), "_rev": scan.next_known(const)}, hot=hot)
    fwd, rev = sign * (F.col("_fwd") + F.col("_S")), sign * (F.col("_rev") + F.col("_S"))
    agreed = F.when(F.abs(fwd - rev) < BOUND_EPS * HALF_THOUSANDTHS, (fwd + rev) / 2)
    value = F.coalesce("_b", F.when(F.col("_fwd").isNull(), rev).when(F.col("_rev").isNull(), fwd).otherwise(agreed))
    solved = both.withColumn("bound", F.when(is_row(), value / HALF_THOUSANDTHS))
    after = scan.run(solved, KIND, ["line_no"], {"_next": scan.following(F.struct(F.col("bound").alias("b")))}, hot=hot)
    # border below the last row: mirrored on from the last known one
    last = -sign * (F.col("_fwd") + F.col("_S") - 2 * sign * F.col("_m")) / HALF_THOUSANDTHS
    stop = F.when(F.col("_next").isNotNull(), F.col("_next.b")).otherwise(last)
    return after.withColumn("bound_stop", F.when(is_row(), stop)).drop("_m", "_m0", "_d0", "_b", "_S", "_fwd", "_rev", "_next")


def _range_known() -> Column:
    """Both borders are known; a border at 0 counts as unknown."""
    return is_row() & F.coalesce((F.col("bound") != 0) & (F.col("bound_stop") != 0), F.lit(False))


def bound_join(frame: DataFrame, *, hot: bool | None = None) -> DataFrame:
    """Settle disputed cells: the first row whose borders contain the cell, if it is a candidate.

    While borders grow from row to row only the last row starting at or above a cell can contain
    it. Where they do not (mirroring may overshoot on uneven rows), or for a cell without height,
    all rows of the sheet are tried.
    """
    grown = scan.run(frame, KIND, ["line_no"], {"_top": scan.max_before(F.greatest("bound", "bound_stop"))}, hot=hot)
    bent = F.when(_range_known(), (F.col("bound_stop") < F.col("bound")) | F.coalesce(F.col("bound") < F.col("_top"), F.lit(False)))
    flat = is_cell() & (F.col("lo") < F.col("hi")) & (F.col("maxy") <= F.col("miny"))
    checked = scan.totals(grown, SHEET, {"_bent": F.bool_or(bent), "_flat": F.bool_or(flat)}, hot=hot)
    marked = checked.withColumn("_search", F.coalesce("_bent", F.lit(False)) | F.coalesce("_flat", F.lit(False)))
    position = F.when(is_row(), F.col("bound")).otherwise(F.col("miny"))
    holder = F.when(_range_known(), F.struct("line_no", "bound_stop"))
    placed = marked.withColumns({"_pos": position, "_prio": F.when(is_row(), 0).otherwise(1)})
    found = scan.run(placed, SHEET, ["_pos", "_prio", "kind", "line_no"], {"_h": scan.last_known(holder)}, hot=hot)
    direct = F.when(F.col("maxy") <= F.col("_h.bound_stop"), F.col("_h.line_no"))
    out = found.withColumn("_direct", direct)
    searched = _search_rows(out, bool(hot))
    settled = F.when(F.col("_search"), F.col("_searched")).otherwise(F.col("_direct"))
    accepted = F.when(settled.between(F.col("lo"), F.col("hi")), settled)
    return searched.withColumn("settled", F.when(is_cell() & (F.col("lo") < F.col("hi")), accepted)).drop(
        "_top", "_bent", "_flat", "_pos", "_prio", "_h", "_direct", "_search", "_searched"
    )


def _search_rows(frame: DataFrame, hot: bool) -> DataFrame:
    """First containing row of each cell that asks: rows are entered into bands about one row high, so
    the range join becomes an equi join on (sheet, band)."""
    frame = stable(frame)
    found = frame.agg(F.count(F.lit(1)).alias("rows"), F.bool_or("_search").alias("search")).first()
    if not found["search"]:
        return frame.withColumn("_searched", F.lit(None).cast("int"))
    ranges = frame.filter(F.col("_search") & _range_known() & (F.col("bound") <= F.col("bound_stop"))).select("sheet_id", "line_no", "bound", "bound_stop")
    height = F.greatest((F.max("bound_stop") - F.min("bound")) / F.count(F.lit(1)), F.lit(1.0))
    high = ranges.groupBy("sheet_id").agg(height.alias("_high"))
    band = lambda c: F.floor(F.col(c) / F.col("_high"))
    entered = ranges.join(shuffled(high), SHEET).select("sheet_id", "line_no", "bound", "bound_stop", F.explode(F.sequence(band("bound"), band("bound_stop"))).alias("_band"))
    cells = frame.filter(F.col("_search") & is_cell() & (F.col("lo") < F.col("hi"))).select("sheet_id", "frag_id", "miny", "maxy")
    pairs = cells.join(shuffled(high), SHEET).withColumn("_band", band("miny")).join(shuffled(entered.withColumnRenamed("line_no", "_row")), ["sheet_id", "_band"])
    inside = pairs.filter("bound <= miny and maxy <= bound_stop")
    first = inside.groupBy("sheet_id", "frag_id").agg(F.min("_row").alias("_searched")).withColumn("kind", F.lit("cell"))
    return by_sheet(frame.join(shuffled(first), ["sheet_id", "frag_id", "kind"], "left"), hot, found["rows"])


def settle_rows(frame: DataFrame, *, hot: bool | None = None) -> DataFrame:
    """Row of each row header and cell; null for cells that stay open and for labels."""
    solved = bound_join(solve_bounds(mark_disputed(span_join(frame, hot=hot), hot=hot), hot=hot), hot=hot)
    row = F.when(is_row(), F.col("line_no")).when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(F.col("settled"))
    return solved.withColumn("row_id", F.when(F.col("kind") != "section", row))


def certain_cells(cells: DataFrame) -> DataFrame:
    """Only cells with a row and a column range reach the output."""
    return cells.filter(F.col("row_id").isNotNull() & F.col("col_from").isNotNull())


def name_rows(frame: DataFrame, *, modes: frozenset[str], hot: bool | None = None) -> DataFrame:
    """Put property and section of its row on every cell; only the section modes in use are run."""
    out = frame.withColumns({"label": F.lit(None).cast("string"), "line_label": F.lit(None).cast("string")})
    if modes & {FIRST_COL, TABLE_CENTER}:
        out = sections_by_column(out.drop("label"), hot=hot)
    if EMPTY_LINE in modes:
        out = sections_by_empty_line(out.drop("line_label"), hot=hot)
    mode = F.col("sections")
    section = F.when(mode == EMPTY_LINE, F.col("line_label")).when(mode.isin(FIRST_COL, TABLE_CENTER), F.col("label"))
    if "spans" not in out.columns:
        out = out.withColumn("spans", F.lit(None).cast("array<int>"))
    header = F.when(is_row(), F.struct(F.col("text").alias("property"), section.alias("section"), F.col("spans")))
    return _named(out, header, hot).drop("label", "line_label")


def _named(frame: DataFrame, header: Column, hot: bool | None) -> DataFrame:
    placed = frame.filter("row_id is not null").withColumn("_header", header).drop("spans")
    whole = scan.totals(placed, ROW, {"_row": F.max("_header")}, hot=hot)
    return whole.select("*", "_row.property", "_row.section", "_row.spans").drop("_row", "_header")


# ---- columns ------------------------------------------------------------------------


def row_clusters(cells: DataFrame, *, hot: bool | None = None) -> DataFrame:
    """Cells of each row numbered by column cluster (gap to the neighbour's centre above 5)."""
    placed = cells.withColumn("midx", midx())
    order = ["midx", "frag_id"]
    gaps = scan.run(placed, ROW, order, {"_left": scan.previous(F.col("midx"))}, hot=hot)
    starts = F.when(F.col("midx") - F.col("_left") > COLUMN_EPS, 1).otherwise(0)
    return scan.run(gaps, ROW, order, {"cluster_id": scan.running_sum(starts)}, hot=hot).drop("_left")


def header_centres(clustered: DataFrame, *, hot: bool | None = None) -> DataFrame:
    """Put the column centres of the sheet on every cell: centres of the clusters of row 0 (mean of
    first and last member), as many values as the table has columns."""
    ends = scan.totals(clustered, [*ROW, "cluster_id"], {"_lo": F.min("midx"), "_hi": F.max("midx")}, hot=hot)
    centre = F.when(F.col("row_id") == 0, (F.col("_lo") + F.col("_hi")) / 2)
    gathered = scan.totals(ends, SHEET, {"header": F.collect_set(centre)}, hot=hot)
    return gathered.withColumn("header", F.sort_array("header")).drop("_lo", "_hi")


def drop_early_cells(cells: DataFrame) -> DataFrame:
    """Drop cells more than 5 left of the first column; a sheet without row 0 gives nothing.

    The cells dropped are the leftmost of their row, so the clusters of the others stay as they are.
    """
    return cells.filter(F.col("midx") >= F.try_element_at("header", F.lit(1)) - COLUMN_EPS)


def _spans_by_centre(centres: Column, header: Column) -> Column:
    """Column ranges of a row's clusters, left to right, or null.

    Each centre must sit on a column (within 5) or between two columns (5 inside); a cell that
    starts at column f and has its middle at half-column M ends at column M - f.
    """
    n = F.size(header)
    span = "array<struct<col_from:int,col_to:int>>"
    kind = f"struct<next:int,spans:{span}>"
    start = F.struct(F.lit(0).alias("next"), F.array().cast(span).alias("spans"))

    def fits(centre: Column, half: Column) -> Column:
        at = F.floor(half / 2).cast("int") + 1
        left, right = F.element_at(header, at), F.try_element_at(header, at + 1)
        on = (left - COLUMN_EPS <= centre) & (centre <= left + COLUMN_EPS)
        between = (left + COLUMN_EPS <= centre) & (centre <= right - COLUMN_EPS)
        return F.when(half % 2 == 0, on).otherwise(between)

    def step(state: Column, centre: Column) -> Column:
        f = state["next"]
        halves = F.when(f < n, F.sequence(2 * f, 2 * (n - 1))).otherwise(F.array().cast("array<int>"))
        half = F.try_element_at(F.filter(halves, lambda m: fits(centre, m)), F.lit(1))
        end = half - f + 1
        one = F.array(F.struct(f.alias("col_from"), end.alias("col_to")))
        moved = F.struct(end.alias("next"), F.concat(state["spans"], one).alias("spans"))
        return F.when(half.isNotNull(), moved).otherwise(F.lit(None).cast(kind))

    done = F.reduce(centres, start.cast(kind), step)
    return F.when(done["next"] == n, done["spans"])


def _fixed_spans(spans: Column) -> Column:
    ends = F.transform(spans, lambda _, i: F.reduce(F.slice(spans, F.lit(1), i + 1), F.lit(0), lambda a, b: a + b))
    return F.zip_with(ends, spans, lambda e, s: F.struct((e - s).alias("col_from"), e.alias("col_to")))


def merge_cells(cells: DataFrame, joiners: DataFrame | None = None, extra: list[str] | None = None) -> DataFrame:
    """One cell per (row, cluster): lines joined top to bottom with the row's joiner."""
    kept = [F.first(c).alias(c) for c in ["property", *(extra or [])]]
    pieces = F.array_sort(F.collect_list(F.struct(midy().alias("midy"), "frag_id", "text")))
    boxes = [a.alias(n) for n, a in union_box().items()]
    centre = (F.min("midx") + F.max("midx")) / 2
    merged = cells.groupBy(*ROW, "cluster_id").agg(F.min("frag_id").alias("frag_id"), centre.alias("centre"), pieces.alias("_pieces"), *boxes, *kept)
    sep = F.lit(" ")
    if joiners is not None:
        merged = per_sheet(merged, single_joiners(joiners), ["sheet_id", "property"], "left", joiners)
        sep = F.coalesce("_sep", F.lit(" "))
    texts = F.transform("_pieces", lambda p: p["text"])
    joined = F.reduce(F.slice(texts, F.lit(2), F.size(texts)), texts[0], lambda acc, t: F.concat(acc, sep, t))
    return merged.withColumn("text", joined).drop("_pieces", "_sep")


def single_joiners(joiners: DataFrame) -> DataFrame:
    """Joiners by exact header text; a text with several joiner rules keeps the default."""
    counted = joiners.groupBy("sheet_id", F.col("row_text").alias("property")).agg(F.count(F.lit(1)).alias("_n"), F.first("seq").alias("_sep"))
    return counted.filter("_n = 1").drop("_n")


def resolve_colspans(merged: DataFrame) -> DataFrame:
    """Column range of each merged cell: fixed by configuration (`spans` of its row), one per column,
    one for all, or by its centre; a row that does not come out even is left out (see `uneven_rows`)."""
    solved = _ranged_rows(merged).filter("_ranges is not null")
    pairs = F.arrays_zip(F.col("_cells").alias("c"), F.col("_ranges").alias("r"))
    return solved.select(*ROW, F.explode(pairs).alias("_p")).select(*ROW, "_p.c.*", "_p.r.*")


def uneven_rows(merged: DataFrame) -> DataFrame:
    """Rows that `resolve_colspans` leaves out, with the reason."""
    reason = F.when(F.col("spans").isNotNull(), "fixed spans do not fit the cells").otherwise("cells do not fit the columns")
    return _ranged_rows(merged).filter("_ranges is null").select(*ROW, reason.alias("reason"))


def _ranged_rows(merged: DataFrame) -> DataFrame:
    """Every row with its cells and their column ranges, null where they do not come out even.

    A row can use at most as many clusters as there are columns (or fixed spans); of rows with more the
    cells are counted and not gathered.
    """
    joined = merged if "spans" in merged.columns else merged.withColumn("spans", F.lit(None).cast("array<int>"))
    carried = [c for c in merged.columns if c not in (*ROW, "header", "spans")]
    most = F.greatest(F.size("header"), F.coalesce(F.array_size("spans"), F.lit(0)))
    counted = scan.totals(joined, ROW, {"_clusters": F.count(F.lit(1))}, hot=False)
    cell = F.when(F.col("_clusters") <= most, F.struct(*carried))
    rows = counted.groupBy(*ROW).agg(F.array_sort(F.collect_list(cell)).alias("_cells"), F.first("header").alias("header"), F.first("spans").alias("spans"))
    k, n = F.size("_cells"), F.size("header")
    own = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(i.alias("col_from"), (i + 1).alias("col_to")))
    whole = F.array(F.struct(F.lit(0).alias("col_from"), n.alias("col_to")))
    ranges = (
        F.when(F.col("spans").isNotNull(), F.when(F.size("spans") == k, _fixed_spans(F.col("spans"))))
        .when(k == n, own)
        .when(k == 1, whole)
        .otherwise(_spans_by_centre(F.transform("_cells", lambda c: c["centre"]), F.col("header")))
    )
    return rows.withColumn("_ranges", F.when(k > 0, ranges))


# ---- all together ---------------------------------------------------------------------


def find_rows(fragments: DataFrame, config: DataFrame, settings: Settings, fixes: DataFrame, *, added: DataFrame | None = None, hot: bool) -> DataFrame:
    """Which row headers the fixes (sheet_id, row_text) name: line number, null if several; no row if none.

    Only the sheets that have fixes are numbered for it, and the result, at most one row for each name, is
    written once.
    """
    sheets = fixes.select("sheet_id").distinct()
    lined = lined_frame(fragments, config.join(shuffled(sheets), "sheet_id", "left_semi"), settings, added=added, hot=hot)
    return stable(rows_named(lined, fixes))


def rows_named(lined: DataFrame, fixes: DataFrame) -> DataFrame:
    """(sheet_id, row_text, line_no) of the names of the fixes that occur among the row headers."""
    rows = lined.filter(is_row()).withColumn("frag_id", F.col("line_no"))
    found = find_text(rows, fixes.select("sheet_id", F.col("row_text").alias("name")))
    return found.select("sheet_id", F.col("name").alias("row_text"), F.col("box.frag_id").alias("line_no"))


def fixed_spans(frame: DataFrame, fixes: DataFrame, named: DataFrame, rows: int | None = None) -> DataFrame:
    """Put fixed spans on the row headers they name: unique exact text, else unique substring.

    fixes: sheet_id, row_text, spans and, where several may name one row, fix_id: the last counts. `named`
    says which row headers they name (see `find_rows`), `rows` how many fixes there are.
    """
    order = F.struct(*[c for c in ("fix_id", "row_text", "spans") if c in fixes.columns])
    hits = fixes.join(shuffled(named.filter("line_no is not null")), ["sheet_id", "row_text"])
    at = hits.groupBy("sheet_id", F.lit("row").alias("kind"), "line_no").agg(F.max_by("spans", order).alias("spans"))
    return per_sheet(frame, at, ["sheet_id", "kind", "line_no"], "left", bounded_by=fixes if rows is None else rows)


def unresolved_fixes(fixes: DataFrame, named: DataFrame) -> DataFrame:
    """Fixes whose text names no row of their sheet, or several: the fix with its reason."""
    marked = fixes.join(shuffled(named.withColumn("_known", F.lit(True))), ["sheet_id", "row_text"], "left").filter("line_no is null")
    return marked.withColumn("reason", F.when(F.col("_known"), "ambiguous name").otherwise("unknown name")).drop("line_no", "_known")


def lined_frame(fragments: DataFrame, config: DataFrame, settings: Settings, *, added: DataFrame | None = None, hot: bool) -> DataFrame:
    """Fragments of all areas with their kind, row headers and labels numbered; `added` are more of them
    (sheet_id, frag_id, text and box)."""
    inside = area_filter(fragments, config, settings.rows).drop("doc_id", "page")
    if added is not None:
        area = inside.drop("frag_id", "text", *BOX).dropDuplicates(["sheet_id"])
        inside = inside.unionByName(added.join(shuffled(area), SHEET))
    frame = by_sheet(inside, hot, settings.fragments)
    if TABLE_CENTER in settings.modes:
        frame = centre_labels(frame, hot=hot)
    else:
        frame = frame.withColumn("is_label", F.lit(False))
    return row_headers(header_column(frame, hot=hot).drop("is_label"), wrapped=settings.wrapped, hot=hot)


def place_columns(named: DataFrame, joiners: DataFrame | None = None, *, hot: bool) -> DataFrame:
    """Cells of named rows merged per column cluster, with the column centres of their sheet."""
    clustered = row_clusters(named.filter(is_cell()), hot=hot)
    kept = drop_early_cells(header_centres(clustered, hot=hot))
    return merge_cells(kept, joiners, ["section", "header", "spans"])


def split_hot(fragments: DataFrame, config: DataFrame) -> list[tuple[DataFrame, DataFrame, bool]]:
    """Fragments and settings of ordinary pages, and apart from them those of pages too large for one
    task, each with whether it is the latter. Asked once, of the input."""
    page = ["doc_id", "page"]
    hot = scan.hot_keys(fragments, page)
    if hot is None:
        return [(fragments, config, False)]
    return [(*(per_sheet(df, hot, page, how) for df in (fragments, config)), how == "left_semi") for how in ("left_anti", "left_semi")]


class Sheets:
    """Cells of sheets, and what did not get into them, planned when asked for: added cells and fixed spans
    whose names were not found (None where none were given), and rows whose cells do not fit the columns."""

    def __init__(self, cells: DataFrame, placed: DataFrame, unplaced: DataFrame | None, fixes: tuple[DataFrame, DataFrame] | None, fragments: int = 0):
        self.cells = cells
        self.fragments = fragments
        self.unplaced = unplaced
        self._placed, self._fixes = placed, fixes

    @cached_property
    def unresolved(self) -> DataFrame | None:
        return None if self._fixes is None else unresolved_fixes(*self._fixes)

    @cached_property
    def uneven(self) -> DataFrame:
        return uneven_rows(self._placed)


def sheet_cells(
    fragments: DataFrame,
    config: DataFrame,
    *,
    fixed: DataFrame | None = None,
    joiners: DataFrame | None = None,
    added: DataFrame | None = None,
    hot: bool | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Fragments and extraction settings to cells with section, property, column range and text."""
    if hot is None:
        parts = [sheet_cells(f, c, fixed=fixed, joiners=joiners, added=added, hot=h) for f, c, h in split_hot(fragments, config)]
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return sheet_outcome(fragments, config, fixed=fixed, joiners=joiners, added=added, hot=hot, rows=rows).cells


def sheet_outcome(
    fragments: DataFrame,
    config: DataFrame,
    *,
    fixed: DataFrame | None = None,
    joiners: DataFrame | None = None,
    added: DataFrame | None = None,
    hot: bool,
    rows: int | None = None,
) -> Sheets:
    """`sheet_cells` with its rejects, of the sheets in config only. `rows` is the number of fragments, where
    it is known without counting."""
    settings = settings_of(config, fragments.count() if rows is None else rows)
    ours = config.select("sheet_id").distinct()
    unplaced = new = named = None
    if added is not None:
        added = stable(added.join(shuffled(ours), "sheet_id", "left_semi"))
        if not added.isEmpty():
            sheets = config.join(shuffled(added.select("sheet_id").distinct()), "sheet_id", "left_semi")
            inside = area_filter(fragments, sheets, settings.rows).drop("doc_id", "page")
            new, unplaced = split_added(stable(locate_added(inside, added)))
        else:
            unplaced = added
    lined = lined_frame(fragments, config, settings, added=new, hot=hot)
    if fixed is not None:
        fixed = stable(fixed.join(shuffled(ours), "sheet_id", "left_semi"))
        n = fixed.count()
        named = find_rows(fragments, config, settings, fixed, added=new, hot=hot)
        lined = by_sheet(fixed_spans(lined, fixed, named, n), hot, settings.fragments)
    headed = name_rows(settle_rows(lined, hot=hot), modes=settings.modes, hot=hot)
    placed = place_columns(headed, joiners, hot=hot)
    cells = certain_cells(resolve_colspans(placed))
    out = cells.select("sheet_id", "row_id", "section", "property", "col_from", "col_to", midy().alias("midy"), "frag_id", F.col("text").alias("value"))
    return Sheets(out, placed, unplaced, None if fixed is None else (fixed, named), settings.fragments)


def spec_cells(cells: DataFrame, *, hot: bool | None = None, rows: int = 0) -> DataFrame:
    """Long sheet cells: column ranges expanded, values of one property joined, rows numbered. `rows` is about
    how many cells there are.

    Rows come in order of first appearance when reading column by column, section by section.
    """
    if hot is None:
        hot = scan.has_hot_key(cells, SHEET)
    covered = by_sheet(cells, hot, rows).withColumn("col_idx", F.explode(F.sequence(F.col("col_from"), F.col("col_to") - 1)))
    keys = ["sheet_id", "col_idx", "section", "property"]
    pieces = F.array_sort(F.collect_list(F.struct("midy", "frag_id", "value")))
    joined = F.array_join(F.transform(pieces, lambda p: p["value"]), " ")
    values = covered.groupBy(*keys).agg(joined.alias("value"), F.min(F.struct("midy", "frag_id")).alias("_key_at"))
    sectioned = _total(values, ["sheet_id", "col_idx", "section"], {"_section_at": F.min("_key_at")}, hot)
    at = F.struct("col_idx", "_section_at", "_key_at")
    first = _total(sectioned, ["sheet_id", "section", "property"], {"_first": F.min(at)}, hot)
    lead = scan.run(first, SHEET, ["_first", "col_idx"], {"_prev": scan.previous(F.col("_first"))}, hot=hot)
    new = F.when(F.col("_prev").isNull() | (F.col("_prev") != F.col("_first")), 1).otherwise(0)
    numbered = scan.run(lead, SHEET, ["_first", "col_idx"], {"_n": scan.running_sum(new)}, hot=hot)
    return numbered.select("sheet_id", (F.col("_n") - 1).cast("int").alias("row_idx"), "section", "property", "col_idx", "value")


def _total(df: DataFrame, keys: list[str], aggs: dict[str, Column], hot: bool) -> DataFrame:
    """Totals over keys that may be null: a null section is a section of its own."""
    safe = df.withColumn("_section", F.struct(F.col("section").isNull().alias("none"), F.coalesce("section", F.lit("")).alias("text")))
    return scan.totals(safe, ["_section" if k == "section" else k for k in keys], aggs, hot=hot).drop("_section")
