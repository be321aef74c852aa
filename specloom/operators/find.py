"""All fragments of a page that lie in a box and match a pattern, in order.

A page is cut into a grid of about `CELL_FRAGMENTS` fragments a cell. Boxes and fragments meet by an equi
join on page and cell; a request without a box takes its whole page.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specloom.functions import text as X
from specloom.operators import scan
from specloom.operators.joins import shuffled
from specloom.operators.nearest import BOX, PAGE

CELL_FRAGMENTS = 4
# What a match gives: the whole text, the first group or else the match, all groups, or the box as well.
RETURNS = ("text", "match", "groups", "textline")
# How matches are sorted: by a side, ascending or not.
SORTS = {"right": ("minx", 1), "left": ("minx", -1), "up": ("miny", 1), "down": ("miny", -1)}


def _grid(fragments: DataFrame) -> DataFrame:
    """Origin, cell sides and cells along each axis of every page."""
    sides = {f"_{e}": f(c) for e, f, c in (("x0", F.min, "minx"), ("y0", F.min, "miny"), ("x1", F.max, "maxx"), ("y1", F.max, "maxy"))}
    pages = fragments.groupBy(*PAGE).agg(F.count(F.lit(1)).alias("_n"), *[c.alias(n) for n, c in sides.items()])
    cells = F.greatest(F.ceil(F.sqrt(F.col("_n") / CELL_FRAGMENTS)), F.lit(1))
    side = lambda a, b: F.greatest((F.col(b) - F.col(a)) / cells, F.lit(1e-6))
    return pages.select(*PAGE, "_x0", "_y0", cells.alias("_cells"), side("_x0", "_x1").alias("_w"), side("_y0", "_y1").alias("_h"))


def _cell(axis: str, value: str) -> Column:
    """Cell of a coordinate; what lies off the grid counts to its border."""
    origin, size = ("_x0", "_w") if axis == "x" else ("_y0", "_h")
    at = F.floor((F.col(value) - F.col(origin)) / F.col(size))
    return F.greatest(F.least(at, F.col("_cells") - 1), F.lit(0).cast("long"))


def _inside(how: str) -> Column:
    if how == "contains":
        return (F.col("q_minx") <= F.col("minx")) & (F.col("maxx") <= F.col("q_maxx")) & (F.col("q_miny") <= F.col("miny")) & (F.col("maxy") <= F.col("q_maxy"))
    if how == "intersects":
        return (F.greatest("q_minx", "minx") < F.least("q_maxx", "maxx")) & (F.greatest("q_miny", "miny") < F.least("q_maxy", "maxy"))
    raise ValueError(f"unknown match {how}")


def find(requests: DataFrame, fragments: DataFrame, *, pattern: str = ".*", ret: str = "text", how: str = "contains", sort: str | None = None, hot: bool | None = None) -> DataFrame:
    """One row for each match: doc_id, page, find_id, match_no (from 0), frag_id, and what `ret` asks for.

    requests: doc_id, page, find_id and q_minx .. q_maxy, all null for the whole page. fragments: doc_id,
    page, frag_id, text and box. The pattern may match anywhere in a text. `text` gives `value`, the text;
    `match` gives `value`, the only group of the pattern or else what matched; `groups` gives an array
    `groups`; `textline` gives the text and the box. Matches come in the order of the fragments, or by
    `sort`: to the right or up by the smaller coordinate first, left or down by the larger; ties by frag_id.
    A group that took no part is null. A null text matches nothing; a find_id stands for one request.
    """
    if ret not in RETURNS:
        raise ValueError(f"ret must be one of {RETURNS}")
    if sort is not None and sort not in SORTS:
        raise ValueError(f"sort must be one of {tuple(SORTS)}")
    n_groups = re.compile(pattern).groups
    matching = fragments.where(F.col("text").rlike(pattern)).select(*PAGE, "frag_id", "text", *BOX)
    grid = _grid(fragments)
    asked = requests.select(*PAGE, "find_id", *[f"q_{c}" for c in BOX])
    boxed = asked.where("q_minx is not null").join(shuffled(grid), PAGE)
    placed = matching.join(shuffled(grid), PAGE)
    over = lambda axis, lo, hi: F.explode(F.sequence(_cell(axis, lo), _cell(axis, hi)))
    # A box that ends before it begins holds nothing.
    boxed = boxed.where("q_minx <= q_maxx and q_miny <= q_maxy")
    cells = boxed.withColumn("_gx", over("x", "q_minx", "q_maxx")).withColumn("_gy", over("y", "q_miny", "q_maxy"))
    if how == "contains":
        # The upper left corner of what a box contains lies in one of its cells.
        entered = placed.withColumns({"_gx": _cell("x", "minx"), "_gy": _cell("y", "miny")})
        once = F.lit(True)
    else:
        upright = placed.where("minx <= maxx and miny <= maxy")
        entered = upright.withColumn("_gx", over("x", "minx", "maxx")).withColumn("_gy", over("y", "miny", "maxy"))
        # A pair counts in the first cell that both share.
        first = lambda axis, g, lo: F.col(g) == F.greatest(_cell(axis, lo), _cell(axis, f"q_{lo}"))
        once = first("x", "_gx", "minx") & first("y", "_gy", "miny")
    cells = cells.select(*PAGE, "find_id", "_gx", "_gy", *[f"q_{c}" for c in BOX])
    met = cells.join(shuffled(entered), [*PAGE, "_gx", "_gy"]).where(_inside(how) & once)
    kept = ["find_id", "frag_id", "text", *BOX]
    whole = asked.where("q_minx is null").select(*PAGE, "find_id").join(shuffled(matching), PAGE)
    hits = met.select(*PAGE, *kept).unionByName(whole.select(*PAGE, *kept))

    side, sign = SORTS[sort] if sort else (None, 1)
    at = F.col(side) * sign if side else F.lit(0.0)
    keys = [*PAGE, "find_id"]
    numbered = scan.run(hits.withColumn("_at", at), keys, ["_at", "frag_id"], {"match_no": scan.position()}, hot=hot)
    only = F.nullif(F.regexp_extract("text", pattern, 1), F.lit("")) if n_groups == 1 else F.regexp_extract("text", pattern, 0)
    shown = {
        "text": [F.col("text").alias("value")],
        "match": [only.alias("value")],
        "groups": [(X.groups(F.col("text"), pattern, n_groups) if n_groups else F.array().cast("array<string>")).alias("groups")],
        "textline": [F.col("text").alias("value"), *BOX],
    }
    return numbered.select(*keys, "match_no", "frag_id", *shown[ret])
