"""Nearest fragment beside a fragment, and fragments at the edge of a page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specloom.functions import bbox
from specloom.operators import scan
from specloom.operators.joins import shuffled

PAGE = ["doc_id", "page"]
BOX = ["minx", "miny", "maxx", "maxy"]
BAND_FRAGMENTS = 4  # a page is cut into bands of about so many fragments, across the search direction


def page_boxes(fragments: DataFrame) -> DataFrame:
    """Box around everything on a page, where no page size is given."""
    return fragments.groupBy(*PAGE).agg(
        F.min("minx").alias("page_minx"), F.min("miny").alias("page_miny"), F.max("maxx").alias("page_maxx"), F.max("maxy").alias("page_maxy")
    )


def search_box(direction: str, grow: float) -> dict[str, Column]:
    """Strip of the page on one side of the anchor, grown by an amount on all sides."""
    sides = bbox.strip({c: F.col(f"a_{c}") for c in BOX}, {c: F.col(f"page_{c}") for c in BOX}, direction)
    return {f"s_{c}": sides[c] + (grow if c.startswith("max") else -grow) for c in BOX}


def _hit(how: str) -> Column:
    if how == "contains":
        return (F.col("s_minx") <= F.col("minx")) & (F.col("maxx") <= F.col("s_maxx")) & (F.col("s_miny") <= F.col("miny")) & (F.col("maxy") <= F.col("s_maxy"))
    if how == "intersects":
        return (F.greatest("s_minx", "minx") < F.least("s_maxx", "maxx")) & (F.greatest("s_miny", "miny") < F.least("s_maxy", "maxy"))
    raise ValueError(f"unknown match {how}")


def nearest_fragment(
    anchors: DataFrame,
    fragments: DataFrame,
    direction: str,
    *,
    pages: DataFrame,
    pattern: str = ".*",
    grow: float = 0.0,
    how: str = "contains",
) -> DataFrame:
    """First fragment beside each anchor whose text matches, with the number of matches.

    anchors: doc_id, page, anchor_id and a_minx..a_maxy. Equal boxes are folded to one candidate
    first. Strip and candidates meet in bands across the strip (an equi join on page and band), and
    only the best candidate per anchor leaves a task. Ties go to the smaller frag_id.
    """
    axis, sign = bbox.DIRECTIONS[direction]
    across = "y" if axis == "x" else "x"
    lo, hi = f"min{across}", f"max{across}"
    counted = fragments.groupBy(*PAGE).agg(F.ceil(F.count(F.lit(1)) / BAND_FRAGMENTS).alias("_bands"))
    height = (F.col(f"page_max{across}") - F.col(f"page_min{across}")) / F.col("_bands")
    spread = pages.join(shuffled(counted), PAGE).withColumn("_h", F.greatest(height, F.lit(1e-6)))
    band = lambda c: F.floor((c - F.col(f"page_min{across}")) / F.col("_h"))
    first, last = F.lit(0).cast("long"), F.col("_bands") - 1
    clamp = lambda c: F.greatest(F.least(c, last), first)

    folded = fragments.filter(F.col("text").rlike(pattern)).groupBy(*PAGE, *BOX).agg(
        F.min(F.struct("frag_id", "text")).alias("_f"), F.count(F.lit(1)).alias("_copies")
    )
    placed = folded.join(shuffled(spread.select(*PAGE, "_h", "_bands", f"page_min{across}")), PAGE)
    if how == "contains":
        # a contained candidate has its leading edge inside the strip: one band is enough
        entered = placed.withColumn("_band", clamp(band(F.col(lo))))
        met = F.lit(True)
    else:
        entered = placed.withColumn("_band", F.explode(F.sequence(clamp(band(F.col(lo))), clamp(band(F.col(hi))))))
        # count a pair only in the first band both share
        met = F.col("_band") == F.greatest(clamp(band(F.col(lo))), clamp(band(F.col(f"s_{lo}"))))
    strips = anchors.join(shuffled(spread), PAGE).withColumns(search_box(direction, grow))
    bands = F.sequence(clamp(band(F.col(f"s_{lo}"))), clamp(band(F.col(f"s_{hi}"))))
    strips = strips.withColumn("_band", F.explode(bands)).select(*PAGE, "anchor_id", "_band", *[f"s_{c}" for c in BOX])

    position = F.col("minx" if axis == "x" else "miny") * sign
    pairs = strips.join(shuffled(entered), [*PAGE, "_band"]).filter(_hit(how) & met)
    best = F.min(F.struct(position.alias("at"), F.col("_f.frag_id").alias("frag_id"), F.col("_f.text").alias("text")))
    found = pairs.groupBy(*PAGE, "anchor_id").agg(F.sum("_copies").alias("n_found"), best.alias("_b"))
    return found.select(*PAGE, "anchor_id", "n_found", F.col("_b.frag_id").alias("frag_id"), F.col("_b.text").alias("text"))


def first_by_extreme(fragments: DataFrame, side: str, eps: float, *, largest: bool = False, hot: bool | None = None) -> DataFrame:
    """Fragments less than eps from the outermost one of a page, numbered along the other axis."""
    edge = F.max(side) if largest else F.min(side)
    other = side[:-1] + ("x" if side.endswith("y") else "y")
    marked = scan.totals(fragments, PAGE, {"_edge": edge}, hot=hot)
    near = marked.filter(F.abs(F.col(side) - F.col("_edge")) < eps).drop("_edge")
    return scan.run(near, PAGE, [other, "frag_id"], {"position": scan.position()}, hot=hot)


def nearest_in_sequence(items: DataFrame, sequence: DataFrame, keys: list[str], value: str, eps: float, *, hot: bool | None = None) -> DataFrame:
    """Nearest member of a sequence for each item, if it is less than eps away.

    sequence: keys, value, seq_id. Both are sorted together; the nearest is the last member before
    or the first after, so no pairs are built. A tie goes to the smaller one.
    """
    own = items.select(*keys, F.col(value).alias("_v"), F.col("frag_id"), F.lit(1).alias("_kind"), F.lit(None).cast("int").alias("seq_id"))
    seq = sequence.select(*keys, F.col(value).alias("_v"), F.lit(None).cast("long").alias("frag_id"), F.lit(0).alias("_kind"), F.col("seq_id").cast("int"))
    member = F.when(F.col("_kind") == 0, F.struct(F.col("_v").alias("v"), F.col("seq_id").alias("id")))
    order = ["_v", "_kind", "seq_id", "frag_id"]
    both = scan.run(own.withColumn("frag_id", F.col("frag_id").cast("long")).unionByName(seq), keys, order, {"_lo": scan.last_known(member), "_hi": scan.next_known(member)}, hot=hot)
    below, above = F.col("_v") - F.col("_lo.v"), F.col("_hi.v") - F.col("_v")
    take_low = F.col("_lo").isNotNull() & (F.col("_hi").isNull() | (below <= above))
    gap, pick = F.when(take_low, below).otherwise(above), F.when(take_low, F.col("_lo.id")).otherwise(F.col("_hi.id"))
    return both.filter("_kind = 1").select(*keys, "frag_id", F.when(gap < eps, pick).alias("seq_id"))
