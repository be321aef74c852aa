"""How many panels fit on which area, and what they cost.

Panels and areas belong to a request (one sizing question). Equal sizes inside a request give
equal answers, so the fit runs over distinct sizes and the counts are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specloom.operators.joins import lookup_join


def distinct_sizes(items: DataFrame, count: str) -> DataFrame:
    """One row per (request, w, h) with the number of items of that size."""
    return items.groupBy("request", "w", "h").agg(F.count(F.lit(1)).alias(count))


def orient(panels: DataFrame) -> DataFrame:
    """Portrait (0) and landscape (1) variant of every panel."""
    short, long = F.least("w", "h"), F.greatest("w", "h")
    variants = F.array(
        F.struct(F.lit(0).alias("orient"), short.alias("pw"), long.alias("ph")),
        F.struct(F.lit(1).alias("orient"), long.alias("pw"), short.alias("ph")),
    )
    return panels.select("*", F.inline(variants))


def fit_cross(panels: DataFrame, areas: DataFrame) -> DataFrame:
    """Every panel size in both orientations against every area size of the same request."""
    sized = areas.select("request", F.col("w").alias("aw"), F.col("h").alias("ah"), "n_areas")
    return lookup_join(orient(panels), sized, ["request"])


def _pieces(area: Column, panel: Column, buffer: Column, spacing: Column) -> Column:
    """Whole panels along one side. The buffer is taken off once per side. A side shorter than the
    buffer gives 0 (two negative sides must not multiply to a positive number of panels)."""
    return F.greatest(((area - buffer) / (panel + spacing)).cast("int"), F.lit(0))


def panel_fit(pairs: DataFrame, buffer: Column, spacing: Column) -> DataFrame:
    nx = _pieces(F.col("aw"), F.col("pw"), buffer, spacing)
    ny = _pieces(F.col("ah"), F.col("ph"), buffer, spacing)
    return pairs.withColumns({"nx": nx, "ny": ny})


def fit_report(fits: DataFrame, spacing: Column) -> DataFrame:
    """Per side: length covered, spacing used, half of what is left, the same with one panel more."""
    out = {}
    for side, n, panel, area in (("w", "nx", "pw", "aw"), ("h", "ny", "ph", "ah")):
        covered = F.col(panel) * F.col(n)
        gaps = spacing * F.greatest(F.col(n) - 1, F.lit(0))
        left = F.col(area) - covered - gaps
        out[f"covered_{side}"] = covered
        out[f"gaps_{side}"] = gaps
        out[f"margin_{side}"] = left / 2
        out[f"margin_{side}_one_more"] = (left - F.col(panel) - spacing) / 2
    return fits.withColumns(out)


def best_orientation(fits: DataFrame) -> DataFrame:
    """The orientation with more pieces per (panel, area); a tie keeps portrait."""
    best = F.max_by(F.struct("orient", "nx", "ny"), F.struct((F.col("nx") * F.col("ny")).alias("n"), (-F.col("orient")).alias("o")))
    keys = ["request", "w", "h", "n_panels", "aw", "ah", "n_areas"]
    return fits.groupBy(*keys).agg(best.alias("_b")).select(*keys, "_b.*")


def total_per_size(best: DataFrame, areas: DataFrame) -> DataFrame:
    """(request, w, h, pieces, area_counts) of each panel size: the pieces over all areas of its request and
    the counts of each area in order of its id, as many as the request has areas.

    areas: area_id, request, w, h.
    """
    # Areas of one size go together: their ids are joined to the distinct sizes once.
    sized = areas.groupBy("request", F.col("w").alias("aw"), F.col("h").alias("ah")).agg(F.collect_list("area_id").alias("ids"))
    each = best.join(sized, ["request", "aw", "ah"])
    counted = F.transform("ids", lambda a: F.struct(a.alias("area_id"), F.col("nx").alias("nx"), F.col("ny").alias("ny")))
    return each.groupBy("request", "w", "h").agg(
        F.sum(F.col("nx").cast("long") * F.col("ny") * F.size("ids")).alias("pieces"),
        F.sort_array(F.flatten(F.collect_list(counted))).alias("area_counts"),
    )


def total_per_panel(best: DataFrame, panels: DataFrame, areas: DataFrame) -> DataFrame:
    """The totals of its size for each panel (panel_id, request, w, h); 0 and none where the request has no
    area."""
    totals = total_per_size(best, areas)
    none = F.array().cast(totals.schema["area_counts"].dataType)
    named = panels.join(totals, ["request", "w", "h"], "left")
    return named.withColumns({"pieces": F.coalesce("pieces", F.lit(0).cast("long")), "area_counts": F.coalesce("area_counts", none)})


def price_metrics(prices: DataFrame) -> DataFrame:
    """Price per watt and watts per square metre; null where the divisor is 0."""
    area = F.col("w").cast("long") * F.col("h") / 1_000_000.0
    return prices.withColumns(
        {
            "price_per_watt": F.try_divide(F.col("price"), F.col("watts")),
            "watt_per_sqm": F.try_divide(F.col("watts"), area),
        }
    )
