"""Queries of the sizing calculators."""

from __future__ import annotations

from pyspark.sql import functions as F

from specloom.functions import text as X
from specloom.operators import layout, mapping, setups
from specloom.plans.mapping_queries import TYPED, filled, fold_sql
from specloom.plans.registry import query
from specloom.plans.views import ctes, view

BUFFER, SPACING = "20cm", "2cm"
_B, _S = 200, 20

# Oracle parsing: a length with its unit, the other side's unit, or mm; cut to whole mm.
_MM = "trunc(CAST(regexp_extract({0}, '^([0-9.]+)', 1) AS DOUBLE) * CASE coalesce(nullif(regexp_extract({0}, '(mm|cm|m)$', 1), ''), nullif(regexp_extract({1}, '(mm|cm|m)$', 1), ''), 'mm') WHEN 'mm' THEN 1 WHEN 'cm' THEN 10 ELSE 1000 END)::INT"


def _size_sql(text: str) -> str:
    a, b = f"split_part({text}, 'x', 1)", f"split_part({text}, 'x', 2)"
    return f"{_MM.format(a, b)} AS w, {_MM.format(b, a)} AS h"


SIZES = (
    ctes("v_panel", "v_area")
    + f""",
panel_mm AS (SELECT panel_id, request, {_size_sql('size_text')} FROM v_panel),
area_mm AS (SELECT area_id, request, {_size_sql('area_text')} FROM v_area),
panel_size AS (SELECT request, w, h, count(*) AS n_panels FROM panel_mm GROUP BY ALL),
area_size AS (SELECT request, w AS aw, h AS ah, count(*) AS n_areas FROM area_mm GROUP BY ALL),
oriented AS (SELECT *, 0 AS orient, least(w, h) AS pw, greatest(w, h) AS ph FROM panel_size
  UNION ALL SELECT *, 1, greatest(w, h), least(w, h) FROM panel_size),
crossed AS (SELECT * FROM oriented JOIN area_size USING (request)),
fits AS (SELECT *, greatest(0, trunc((aw - {_B}) / (pw + {_S}))::INT) AS nx, greatest(0, trunc((ah - {_B}) / (ph + {_S}))::INT) AS ny FROM crossed),
best AS (SELECT * FROM fits QUALIFY row_number() OVER (PARTITION BY request, w, h, aw, ah ORDER BY nx * ny DESC, orient) = 1)"""
)
_KEYS = "request, w, h, n_panels, aw, ah, n_areas"


def panels(spark, sf):
    return view(spark, sf, "v_panel").select("panel_id", "request", F.inline(F.array(X.size_mm(F.col("size_text")))))


def areas(spark, sf):
    return view(spark, sf, "v_area").select("area_id", "request", F.inline(F.array(X.size_mm(F.col("area_text")))))


def panel_sizes(spark, sf):
    return layout.distinct_sizes(panels(spark, sf), "n_panels")


def area_sizes(spark, sf):
    return layout.distinct_sizes(areas(spark, sf), "n_areas")


def fits(spark, sf):
    pairs = layout.fit_cross(panel_sizes(spark, sf), area_sizes(spark, sf))
    return layout.panel_fit(pairs, X.length_mm(F.lit(BUFFER)), X.length_mm(F.lit(SPACING)))


@query("parse_size", SIZES + " SELECT panel_id, w, h FROM panel_mm")
def parse_size(spark, sf):
    panels = view(spark, sf, "v_panel")
    return panels.select("panel_id", F.inline(F.array(X.size_mm(F.col("size_text")))))


@query("orient", SIZES + " SELECT request, w, h, n_panels, orient, pw, ph FROM oriented")
def orient(spark, sf):
    return layout.orient(panel_sizes(spark, sf))


@query("fit_cross", SIZES + f" SELECT {_KEYS}, orient, pw, ph FROM crossed")
def fit_cross(spark, sf):
    return layout.fit_cross(panel_sizes(spark, sf), area_sizes(spark, sf))


@query("panel_fit", SIZES + f" SELECT {_KEYS}, orient, pw, ph, nx, ny FROM fits")
def panel_fit(spark, sf):
    return fits(spark, sf)


_REPORT = ", ".join(
    f"{p} * {n} AS covered_{s}, {_S} * greatest({n} - 1, 0) AS gaps_{s}, "
    f"({a} - {p} * {n} - {_S} * greatest({n} - 1, 0)) / 2 AS margin_{s}, "
    f"({a} - {p} * {n} - {_S} * greatest({n} - 1, 0) - {p} - {_S}) / 2 AS margin_{s}_one_more"
    for s, n, p, a in (("w", "nx", "pw", "aw"), ("h", "ny", "ph", "ah"))
)


@query("fit_report", SIZES + f" SELECT {_KEYS}, orient, nx, ny, {_REPORT} FROM fits")
def fit_report(spark, sf):
    return layout.fit_report(fits(spark, sf), X.length_mm(F.lit(SPACING))).drop("pw", "ph")


@query("best_orientation", SIZES + f" SELECT {_KEYS}, orient, nx, ny FROM best")
def best_orientation(spark, sf):
    return layout.best_orientation(fits(spark, sf))


@query(
    "total_per_panel",
    SIZES + " SELECT p.panel_id, p.request, coalesce(sum(nx * ny), 0)::BIGINT AS pieces, coalesce(string_agg(concat(area_id, ':', nx, '*', ny), ' ' ORDER BY area_id) FILTER (area_id IS NOT NULL), '') AS area_counts"
    " FROM panel_mm p LEFT JOIN (SELECT b.*, area_id FROM best b JOIN area_mm a ON a.request = b.request AND a.w = aw AND a.h = ah) f ON f.request = p.request AND f.w = p.w AND f.h = p.h GROUP BY ALL",
)
def total_per_panel(spark, sf):
    """The counts are written out once for each panel size, not for each panel."""
    totals = layout.total_per_size(layout.best_orientation(fits(spark, sf)), areas(spark, sf))
    one = lambda c: F.concat(c["area_id"], F.lit(":"), c["nx"], F.lit("*"), c["ny"])
    shown = totals.withColumn("area_counts", F.array_join(F.transform("area_counts", one), " "))
    named = panels(spark, sf).join(shown, ["request", "w", "h"], "left")
    return named.select("panel_id", "request", F.coalesce("pieces", F.lit(0).cast("long")).alias("pieces"), F.coalesce("area_counts", F.lit("")).alias("area_counts"))


@query(
    "price_metrics",
    ctes("v_panel") + " SELECT panel_id, price / nullif(watts, 0) AS price_per_watt, watts / nullif(w * h / 1000000.0::DOUBLE, 0) AS watt_per_sqm FROM v_panel",
)
def price_metrics(spark, sf):
    return layout.price_metrics(view(spark, sf, "v_panel")).select("panel_id", "price_per_watt", "watt_per_sqm")


_DEVICES = f""", typed AS (SELECT CAST(sheet_id * 4 + col_idx AS BIGINT) AS device_id, {TYPED} FROM folded),
device AS (SELECT device_id, CAST(pv_input__v_mppt__min AS DOUBLE) AS v_min, CAST(pv_input__v_mppt__max AS DOUBLE) AS v_max,
  list_sum(list_transform(string_split(nullif(pv_input__i_sc, ''), '|'), lambda v: CAST(v AS DOUBLE))) AS i_max FROM typed)"""
_SETUP_SQL = (
    fold_sql()
    + _DEVICES
    + ",\n"
    + SIZES.removeprefix("WITH ")
    + """, total AS (SELECT p.panel_id, p.request, coalesce(sum(nx * ny * n_areas), 0)::BIGINT AS pieces FROM panel_mm p LEFT JOIN best b ON b.request = p.request AND b.w = p.w AND b.h = p.h GROUP BY ALL),
own AS (SELECT t.panel_id, t.pieces, 30.0::DOUBLE + v.w % 12 AS volts, v.watts / (30.0::DOUBLE + v.w % 12) AS amps FROM total t JOIN v_panel v USING (panel_id)),
kind AS (SELECT DISTINCT pieces, volts, amps FROM own WHERE pieces > 0),
wired AS (SELECT *, pieces // series AS parallel FROM (SELECT *, unnest(range(1, pieces + 1)) AS series FROM kind) WHERE pieces % series = 0),
class AS (SELECT v_min, v_max, i_max, count(*) AS n_devices, min(device_id) AS device_id FROM device WHERE i_max IS NOT NULL GROUP BY ALL),
met AS (SELECT * FROM wired JOIN class ON series * volts BETWEEN v_min AND v_max AND parallel * amps <= i_max
  QUALIFY row_number() OVER (PARTITION BY pieces, volts, amps, v_min, v_max, i_max ORDER BY series DESC) = 1),
pick AS (SELECT *, sum(n_devices) OVER (PARTITION BY pieces, volts, amps)::BIGINT AS n FROM met QUALIFY row_number() OVER (PARTITION BY pieces, volts, amps ORDER BY parallel, v_max, i_max, v_min) = 1)
SELECT o.panel_id, coalesce(p.n, 0) AS n_devices, p.device_id, p.series, p.parallel FROM own o LEFT JOIN pick p ON p.pieces = o.pieces AND p.volts = o.volts AND p.amps = o.amps"""
)


@query("device_setups", _SETUP_SQL)
def device_setups(spark, sf):
    """Panel counts of each roof wired as equal strings to the devices whose typed ranges take them."""
    totals = layout.total_per_panel(layout.best_orientation(fits(spark, sf)), panels(spark, sf), areas(spark, sf))
    volts = F.lit(30.0) + F.col("w") % 12
    own = view(spark, sf, "v_panel").select("panel_id", volts.alias("volts"), (F.col("watts") / volts).alias("amps"))
    typed = mapping.typed_leaves(filled(spark, sf))
    devices = typed.select(
        (F.col("sheet_id") * 4 + F.col("col_idx")).alias("device_id"),
        F.col("`pv_input.v_mppt.min`").cast("double").alias("v_min"),
        F.col("`pv_input.v_mppt.max`").cast("double").alias("v_max"),
        F.aggregate(F.when(F.size("`pv_input.i_sc`") > 0, F.col("`pv_input.i_sc`")), F.lit(0.0), lambda a, v: a + v).alias("i_max"),
    )
    return setups.best_setups(totals.select("panel_id", "pieces").join(own, "panel_id"), devices)
