"""Queries over boxes, glyphs, nearest fragments and one-dimensional clusters."""

from __future__ import annotations

from pyspark.sql import functions as F

from specloom.functions import bbox as B
from specloom.operators import clusters, edges, find, nearest, scan
from specloom.operators import tables as T
from specloom.plans.registry import query
from specloom.plans.table_queries import CLUSTERED, Pages
from specloom.plans.views import ctes, view
from specloom.sources import glyphs

FRAG = ctes("v_fragment")
_PAGE_MAXY = 842.0


def _boxed(spark, sf):
    f = view(spark, sf, "v_fragment")
    box = B.box(F.col("minx"), F.col("miny"), F.col("maxx"), F.col("maxy"))
    page = B.from_xywh(F.lit(0.0), F.lit(0.0), F.lit(595.0), F.lit(_PAGE_MAXY))
    return f.select("doc_id", "frag_id", box.alias("b"), page.alias("page"))


@query(
    "bbox_scalars",
    FRAG
    + """ SELECT doc_id, frag_id, minx - 1 AS g1_minx, maxy + 1 AS g1_maxy, minx - 2 AS g2_minx, maxy + 3 AS g2_maxy, miny - 2 AS g4_miny, maxx + 3 AS g4_maxx,
 least(minx, 100.0::DOUBLE) AS u_minx, greatest(maxy, 220.0::DOUBLE) AS u_maxy, (minx + maxx) / 2 AS mx, (miny + maxy) / 2 AS my,
 maxx AS right_minx, 595.0::DOUBLE AS right_maxx, 0.0::DOUBLE AS left_minx, minx AS left_maxx, maxy AS up_miny, 842.0::DOUBLE AS up_maxy, 0.0::DOUBLE AS down_miny, miny AS down_maxy,
 CAST(NULL AS DOUBLE) AS span_minx, miny AS span_miny, 7.5::DOUBLE AS set_maxy, 90.0::DOUBLE AS xywh_maxx FROM v_fragment""",
)
def bbox_scalars(spark, sf):
    b, page = F.col("b"), F.col("page")
    g1, g2 = B.grow(b, F.lit(1.0)), B.grow(b, F.lit(2.0), F.lit(3.0))
    g4 = B.grow(b, F.lit(1.0), F.lit(2.0), F.lit(3.0), F.lit(4.0))
    u = B.union(b, B.box(F.lit(100.0), F.lit(150.0), F.lit(110.0), F.lit(220.0)))
    right, left, up, down = (B.beside(b, page, d) for d in ("right", "left", "up", "down"))
    span = B.only(b, "y")
    return _boxed(spark, sf).select(
        "doc_id",
        "frag_id",
        g1["minx"].alias("g1_minx"),
        g1["maxy"].alias("g1_maxy"),
        g2["minx"].alias("g2_minx"),
        g2["maxy"].alias("g2_maxy"),
        g4["miny"].alias("g4_miny"),
        g4["maxx"].alias("g4_maxx"),
        u["minx"].alias("u_minx"),
        u["maxy"].alias("u_maxy"),
        B.midx(b).alias("mx"),
        B.midy(b).alias("my"),
        right["minx"].alias("right_minx"),
        right["maxx"].alias("right_maxx"),
        left["minx"].alias("left_minx"),
        left["maxx"].alias("left_maxx"),
        up["miny"].alias("up_miny"),
        up["maxy"].alias("up_maxy"),
        down["miny"].alias("down_miny"),
        down["maxy"].alias("down_maxy"),
        span["minx"].alias("span_minx"),
        span["miny"].alias("span_miny"),
        B.with_side(b, "maxy", F.lit(7.5))["maxy"].alias("set_maxy"),
        B.from_xywh(F.lit(40.0), F.lit(0.0), F.lit(50.0), F.lit(1.0))["maxx"].alias("xywh_maxx"),
    )


@query("flip_y", FRAG + " SELECT doc_id, frag_id, minx, 842.0::DOUBLE - maxy AS miny, maxx, 842.0::DOUBLE - miny AS maxy FROM v_fragment")
def flip_y(spark, sf):
    flipped = B.flip_y(F.col("b"), F.lit(_PAGE_MAXY))
    return _boxed(spark, sf).select("doc_id", "frag_id", F.inline(F.array(flipped)))


@query("bbox_contains", FRAG + " SELECT doc_id, frag_id FROM v_fragment WHERE 100.0 <= minx AND maxx <= 240.0 AND 120.0 <= miny AND maxy <= 250.0")
def bbox_contains(spark, sf):
    area = B.box(F.lit(100.0), F.lit(120.0), F.lit(240.0), F.lit(250.0))
    return _boxed(spark, sf).filter(B.contains(area, F.col("b"))).select("doc_id", "frag_id")


@query("bbox_intersects", FRAG + " SELECT doc_id, frag_id FROM v_fragment WHERE greatest(minx, 160.0) < least(maxx, 240.0) AND greatest(miny, 120.0) < least(maxy, 250.0)")
def bbox_intersects(spark, sf):
    area = B.box(F.lit(160.0), F.lit(120.0), F.lit(240.0), F.lit(250.0))
    return _boxed(spark, sf).filter(B.intersects(area, F.col("b"))).select("doc_id", "frag_id")


def _nearest_sql(strip: str, hit: str, order: str, pattern: str) -> str:
    return (
        FRAG
        + f""", pg AS (SELECT doc_id, page, min(minx) AS x0, min(miny) AS y0, max(maxx) AS x1, max(maxy) AS y1 FROM v_fragment GROUP BY 1, 2),
a AS (SELECT f.doc_id, f.page, f.frag_id AS anchor_id, {strip} FROM v_fragment f JOIN pg ON pg.doc_id = f.doc_id AND pg.page = f.page),
hit AS (SELECT a.doc_id, a.page, a.anchor_id, c.frag_id, c.text, {order} AS pos FROM a JOIN v_fragment c ON c.doc_id = a.doc_id AND c.page = a.page AND {hit} AND regexp_matches(c.text, '{pattern}'))
SELECT doc_id, page, anchor_id, count(*) AS n_found, arg_min(frag_id, [pos, frag_id]) AS frag_id, arg_min(text, [pos, frag_id]) AS text FROM hit GROUP BY 1, 2, 3"""
    )


_IN = "a.sx0 <= c.minx AND c.maxx <= a.sx1 AND a.sy0 <= c.miny AND c.maxy <= a.sy1"
_TOUCH = "greatest(a.sx0, c.minx) < least(a.sx1, c.maxx) AND greatest(a.sy0, c.miny) < least(a.sy1, c.maxy)"


def _nearest(spark, sf, direction, **options):
    f = view(spark, sf, "v_fragment")
    anchors = f.select("doc_id", "page", F.col("frag_id").alias("anchor_id"), *[F.col(c).alias(f"a_{c}") for c in T.BOX])
    return nearest.nearest_fragment(anchors, f, direction, pages=nearest.page_boxes(f), **options)


@query(
    "nearest_fragment",
    _nearest_sql("f.maxx - 7 AS sx0, f.miny - 7 AS sy0, pg.x1 + 7 AS sx1, f.maxy + 7 AS sy1", _IN, "c.minx", "."),
)
def nearest_fragment(spark, sf):
    """First fragment to the right of each fragment."""
    return _nearest(spark, sf, "right", grow=7.0, pattern=".")


@query(
    "nearest_above",
    _nearest_sql("f.minx - 60 AS sx0, pg.y0 - 60 AS sy0, f.maxx + 60 AS sx1, f.miny + 60 AS sy1", _TOUCH, "-c.miny", "[0-9]"),
)
def nearest_above(spark, sf):
    """Search against the axis, with overlap instead of containment and a text pattern."""
    return _nearest(spark, sf, "down", grow=60.0, pattern="[0-9]", how="intersects")


@query(
    "first_by_extreme",
    FRAG + """, e AS (SELECT *, min(minx) OVER (PARTITION BY doc_id, page) AS edge FROM v_fragment)
 SELECT doc_id, page, frag_id, text, CAST(row_number() OVER (PARTITION BY doc_id, page ORDER BY miny, frag_id) - 1 AS INT) AS position FROM e WHERE abs(minx - edge) < 10""",
)
def first_by_extreme(spark, sf):
    return nearest.first_by_extreme(view(spark, sf, "v_fragment"), "minx", 10).select("doc_id", "page", "frag_id", "text", "position")


_SEQ = FRAG + """, s AS (SELECT doc_id, page, miny, CAST(frag_id AS INT) AS seq_id FROM (SELECT *, min(minx) OVER (PARTITION BY doc_id, page) AS edge FROM v_fragment) WHERE abs(minx - edge) < 10),
d AS (SELECT f.doc_id, f.page, f.frag_id, s.seq_id, abs(s.miny - f.miny) AS dist FROM v_fragment f JOIN s ON s.doc_id = f.doc_id AND s.page = f.page)
SELECT doc_id, page, CAST(frag_id AS BIGINT) AS frag_id, CASE WHEN min(dist) < 10 THEN arg_min(seq_id, [dist, CAST(seq_id AS DOUBLE)]) END AS seq_id FROM d GROUP BY 1, 2, 3"""


@query("match_sequence", _SEQ)
def match_sequence(spark, sf):
    """Nearest line of the outermost column for each fragment."""
    f = view(spark, sf, "v_fragment")
    heads = nearest.first_by_extreme(f, "minx", 10).select("doc_id", "page", "miny", F.col("frag_id").alias("seq_id"))
    return nearest.nearest_in_sequence(f, heads, ["doc_id", "page"], "miny", 10)


@query(
    "resolve_cols_by_edges",
    CLUSTERED
    + """,
col AS (SELECT sheet_id, k, centre, row_number() OVER (PARTITION BY sheet_id ORDER BY centre DESC) AS r FROM hc),
cw AS (SELECT sheet_id, k, r, 2 * centre - 395 AS edge FROM col WHERE r = 1 UNION ALL SELECT c.sheet_id, c.k, c.r, 2 * c.centre - w.edge FROM cw w JOIN col c ON c.sheet_id = w.sheet_id AND c.r = w.r + 1),
cl AS (SELECT sheet_id, row_id, cluster_id, centre, row_number() OVER (PARTITION BY sheet_id, row_id ORDER BY centre DESC) AS r FROM clu_centre),
lw AS (SELECT sheet_id, row_id, cluster_id, r, 2 * centre - 395 AS edge FROM cl WHERE r = 1 UNION ALL SELECT c.sheet_id, c.row_id, c.cluster_id, c.r, 2 * c.centre - w.edge FROM lw w
  JOIN cl c ON c.sheet_id = w.sheet_id AND c.row_id = w.row_id AND c.r = w.r + 1),
hit AS (SELECT l.sheet_id, l.row_id, l.cluster_id, min(c.k) AS col_from FROM lw l LEFT JOIN cw c ON c.sheet_id = l.sheet_id AND abs(c.edge - l.edge) < 15 GROUP BY 1, 2, 3),
full_row AS (SELECT sheet_id, row_id FROM hit GROUP BY 1, 2 HAVING count(*) = count(col_from))
SELECT h.sheet_id, h.row_id, h.cluster_id, CAST(col_from AS INT) AS col_from, CAST(coalesce(lead(col_from) OVER (PARTITION BY h.sheet_id, h.row_id ORDER BY h.cluster_id), n) AS INT) AS col_to
 FROM hit h JOIN full_row USING (sheet_id, row_id) JOIN ncol USING (sheet_id)""",
)
def resolve_cols_by_edges(spark, sf):
    p = Pages(spark, sf)
    clustered = T.row_clusters(p.settled().filter("kind = 'cell' and row_id is not null"), hot=p.hot)
    kept = T.drop_early_cells(T.header_centres(clustered, hot=p.hot))
    centre = ((F.min("midx") + F.max("midx")) / 2).alias("centre")
    centres = kept.groupBy(*T.ROW, "cluster_id").agg(centre, F.first("header").alias("header"), F.lit(395.0).alias("area_maxx"))
    # one header per sheet: every sheet with cells has its row 0
    header = centres.filter("row_id = 0").groupBy("sheet_id").agg(F.first("header").alias("h"), F.first("area_maxx").alias("area_maxx"))
    columns = header.select("sheet_id", F.explode("h").alias("centre"), "area_maxx")
    found = edges.resolve_cols_by_edges(centres.drop("header"), columns, hot=p.hot)
    # clusters are counted from the first one kept
    numbered = scan.run(found, T.ROW, ["cluster_id"], {"_k": scan.position()}, hot=p.hot)
    return numbered.select(*T.ROW, F.col("_k").alias("cluster_id"), "col_from", "col_to")


GLYPH = ctes("v_glyph")


@query(
    "src_glyph_runs",
    GLYPH
    + r"""
, run AS (SELECT *, CAST(sum(CASE WHEN has_font THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, page, line_id ORDER BY seq) AS BIGINT) AS run_id FROM v_glyph),
ink AS (SELECT doc_id, page, line_id, run_id, min(seq) AS f, max(seq) AS t FROM run WHERE has_font AND trim(coalesce(ch, '')) <> '' GROUP BY ALL),
cut AS (SELECT r.* FROM run r JOIN ink i USING (doc_id, page, line_id, run_id) WHERE has_font AND seq BETWEEN f AND t)
SELECT doc_id, page, line_id, run_id, string_agg(coalesce(nullif(ch, ''), ' '), '' ORDER BY seq) AS text, min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy FROM cut GROUP BY ALL""",
)
def src_glyph_runs(spark, sf):
    return glyphs.glyph_runs(view(spark, sf, "v_glyph"))


@query(
    "src_loose_glyph_lines",
    ctes("v_loose")
    + r"""
, l1 AS (SELECT *, lag(miny) OVER (PARTITION BY doc_id, page ORDER BY miny DESC, glyph_id) - miny AS gap FROM v_loose),
l2 AS (SELECT *, CAST(sum(CASE WHEN gap > 2 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, page ORDER BY miny DESC, glyph_id) AS BIGINT) AS line_no FROM l1),
w1 AS (SELECT *, minx - lag(maxx) OVER (PARTITION BY doc_id, page, line_no ORDER BY minx, glyph_id) AS gap2 FROM l2),
w2 AS (SELECT *, CAST(sum(CASE WHEN gap2 > 5 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, page, line_no ORDER BY minx, glyph_id) AS BIGINT) AS word_no FROM w1),
j AS (SELECT doc_id, page, line_no, word_no, trim(string_agg(CASE WHEN ch = chr(160) THEN ' ' ELSE ch END, '' ORDER BY minx, glyph_id)) AS text, min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy FROM w2 GROUP BY ALL)
SELECT * FROM j WHERE text <> ''""",
)
def src_loose_glyph_lines(spark, sf):
    return glyphs.loose_lines(view(spark, sf, "v_loose"))


POINTS = ctes("v_points")
_EPS = 240


@query(
    "cluster_gap",
    POINTS
    + f", g AS (SELECT *, minute - lag(minute) OVER w AS gap FROM v_points WINDOW w AS (PARTITION BY user_id ORDER BY minute, event_id))"
    f" SELECT user_id, event_id, minute, CAST(sum(CASE WHEN gap > {_EPS} THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY minute, event_id) AS BIGINT) AS cluster_id FROM g",
)
def cluster_gap(spark, sf):
    points = view(spark, sf, "v_points").select("user_id", "event_id", "minute")
    return clusters.cluster_gap(points, ["user_id"], "minute", ["event_id"], _EPS)


@query(
    "cluster_equal",
    POINTS
    + ", g AS (SELECT *, event_type IS NOT DISTINCT FROM lag(event_type) OVER w AS same, row_number() OVER w AS rn FROM v_points WINDOW w AS (PARTITION BY user_id ORDER BY minute, event_id))"
    " SELECT user_id, event_id, event_type, CAST(sum(CASE WHEN same OR rn = 1 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY minute, event_id) AS BIGINT) AS cluster_id FROM g",
)
def cluster_equal(spark, sf):
    points = view(spark, sf, "v_points").select("user_id", "event_id", "minute", "event_type")
    return clusters.cluster_equal(points, ["user_id"], "event_type", ["minute", "event_id"]).drop("minute")


@query(
    "merge_adjacent",
    POINTS
    + ", g AS (SELECT *, (value >= lag(value) OVER w AND minute - lag(minute) OVER w < 600) AS joined, row_number() OVER w AS rn FROM v_points WINDOW w AS (PARTITION BY user_id ORDER BY minute, event_id))"
    " SELECT user_id, event_id, CAST(sum(CASE WHEN joined OR rn = 1 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY minute, event_id) AS BIGINT) AS cluster_id FROM g",
)
def merge_adjacent(spark, sf):
    points = view(spark, sf, "v_points").select("user_id", "event_id", "minute", "value")
    rising = lambda prev: (F.col("value") >= prev["value"]) & (F.col("minute") - prev["minute"] < 600)
    carried = {"value": F.col("value"), "minute": F.col("minute")}
    return clusters.merge_adjacent(points, ["user_id"], ["minute", "event_id"], carried, rising).drop("minute", "value")


@query(
    "cluster_anchor",
    POINTS.replace("WITH ", "WITH RECURSIVE ", 1)
    + f""", o AS (SELECT user_id, event_id, minute, row_number() OVER (PARTITION BY user_id ORDER BY minute, event_id) AS rn FROM v_points),
walk AS (SELECT user_id, event_id, minute, rn, minute AS anchor, CAST(0 AS BIGINT) AS cluster_id FROM o WHERE rn = 1
 UNION ALL SELECT o.user_id, o.event_id, o.minute, o.rn, CASE WHEN o.minute - w.anchor > {_EPS} THEN o.minute ELSE w.anchor END, CASE WHEN o.minute - w.anchor > {_EPS} THEN w.cluster_id + 1 ELSE w.cluster_id END
 FROM walk w JOIN o ON o.user_id = w.user_id AND o.rn = w.rn + 1)
SELECT user_id, event_id, minute, cluster_id FROM walk""",
)
def cluster_anchor(spark, sf):
    points = view(spark, sf, "v_points").select("user_id", "event_id", "minute")
    return clusters.cluster_anchor(points, ["user_id"], "minute", _EPS)


_FIND = """SELECT doc_id, 1 AS page, CAST(doc_id % 7 AS INT) AS find_id,
 CASE WHEN doc_id % 5 <> 0 THEN 100e0 END AS q_minx, CASE WHEN doc_id % 5 <> 0 THEN 100e0 + 10 * (doc_id % 9) END AS q_miny,
 CASE WHEN doc_id % 5 <> 0 THEN 260e0 + doc_id % 50 END AS q_maxx, CASE WHEN doc_id % 5 <> 0 THEN 300e0 - doc_id % 60 END AS q_maxy FROM {v_cfg}"""


def _find_sql(inside: str, order: str, value: str) -> str:
    return (
        ctes("v_cfg", "v_fragment")
        + f", q AS ({_FIND.replace('{v_cfg}', 'v_cfg')}) SELECT q.doc_id, CAST(q.page AS INT) AS page, q.find_id, CAST(row_number() OVER (PARTITION BY q.doc_id, q.page, q.find_id ORDER BY {order}, f.frag_id) - 1 AS INT) AS match_no, f.frag_id, {value}"
        f" FROM q JOIN v_fragment f ON f.doc_id = q.doc_id AND f.page = q.page AND (q_minx IS NULL OR ({inside})) AND regexp_matches(f.text, '([0-9]+)')"
    )


def _found(spark, sf, **options):
    requests = spark.sql(_FIND, v_cfg=view(spark, sf, "v_cfg"))
    return find.find(requests, view(spark, sf, "v_fragment"), pattern="([0-9]+)", **options)


@query("find_inside", _find_sql("q_minx <= f.minx AND f.maxx <= q_maxx AND q_miny <= f.miny AND f.maxy <= q_maxy", "-f.minx", "regexp_extract(f.text, '([0-9]+)', 1) AS value"))
def find_inside(spark, sf):
    """All numbers in a box of each page, or on all of it, from the right."""
    return _found(spark, sf, ret="match", sort="left")


@query("find_touching", _find_sql("greatest(q_minx, f.minx) < least(q_maxx, f.maxx) AND greatest(q_miny, f.miny) < least(q_maxy, f.maxy)", "0", "f.text AS value, f.minx, f.miny, f.maxx, f.maxy"))
def find_touching(spark, sf):
    """All texts with a number that touch a box, in their order on the page, with their boxes."""
    return _found(spark, sf, ret="textline", how="intersects")
