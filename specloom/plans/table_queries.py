"""Queries of table reconstruction over the fragment views.

The oracle walks the same pages with plain joins and recursion where the operators use running
sums, so the closed forms are checked against the step-by-step definition.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from specloom.operators import reshape, scan
from specloom.operators import tables as T
from specloom.plans.registry import query
from specloom.plans.views import ctes, view

# ---- oracle text ------------------------------------------------------------------


def _merged(name: str, src: str, flag: str) -> str:
    """Wrapped lines of one column merged on flagged sheets."""
    return f"""
{name}_gap AS (SELECT *, miny - lag(maxy) OVER (PARTITION BY sheet_id ORDER BY midy, frag_id) AS gap FROM {src} WHERE {flag}),
{name}_low AS (SELECT sheet_id, min(gap) AS low FROM {name}_gap GROUP BY 1),
{name}_wrap AS (SELECT sheet_id, max(gap) AS wrap FROM {name}_gap JOIN {name}_low USING (sheet_id) WHERE gap - low <= 2 GROUP BY 1),
{name}_run AS (SELECT g.*, sum(CASE WHEN gap < wrap + 0.001 THEN 0 ELSE 1 END) OVER (PARTITION BY g.sheet_id ORDER BY midy, frag_id) AS run
  FROM {name}_gap g LEFT JOIN {name}_wrap w ON w.sheet_id = g.sheet_id),
{name}_one AS (SELECT sheet_id, min(frag_id) AS frag_id, string_agg(text, ' ' ORDER BY midy, frag_id) AS text, min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy
  FROM {name}_run GROUP BY sheet_id, run),
{name} AS (SELECT *, (miny + maxy) / 2 AS midy FROM (SELECT sheet_id, frag_id, text, minx, miny, maxx, maxy FROM {src} WHERE NOT {flag} UNION ALL SELECT * FROM {name}_one))"""


HEAD = (
    ctes("v_fragment", "v_cfg", "v_fixed", "v_joiner", "v_added").replace("WITH ", "WITH RECURSIVE ", 1)
    + """,
inside AS (SELECT c.sheet_id, f.frag_id, f.text, f.minx, f.miny, f.maxx, f.maxy, (f.miny + f.maxy) / 2 AS midy, (f.minx + f.maxx) / 2 AS midx, c.sections, c.multiline_row_header AS mrh,
  c.multiline_section_header AS msh, CAST(trunc(x) AS INT) AS area_minx, CAST(trunc(y) AS INT) AS area_miny, CAST(trunc(x) AS INT) + CAST(trunc(w) AS INT) AS area_maxx, CAST(trunc(y) AS INT) + CAST(trunc(h) AS INT) AS area_maxy
  FROM v_fragment f JOIN v_cfg c ON c.doc_id = f.doc_id AND c.page = f.page
  WHERE minx >= trunc(x) AND miny >= trunc(y) AND maxx <= trunc(x) + trunc(w) AND maxy <= trunc(y) + trunc(h)),
labelled AS (SELECT *, sections = 'table-center' AND abs(midx - (area_minx + area_maxx) / 2) < 2 AND NOT EXISTS (SELECT 1 FROM inside g
  WHERE g.sheet_id = i.sheet_id AND g.frag_id <> i.frag_id AND greatest(g.miny, i.miny) < least(g.maxy, i.maxy)) AS is_label FROM inside i),
m1 AS (SELECT sheet_id, min(minx) AS m1 FROM inside GROUP BY 1),
m2 AS (SELECT sheet_id, min(minx) AS m2 FROM inside JOIN m1 USING (sheet_id) WHERE minx - m1 > 5 GROUP BY 1),
roles AS (SELECT l.*, CASE WHEN is_label THEN 'section'
  WHEN sections = 'first-col' THEN CASE WHEN minx - m1 <= 5 THEN 'section' WHEN minx - m2 <= 5 THEN 'header' ELSE 'cell' END
  WHEN minx - m1 <= 5 THEN 'header' ELSE 'cell' END AS role FROM labelled l JOIN m1 USING (sheet_id) JOIN m2 USING (sheet_id)),
head_src AS (SELECT * FROM roles WHERE role = 'header'), label_src AS (SELECT * FROM roles WHERE role = 'section'),"""
    + _merged("head", "head_src", "mrh")
    + ","
    + _merged("label_line", "label_src", "msh")
    + """,
area AS (SELECT DISTINCT sheet_id, area_miny, area_maxy, sections FROM inside),
head_row AS (SELECT sheet_id, frag_id, text, midy, false AS phantom FROM head UNION ALL SELECT sheet_id, frag_id, '', midy, true FROM label_src WHERE sections = 'table-center'),
rws AS (SELECT *, CAST(row_number() OVER (PARTITION BY sheet_id ORDER BY midy, frag_id) - 1 AS INT) AS row_id FROM head_row JOIN area USING (sheet_id)),
label AS (SELECT *, CAST(row_number() OVER (PARTITION BY sheet_id ORDER BY midy, frag_id) - 1 AS INT) AS section_id FROM label_line),
body AS (SELECT sheet_id, frag_id, text, minx, miny, maxx, maxy, midy, midx FROM roles WHERE role = 'cell')"""
)

SPANS = (
    HEAD
    + """,
span AS (SELECT *, CASE WHEN row_id > 1 THEN lag(midy) OVER w ELSE area_miny END AS span_start, coalesce(lead(midy) OVER w, area_maxy) AS span_stop
  FROM rws WINDOW w AS (PARTITION BY sheet_id ORDER BY row_id)),
cand AS (SELECT b.sheet_id, b.frag_id, s.row_id FROM body b JOIN span s ON s.sheet_id = b.sheet_id AND s.span_start <= b.miny AND b.maxy <= s.span_stop),
candn AS (SELECT sheet_id, frag_id, count(*) AS n, min(row_id) AS lo, max(row_id) AS hi FROM cand GROUP BY 1, 2),
disp AS (SELECT DISTINCT sheet_id, row_id FROM cand JOIN candn USING (sheet_id, frag_id) WHERE n > 1)"""
)

BOUNDS = (
    SPANS
    + """,
num AS (SELECT sheet_id, count(*) AS n FROM rws GROUP BY 1),
free AS (SELECT r.sheet_id, r.row_id, r.midy, d.row_id IS NULL AS free FROM rws r LEFT JOIN disp d ON d.sheet_id = r.sheet_id AND d.row_id = r.row_id),
inner_bound AS (SELECT b.sheet_id, b.row_id AS i, CASE WHEN a.free AND b.free THEN (a.midy + b.midy) / 2 END AS b FROM free a JOIN free b ON b.sheet_id = a.sheet_id AND b.row_id = a.row_id + 1),
bd AS (SELECT * FROM inner_bound
  UNION ALL SELECT f.sheet_id, 0, 2 * f.midy - b.b FROM free f LEFT JOIN inner_bound b ON b.sheet_id = f.sheet_id AND b.i = 1 WHERE f.row_id = 0
  UNION ALL SELECT f.sheet_id, num.n, 2 * f.midy - b.b FROM free f JOIN num ON num.sheet_id = f.sheet_id AND f.row_id = num.n - 1 LEFT JOIN inner_bound b ON b.sheet_id = f.sheet_id AND b.i = num.n - 1),
fwd AS (SELECT sheet_id, CAST(0 AS BIGINT) AS i, b FROM bd WHERE i = 0
  UNION ALL SELECT d.sheet_id, d.i, coalesce(d.b, 2 * f.midy - w.b) FROM fwd w JOIN bd d ON d.sheet_id = w.sheet_id AND d.i = w.i + 1 JOIN free f ON f.sheet_id = w.sheet_id AND f.row_id = w.i),
rev AS (SELECT d.sheet_id, CAST(d.i AS BIGINT) AS i, d.b FROM bd d JOIN num ON num.sheet_id = d.sheet_id AND d.i = num.n
  UNION ALL SELECT d.sheet_id, d.i, coalesce(d.b, 2 * f.midy - w.b) FROM rev w JOIN bd d ON d.sheet_id = w.sheet_id AND d.i = w.i - 1 JOIN free f ON f.sheet_id = w.sheet_id AND f.row_id = d.i),
bounds AS (SELECT d.sheet_id, d.i, coalesce(d.b, CASE WHEN f.b IS NULL THEN r.b WHEN r.b IS NULL THEN f.b WHEN abs(f.b - r.b) < 3 THEN (f.b + r.b) / 2 END) AS b
  FROM bd d JOIN fwd f ON f.sheet_id = d.sheet_id AND f.i = d.i JOIN rev r ON r.sheet_id = d.sheet_id AND r.i = d.i)"""
)

ASSIGNED = (
    BOUNDS
    + """,
settled AS (SELECT b.sheet_id, b.frag_id, min(p.i) AS row_id FROM body b JOIN candn c ON c.sheet_id = b.sheet_id AND c.frag_id = b.frag_id AND c.n > 1
  JOIN bounds p ON p.sheet_id = b.sheet_id JOIN bounds q ON q.sheet_id = b.sheet_id AND q.i = p.i + 1 AND p.b <> 0 AND q.b <> 0 AND p.b <= b.miny AND b.maxy <= q.b GROUP BY 1, 2),
accepted AS (SELECT s.sheet_id, s.frag_id, s.row_id FROM settled s JOIN cand c ON c.sheet_id = s.sheet_id AND c.frag_id = s.frag_id AND c.row_id = s.row_id),
assigned AS (SELECT b.*, CAST(CASE WHEN c.n = 1 THEN c.lo ELSE a.row_id END AS INT) AS row_id FROM body b LEFT JOIN candn c ON c.sheet_id = b.sheet_id AND c.frag_id = b.frag_id
  LEFT JOIN accepted a ON a.sheet_id = b.sheet_id AND a.frag_id = b.frag_id),
placed AS (SELECT * FROM assigned WHERE row_id IS NOT NULL)"""
)


def _clustered(name: str, src: str) -> str:
    return f"""
{name}_lag AS (SELECT *, lag(midx) OVER (PARTITION BY sheet_id, row_id ORDER BY midx, frag_id) AS pm FROM {src}),
{name} AS (SELECT * EXCLUDE (pm), CAST(sum(CASE WHEN abs(midx - pm) > 5 THEN 1 ELSE 0 END) OVER (PARTITION BY sheet_id, row_id ORDER BY midx, frag_id) AS INT) AS cluster_id FROM {name}_lag),
{name}_centre AS (SELECT sheet_id, row_id, cluster_id, (min(midx) + max(midx)) / 2 AS centre FROM {name} GROUP BY 1, 2, 3)"""


CLUSTERED = (
    ASSIGNED
    + ","
    + _clustered("early", "placed")
    + """,
hc AS (SELECT sheet_id, cluster_id AS k, centre FROM early_centre WHERE row_id = 0),
ncol AS (SELECT sheet_id, count(*) AS n, min(centre) AS c0 FROM hc GROUP BY 1),
kept AS (SELECT p.* FROM placed p JOIN ncol USING (sheet_id) WHERE midx >= c0 - 5),"""
    + _clustered("clu", "kept")
)

SPANNED = (
    CLUSTERED
    + """,
nk AS (SELECT sheet_id, row_id, count(*) AS nk FROM clu_centre GROUP BY 1, 2),
fix_one AS (SELECT f.sheet_id, f.fix_id, min(r.row_id) AS row_id, any_value(spans) AS spans FROM v_fixed f JOIN rws r ON r.sheet_id = f.sheet_id AND contains(r.text, f.row_text) GROUP BY f.sheet_id, f.fix_id HAVING count(*) = 1),
fix AS (SELECT sheet_id, row_id, arg_max(spans, fix_id) AS spans FROM fix_one GROUP BY sheet_id, row_id),
half AS (SELECT sheet_id, 2 * k AS m, centre - 5 AS lo, centre + 5 AS hi FROM hc UNION ALL SELECT a.sheet_id, 2 * a.k + 1, a.centre + 5, b.centre - 5 FROM hc a JOIN hc b ON b.sheet_id = a.sheet_id AND b.k = a.k + 1),
walk AS (SELECT nk.sheet_id, nk.row_id, -1 AS k, 0 AS col_from, 0 AS next_col FROM nk JOIN ncol USING (sheet_id) LEFT JOIN fix USING (sheet_id, row_id) WHERE spans IS NULL AND nk.nk <> ncol.n AND nk.nk > 1
  UNION ALL SELECT w.sheet_id, w.row_id, c.cluster_id, w.next_col, h.m - w.next_col + 1 FROM walk w JOIN clu_centre c ON c.sheet_id = w.sheet_id AND c.row_id = w.row_id AND c.cluster_id = w.k + 1
  JOIN half h ON h.sheet_id = w.sheet_id AND h.m >= 2 * w.next_col AND c.centre BETWEEN h.lo AND h.hi
  QUALIFY row_number() OVER (PARTITION BY w.sheet_id, w.row_id ORDER BY h.m) = 1),
good AS (SELECT w.sheet_id, w.row_id FROM walk w JOIN nk ON nk.sheet_id = w.sheet_id AND nk.row_id = w.row_id AND w.k = nk.nk - 1 JOIN ncol ON ncol.sheet_id = w.sheet_id AND ncol.n = w.next_col),
ranges AS (SELECT sheet_id, row_id, k AS cluster_id, col_from, next_col AS col_to FROM walk JOIN good USING (sheet_id, row_id) WHERE k >= 0
  UNION ALL SELECT c.sheet_id, c.row_id, c.cluster_id, CASE WHEN nk = n THEN c.cluster_id ELSE 0 END, CASE WHEN nk = n THEN c.cluster_id + 1 ELSE n END FROM clu_centre c JOIN nk USING (sheet_id, row_id) JOIN ncol USING (sheet_id)
    LEFT JOIN fix USING (sheet_id, row_id) WHERE spans IS NULL AND (nk = n OR nk = 1)
  UNION ALL SELECT c.sheet_id, c.row_id, c.cluster_id, list_sum(spans[1:c.cluster_id + 1]) - spans[c.cluster_id + 1], list_sum(spans[1:c.cluster_id + 1]) FROM clu_centre c JOIN nk USING (sheet_id, row_id) JOIN fix USING (sheet_id, row_id) WHERE len(spans) = nk)"""
)

SHEETS = (
    SPANNED
    + """,
sep AS (SELECT r.sheet_id, r.row_id, j.seq FROM rws r JOIN v_joiner j ON j.sheet_id = r.sheet_id AND j.row_text = r.text),
joined_cell AS (SELECT c.sheet_id, c.row_id, c.cluster_id, min(c.frag_id) AS frag_id, CASE WHEN any_value(s.seq) IS NULL THEN string_agg(c.text, ' ' ORDER BY c.midy, c.frag_id) ELSE string_agg(c.text, '' ORDER BY c.midy, c.frag_id) END AS value,
  (min(c.miny) + max(c.maxy)) / 2 AS midy FROM clu c LEFT JOIN sep s ON s.sheet_id = c.sheet_id AND s.row_id = c.row_id GROUP BY 1, 2, 3),
used AS (SELECT DISTINCT sheet_id, row_id FROM placed),
by_line AS (SELECT r.sheet_id, r.row_id, last_value(CASE WHEN u.row_id IS NULL THEN r.text END IGNORE NULLS) OVER (PARTITION BY r.sheet_id ORDER BY r.row_id) AS section FROM rws r LEFT JOIN used u ON u.sheet_id = r.sheet_id AND u.row_id = r.row_id),
sid AS (SELECT sheet_id, -1 AS row_id, CAST(0 AS BIGINT) AS s FROM area
  UNION ALL SELECT r.sheet_id, r.row_id, CASE WHEN l.midy IS NOT NULL AND r.midy >= l.midy - 2 THEN s.s + 1 ELSE s.s END FROM sid s JOIN rws r ON r.sheet_id = s.sheet_id AND r.row_id = s.row_id + 1
  LEFT JOIN label l ON l.sheet_id = r.sheet_id AND l.section_id = s.s),
named AS (SELECT r.sheet_id, r.row_id, r.text AS property, CASE r.sections WHEN 'empty-line' THEN b.section WHEN 'none' THEN NULL ELSE l.text END AS section FROM rws r JOIN by_line b ON b.sheet_id = r.sheet_id AND b.row_id = r.row_id
  JOIN sid s ON s.sheet_id = r.sheet_id AND s.row_id = r.row_id LEFT JOIN label l ON l.sheet_id = r.sheet_id AND l.section_id = s.s - 1),
cells AS (SELECT j.*, g.col_from, g.col_to, n.section, n.property FROM joined_cell j JOIN ranges g USING (sheet_id, row_id, cluster_id) JOIN named n USING (sheet_id, row_id)),
wide_cell AS (SELECT *, unnest(range(col_from, col_to)) AS col_idx FROM cells),
attr AS (SELECT sheet_id, col_idx, section, property, string_agg(value, ' ' ORDER BY midy, frag_id) AS value, min(midy * 100000 + frag_id) AS first_at FROM wide_cell GROUP BY 1, 2, 3, 4),
sect_at AS (SELECT *, min(first_at) OVER (PARTITION BY sheet_id, col_idx, section) AS s_at FROM attr),
prop_at AS (SELECT sheet_id, section, property, min([CAST(col_idx AS DOUBLE), s_at, first_at]) AS first_at FROM sect_at GROUP BY 1, 2, 3),
prop_no AS (SELECT *, CAST(row_number() OVER (PARTITION BY sheet_id ORDER BY first_at) - 1 AS INT) AS row_idx FROM prop_at),
spec AS (SELECT a.sheet_id, p.row_idx, a.section, a.property, CAST(a.col_idx AS INT) AS col_idx, a.value FROM attr a JOIN prop_no p ON p.sheet_id = a.sheet_id AND p.section IS NOT DISTINCT FROM a.section AND p.property = a.property)"""
)

# ---- inputs -------------------------------------------------------------------------


class Pages:
    """The chain of reconstruction steps over the views."""

    def __init__(self, spark, sf):
        self.get = lambda name: view(spark, sf, name)
        self.fragments = self.get("v_fragment")
        self.config = self.get("v_cfg")
        self.hot = scan.has_hot_key(self.fragments, ["doc_id", "page"])
        self.settings = T.settings_of(self.config, self.fragments.count())

    def inside(self):
        return T.area_filter(self.fragments, self.config, self.settings.rows)

    def labelled(self):
        return T.centre_labels(T.by_sheet(self.inside(), self.hot, self.settings.fragments), hot=self.hot)

    def lined(self):
        return T.lined_frame(self.fragments, self.config, self.settings, hot=self.hot)

    def named(self):
        return T.find_rows(self.fragments, self.config, self.settings, self.get("v_fixed"), hot=self.hot)

    def spanned(self):
        return T.span_join(self.lined(), hot=self.hot)

    def bounded(self):
        return T.solve_bounds(T.mark_disputed(self.spanned(), hot=self.hot), hot=self.hot)

    def settled(self):
        return T.settle_rows(self.lined(), hot=self.hot)

    def merged(self):
        fixed = T.by_sheet(T.fixed_spans(self.lined(), self.get("v_fixed"), self.named()), self.hot, self.settings.fragments)
        named = T.name_rows(T.settle_rows(fixed, hot=self.hot), modes=self.settings.modes, hot=self.hot)
        return T.place_columns(named, self.get("v_joiner"), hot=self.hot)

    def cells(self):
        return T.sheet_cells(self.fragments, self.config, fixed=self.get("v_fixed"), joiners=self.get("v_joiner"), hot=self.hot, rows=self.settings.fragments)


# ---- queries ------------------------------------------------------------------------


@query("area_filter", HEAD + " SELECT sheet_id, frag_id, text, minx, miny, maxx, maxy FROM inside")
def area_filter(spark, sf):
    return Pages(spark, sf).inside().select("sheet_id", "frag_id", "text", *T.BOX)


@query("section_by_center", HEAD + " SELECT sheet_id, frag_id, text FROM labelled WHERE is_label")
def section_by_center(spark, sf):
    return Pages(spark, sf).labelled().filter("is_label").select("sheet_id", "frag_id", "text")


@query("header_column", HEAD + " SELECT sheet_id, row_id, text, midy, phantom FROM rws")
def header_column(spark, sf):
    rows = Pages(spark, sf).lined().filter("kind = 'row'")
    return rows.select("sheet_id", F.col("line_no").alias("row_id"), "text", "midy", "phantom")


@query("merge_multiline", HEAD + " SELECT sheet_id, frag_id, text, minx, miny, maxx, maxy FROM head_one")
def merge_multiline(spark, sf):
    p = Pages(spark, sf)
    kinds = T.header_column(p.labelled(), hot=p.hot)
    heads = kinds.filter("kind = 'row' and multiline_row_header").select("sheet_id", "frag_id", "text", *T.BOX)
    return T.merge_multiline(heads, hot=p.hot).select("sheet_id", "frag_id", "text", *T.BOX)


@query("neighbour_span", SPANS + " SELECT sheet_id, row_id, CAST(span_start AS DOUBLE) AS span_start, CAST(span_stop AS DOUBLE) AS span_stop FROM span")
def neighbour_span(spark, sf):
    p = Pages(spark, sf)
    spans = T.neighbour_span(p.lined(), hot=p.hot)
    return spans.select("sheet_id", F.col("line_no").alias("row_id"), "span_start", "span_stop")


@query("span_join", SPANS + " SELECT sheet_id, frag_id, CAST(n AS INT) AS n_rows, lo, hi FROM candn")
def span_join(spark, sf):
    found = Pages(spark, sf).spanned().filter("kind = 'cell' and lo <= hi")
    return found.select("sheet_id", "frag_id", (F.col("hi") - F.col("lo") + 1).alias("n_rows"), "lo", "hi")


@query("disputed_rows", SPANS + " SELECT sheet_id, row_id FROM disp")
def disputed_rows(spark, sf):
    p = Pages(spark, sf)
    marked = T.mark_disputed(p.spanned(), hot=p.hot).filter("disputed")
    return marked.select("sheet_id", F.col("line_no").alias("row_id"))


@query(
    "solve_bounds",
    BOUNDS + " SELECT a.sheet_id, CAST(a.i AS INT) AS row_id, round(a.b, 6) AS bound, round(b.b, 6) AS bound_stop FROM bounds a JOIN bounds b ON b.sheet_id = a.sheet_id AND b.i = a.i + 1",
)
def solve_bounds(spark, sf):
    rows = Pages(spark, sf).bounded().filter("kind = 'row'")
    return rows.select("sheet_id", F.col("line_no").alias("row_id"), F.round("bound", 6).alias("bound"), F.round("bound_stop", 6).alias("bound_stop"))


@query("bound_join", ASSIGNED + " SELECT sheet_id, frag_id, CAST(row_id AS INT) AS row_id FROM accepted")
def bound_join(spark, sf):
    p = Pages(spark, sf)
    settled = T.bound_join(p.bounded(), hot=p.hot).filter("settled is not null")
    return settled.select("sheet_id", "frag_id", F.col("settled").alias("row_id"))


@query("assign_rows", ASSIGNED + " SELECT sheet_id, frag_id, text, row_id FROM assigned")
def assign_rows(spark, sf):
    return Pages(spark, sf).settled().filter("kind = 'cell'").select("sheet_id", "frag_id", "text", "row_id")


@query("row_clusters", CLUSTERED + " SELECT sheet_id, row_id, CAST(cluster_id AS INT) AS cluster_id, frag_id, midx FROM early")
def row_clusters(spark, sf):
    p = Pages(spark, sf)
    placed = p.settled().filter("kind = 'cell' and row_id is not null")
    return T.row_clusters(placed, hot=p.hot).select("sheet_id", "row_id", F.col("cluster_id").cast("int"), "frag_id", "midx")


@query("drop_early_cells", CLUSTERED + " SELECT sheet_id, frag_id, row_id FROM kept")
def drop_early_cells(spark, sf):
    p = Pages(spark, sf)
    clustered = T.row_clusters(p.settled().filter("kind = 'cell' and row_id is not null"), hot=p.hot)
    return T.drop_early_cells(T.header_centres(clustered, hot=p.hot)).select("sheet_id", "frag_id", "row_id")


@query("resolve_colspans", SPANNED + " SELECT sheet_id, row_id, centre, CAST(col_from AS INT) AS col_from, CAST(col_to AS INT) AS col_to FROM ranges JOIN clu_centre USING (sheet_id, row_id, cluster_id)")
def resolve_colspans(spark, sf):
    p = Pages(spark, sf)
    ranges = T.resolve_colspans(p.merged())
    return ranges.select("sheet_id", "row_id", "centre", "col_from", "col_to")


@query(
    "quarantine_spans",
    SPANNED + " SELECT nk.sheet_id, nk.row_id, CASE WHEN spans IS NULL THEN 'cells do not fit the columns' ELSE 'fixed spans do not fit the cells' END AS reason"
    " FROM nk LEFT JOIN fix USING (sheet_id, row_id) ANTI JOIN ranges r ON r.sheet_id = nk.sheet_id AND r.row_id = nk.row_id",
)
def quarantine_spans(spark, sf):
    return T.uneven_rows(Pages(spark, sf).merged())


@query("quarantine_fixes", HEAD + """ SELECT f.sheet_id, f.fix_id, f.row_text, CASE WHEN count(r.row_id) = 0 THEN 'unknown name' ELSE 'ambiguous name' END AS reason
 FROM v_fixed f LEFT JOIN rws r ON r.sheet_id = f.sheet_id AND contains(r.text, f.row_text) GROUP BY ALL HAVING count(r.row_id) <> 1""")
def quarantine_fixes(spark, sf):
    p = Pages(spark, sf)
    return T.unresolved_fixes(p.get("v_fixed"), p.named()).select("sheet_id", "fix_id", "row_text", "reason")


@query("merge_fragments", SHEETS + " SELECT sheet_id, row_id, frag_id, value, midy FROM joined_cell")
def merge_fragments(spark, sf):
    merged = Pages(spark, sf).merged()
    return merged.select("sheet_id", "row_id", "frag_id", F.col("text").alias("value"), T.midy().alias("midy"))


_SECTION = " SELECT n.sheet_id, n.row_id, n.section FROM named n JOIN area a ON a.sheet_id = n.sheet_id WHERE a.sections {}"


@query("section_by_first_col", SHEETS + _SECTION.format("IN ('first-col', 'table-center')"))
def section_by_first_col(spark, sf):
    p = Pages(spark, sf)
    rows = T.sections_by_column(p.lined(), hot=p.hot).filter("kind = 'row' and sections in ('first-col', 'table-center')")
    return rows.select("sheet_id", F.col("line_no").alias("row_id"), F.col("label").alias("section"))


@query("section_by_empty_line", SHEETS + _SECTION.format("= 'empty-line'"))
def section_by_empty_line(spark, sf):
    p = Pages(spark, sf)
    rows = T.sections_by_empty_line(p.settled(), hot=p.hot).filter("kind = 'row' and sections = 'empty-line'")
    return rows.select("sheet_id", F.col("line_no").alias("row_id"), F.col("line_label").alias("section"))


@query("certain_cells", SHEETS + " SELECT sheet_id, row_id, section, property, CAST(col_from AS INT) AS col_from, CAST(col_to AS INT) AS col_to, value FROM cells")
def certain_cells(spark, sf):
    return Pages(spark, sf).cells().select("sheet_id", "row_id", "section", "property", "col_from", "col_to", "value")


@query("colspan_expand", SHEETS + " SELECT sheet_id, row_id, CAST(col_idx AS INT) AS col_idx, value FROM wide_cell")
def colspan_expand(spark, sf):
    return reshape.expand_columns(Pages(spark, sf).cells()).select("sheet_id", "row_id", "col_idx", "value")


@query("spec_sheets", SHEETS + " SELECT sheet_id, row_idx, section, property, col_idx, value FROM spec")
def spec_sheets(spark, sf):
    """Fragments to long sheet cells: the whole extraction stage."""
    p = Pages(spark, sf)
    return T.spec_cells(p.cells(), hot=p.hot, rows=p.settings.fragments)


@query(
    "add_cell",
    HEAD
    + """, wanted AS (SELECT sheet_id, row_text AS name FROM v_added UNION SELECT sheet_id, col_text FROM v_added),
hit AS (SELECT w.sheet_id, w.name, i.* EXCLUDE (sheet_id), i.text = w.name AS exact FROM wanted w JOIN inside i ON i.sheet_id = w.sheet_id AND contains(i.text, w.name)),
pick AS (SELECT h.* FROM hit h JOIN (SELECT sheet_id, name, count(*) FILTER (exact) AS e, count(*) AS a FROM hit GROUP BY 1, 2) c ON c.sheet_id = h.sheet_id AND c.name = h.name WHERE (e = 1 AND h.exact) OR (e <> 1 AND a = 1))
SELECT v.sheet_id, CAST(-1 - v.fix_id AS INT) AS frag_id, v.text, c.minx, r.miny, c.maxx, r.maxy FROM v_added v JOIN pick r ON r.sheet_id = v.sheet_id AND r.name = v.row_text JOIN pick c ON c.sheet_id = v.sheet_id AND c.name = v.col_text""",
)
def add_cell(spark, sf):
    p = Pages(spark, sf)
    return T.add_cell(p.inside(), p.get("v_added"))[0]
