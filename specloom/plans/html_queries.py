"""Queries over HTML tables and pre-extracted table JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from specloom.operators import html as H
from specloom.operators import table_json
from specloom.plans.registry import query
from specloom.plans.views import SHEET_COLUMNS, ctes, view
from specloom.sources import html as source
from specloom.sources import nested

_TAGLESS = "trim(replace(replace(replace(regexp_replace({0}, '<[^>]*>', '', 'g'), '&#8211;', '–'), '&deg;', '°'), '&amp;', '&'))"
CELLS = (
    ctes("v_html")
    + f""",
tbl AS (SELECT page_id, unnest(t) AS body, unnest(range(0, len(t))) AS table_idx FROM (SELECT page_id, regexp_extract_all(html, '(?is)<table[^>]*>(.*?)</table>', 1) AS t FROM v_html)),
tr AS (SELECT page_id, table_idx, unnest(r) AS body, unnest(range(0, len(r))) AS row_idx FROM (SELECT page_id, table_idx, regexp_extract_all(body, '(?is)<tr[^>]*>(.*?)</tr>', 1) AS r FROM tbl)),
td AS (SELECT page_id, table_idx, row_idx, unnest(a) AS attrs, unnest(b) AS body, unnest(range(0, len(a))) AS cell_idx FROM
  (SELECT page_id, table_idx, row_idx, regexp_extract_all(body, '(?is)<td([^>]*)>(.*?)</td>', 1) AS a, regexp_extract_all(body, '(?is)<td([^>]*)>(.*?)</td>', 2) AS b FROM tr)),
cell AS (SELECT page_id, CAST(table_idx AS INT) AS table_idx, CAST(row_idx AS INT) AS row_idx, CAST(cell_idx AS INT) AS cell_idx, {_TAGLESS.format('body')} AS text,
  coalesce(TRY_CAST(nullif(regexp_extract(attrs, '(?i)colspan=["'']?([0-9]+)', 1), '') AS INT), 1) AS colspan FROM td)"""
)


@query("src_html_tables", CELLS + " SELECT * FROM cell")
def src_html_tables(spark, sf):
    return source.table_cells(view(spark, sf, "v_html"))


@query("chain_tables", CELLS + " SELECT page_id, table_idx, row_idx, CAST(row_number() OVER (PARTITION BY page_id ORDER BY table_idx, row_idx) - 1 AS INT) AS seq FROM (SELECT DISTINCT page_id, table_idx, row_idx FROM cell WHERE table_idx > 0 OR row_idx > 0)")
def chain_tables(spark, sf):
    rows = source.table_rows(view(spark, sf, "v_html"))
    return H.chain_tables(rows).select("page_id", "table_idx", "row_idx", "seq")


@query(
    "html_columnize",
    CELLS
    + """,
seqd AS (SELECT *, dense_rank() OVER (PARTITION BY page_id ORDER BY table_idx, row_idx) - 1 AS seq FROM cell),
model AS (SELECT page_id, cell_idx - 1 AS col_idx, text AS model FROM seqd WHERE seq = 0 AND cell_idx > 0),
n AS (SELECT page_id, count(*) AS n FROM model GROUP BY 1),
line AS (SELECT page_id, seq, count(*) AS n_cells, sum(colspan) AS total, min_by(text, cell_idx) AS property FROM seqd WHERE seq > 0 GROUP BY 1, 2),
sect AS (SELECT *, coalesce(last_value(CASE WHEN n_cells = 1 THEN property END IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY seq), 'none') AS section FROM line),
wide AS (SELECT s.page_id, s.seq, s.section, s.property, m.col_idx, c.text AS value FROM sect s JOIN seqd c ON c.page_id = s.page_id AND c.seq = s.seq AND c.cell_idx = 1
   JOIN model m ON m.page_id = s.page_id WHERE s.n_cells = 2 AND s.total = 2),
start AS (SELECT *, sum(colspan) OVER (PARTITION BY page_id, seq ORDER BY cell_idx) - colspan AS col_from FROM seqd WHERE cell_idx > 0),
spread AS (SELECT s.page_id, s.seq, s.section, s.property, m.col_idx, c.text AS value FROM sect s JOIN n USING (page_id) JOIN start c ON c.page_id = s.page_id AND c.seq = s.seq
   JOIN model m ON m.page_id = s.page_id AND m.col_idx >= c.col_from AND m.col_idx < c.col_from + c.colspan WHERE s.n_cells > 1 AND s.total <> 2 AND s.total = n.n + 1),
every AS (SELECT * FROM wide UNION ALL SELECT * FROM spread)
SELECT e.page_id, CAST(e.col_idx AS INT) AS col_idx, m.model, section, property, max_by(value, seq) AS value FROM every e JOIN model m ON m.page_id = e.page_id AND m.col_idx = e.col_idx GROUP BY ALL""",
)
def html_columnize(spark, sf):
    return H.columnize(source.table_rows(view(spark, sf, "v_html")))


SPEC = {"pv": {"power": {"row_h": "Max. DC Power", "cell": "([0-9]+) W"}, "range": {"row_h": "MPPT Range"}}, "weight": {"row_h": "Weight", "cell": "([0-9.]+) kg"}, "none": {"row_h": "Nothing"}}


def raw_tables(spark, sf):
    """Nested block/line/cell arrays per sheet; the second block repeats the MPPT row of odd sheets."""
    cells = view(spark, sf, "v_spec_cell")
    values = [F.max(F.when(F.col("col_idx") == i, F.col("value"))).alias(f"c{i}") for i in range(SHEET_COLUMNS)]
    lines = cells.groupBy("sheet_id", "row_idx", "property").agg(*values)
    texts = F.transform(F.array("property", *[f"c{i}" for i in range(SHEET_COLUMNS)]), lambda t: F.struct(t.alias("text")))
    # nine lines per sheet: a fixed record, not an open group
    packed = lines.groupBy("sheet_id").agg(F.array_sort(F.collect_list(F.struct("row_idx", texts.alias("line")))).alias("ls"))
    first = F.struct(F.transform("ls", lambda r: r["line"]).alias("data"))
    again = F.filter("ls", lambda r: (r["row_idx"] == 2) & (F.col("sheet_id") % 2 == 1))
    changed = F.transform(again, lambda r: F.transform(r["line"], lambda c, i: F.struct(F.when(i > 1, F.concat(c["text"], F.lit("!"))).otherwise(c["text"]).alias("text"))))
    return packed.select(F.col("sheet_id").alias("doc_id"), F.lit("main").alias("specset"), F.array(first, F.struct(changed.alias("data"))).alias("blocks"))


_SPEC_ROWS = ", ".join(f"('{p}', '{h}', '{c}')" for p, h, c in table_json.flatten_spec(SPEC))


@query(
    "table_json_match",
    ctes("v_spec_cell")
    + f""", spec(prefix, row_h, cell_re) AS (VALUES {_SPEC_ROWS}),
doc AS (SELECT DISTINCT sheet_id FROM v_spec_cell),
val AS (SELECT sheet_id, property, col_idx, CASE WHEN row_idx = 2 AND sheet_id % 2 = 1 AND col_idx > 0 THEN concat(value, '!') ELSE value END AS value FROM v_spec_cell)
SELECT d.sheet_id AS doc_id, s.prefix, coalesce((SELECT string_agg(regexp_extract(v.value, concat('^(?:', s.cell_re, ')'), 1), '|' ORDER BY v.col_idx) FROM val v
  WHERE v.sheet_id = d.sheet_id AND v.property = s.row_h AND regexp_matches(v.value, concat('^(?:', s.cell_re, ')'))), '') AS vals FROM doc d, spec s""",
)
def table_json_match(spark, sf):
    found = table_json.match_tables(raw_tables(spark, sf), table_json.spec_table(spark, {"main": SPEC}))
    return found.withColumn("vals", F.array_join("vals", "|"))


_PIECE = "concat('<tr><td>', p_name, '</td><td><TABLE><tr><td>', p_brand, '<td colspan=\"2\">', p_size, '</td></tr></TABLE></td></tr>')"
_NESTED = "SELECT sheet_id AS page_id, concat('<html><table>', " + ", ".join(f"coalesce(max(CASE WHEN col_idx = {i} THEN {_PIECE} END), '')" for i in range(SHEET_COLUMNS)) + ", '</table></html>') AS html FROM {v_part} GROUP BY sheet_id"


@query(
    "html_nested",
    ctes("v_part")
    + """, p AS (SELECT sheet_id AS page_id, CAST(row_number() OVER (PARTITION BY sheet_id ORDER BY col_idx) - 1 AS INT) AS k, p_name, p_brand, CAST(p_size AS VARCHAR) AS size FROM v_part),
cell AS (
  SELECT page_id, 0 AS table_idx, 2 * k AS row_idx, 0 AS cell_idx, p_name AS text, 1 AS colspan FROM p
  UNION ALL SELECT page_id, 0, 2 * k, 1, concat(p_brand, size), 1 FROM p
  UNION ALL SELECT page_id, 0, 2 * k, 2, p_brand, 1 FROM p UNION ALL SELECT page_id, 0, 2 * k, 3, size, 2 FROM p
  UNION ALL SELECT page_id, 0, 2 * k + 1, 0, p_brand, 1 FROM p UNION ALL SELECT page_id, 0, 2 * k + 1, 1, size, 2 FROM p
  UNION ALL SELECT page_id, k + 1, 0, 0, p_brand, 1 FROM p UNION ALL SELECT page_id, k + 1, 0, 1, size, 2 FROM p)
SELECT * FROM cell""",
)
def html_nested(spark, sf):
    """A table whose rows hold tables: their rows and cells under every table and row around them."""
    return nested.nested_cells(spark.sql(_NESTED, v_part=view(spark, sf, "v_part")))
