"""Input views over the given tables.

A view is one SELECT text that Spark and DuckDB both read. Spark resolves `{name}` through
`spark.sql(..., name=df)`; the oracle turns the same views into CTEs. Nothing is collected and no
row is left out: every view grows with its table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# A sheet is four parts side by side; each part is a model column with nine property rows.
SHEET_COLUMNS = 4
# slot: vertical place of the row on the page (a free slot above it holds the section label).
SHEET_ROWS = [
    # row_idx, slot, section, property, value
    (0, 0, "''", "'Model'", "CASE WHEN sheet_id % 5 = 2 THEN concat('TWIN/', sheet_id) WHEN p_partkey % 13 = 5 THEN concat('.', replace(p_name, ' ', '/'), '-', p_partkey) ELSE concat(replace(p_name, ' ', '/'), '-', p_partkey) END"),
    (1, 2, "'PV Input'", "'Max. DC Power'", "CASE WHEN p_partkey % 19 = 4 THEN 'n/a W' ELSE concat(p_size * 100, ' W') END"),
    (2, 3, "'PV Input'", "CASE WHEN sheet_id % 7 = 3 THEN 'MPPT Voltage Range' ELSE 'MPPT Range' END", "concat(100 + p_size, '-', 400 + p_size, ' V')"),
    (3, 4, "'PV Input'", "'Input Current'", "concat(p_size, '+', p_size + 1, '.5')"),
    (4, 6, "'Battery'", "'Charge Current'", "concat('Max ', p_size, '.5 A')"),
    (5, 7, "'Battery'", "CASE WHEN sheet_id % 11 = 5 THEN 'Charge Current (alt)' ELSE 'Cooling' END", "'Fan'"),
    (6, 9, "'General'", "'Weight'", "CASE WHEN sheet_id % 9 = 1 AND col_idx % 2 = 1 THEN concat('approx ', p_size) ELSE concat(10 + p_size, '.25 kg') END"),
    (7, 10, "'General'", "'Noise (dB)'", "CASE WHEN p_partkey % 6 = 0 THEN 'n/a' ELSE concat(30 + p_size % 20) END"),
    (8, 11, "'General'", "'Dimensions'", "concat('300x', 400 + p_size, 'x150')"),
]


def _by_row(field: int) -> str:
    return "CASE row_idx " + " ".join(f"WHEN {r[0]} THEN {r[field]}" for r in SHEET_ROWS) + " END"


_CELLS = (
    f"SELECT sheet_id, row_idx, {_by_row(1)} AS slot, {_by_row(2)} AS section, {_by_row(3)} AS property, "
    f"col_idx, {_by_row(4)} AS value, p_partkey FROM {{v_part}} EACH(row_idx, 0, 8)"
)

# Page layout: a section label is printed in the free slot above the first row of its section.
LABEL_SLOT = "CASE row_idx WHEN 1 THEN 1 WHEN 4 THEN 5 WHEN 6 THEN 8 END"

# Which cells break the plain grid, and how.
_WRAPPED_HEAD = "sheet_id % 9 = 2 AND row_idx = 8"
_OVER_TWO = "sheet_id % 3 = 0 AND row_idx = 4"
_OVER_ALL = "sheet_id % 4 = 1 AND row_idx = 5"
_OVER_THREE = "sheet_id % 6 = 4 AND row_idx = 8"
_OFF_GRID = "sheet_id % 8 = 3 AND row_idx = 7"
_BETWEEN = "sheet_id % 10 = 7 AND row_idx = 6 AND col_idx = 2"
_WRAPPED = "p_partkey % 6 = 0 AND row_idx = 3"
_HAS_LABEL = "row_idx IN (1, 4, 6) AND sheet_id % 5 <> 2"

# Everything that does not depend on the kind of fragment, worked out once per cell.
_CELL_LAYOUT = f"""
SELECT sheet_id, row_idx, col_idx, slot, property, value, {_WRAPPED_HEAD} AS wrapped_head, {_WRAPPED} AS wrapped, {_BETWEEN} AS between_rows,
  NOT (({_OVER_TWO} AND col_idx % 2 = 1) OR ({_OVER_ALL} AND col_idx > 0) OR ({_OVER_THREE} AND col_idx % 2 = 0) OR ({_OFF_GRID} AND col_idx IN (0, 3))) AS shown,
  40.0 + sheet_id % 3 + 2.0 * (row_idx % 2) AS head_x,
  CASE WHEN {_OVER_TWO} THEN 150.0 + 60.0 * col_idx WHEN {_OVER_ALL} THEN 210.0 WHEN {_OVER_THREE} OR {_BETWEEN} OR {_WRAPPED} THEN 120.0 + 60.0 * col_idx
    WHEN {_OFF_GRID} THEN 127.0 + 60.0 * col_idx ELSE 120.0 + 60.0 * col_idx + 0.5 * (p_partkey % 5) END AS cell_x,
  row_idx = 0 OR (row_idx = 2 AND sheet_id % 12 = 6) OR ({_HAS_LABEL}) AS has_extra,
  CASE WHEN row_idx = 0 THEN 25 WHEN row_idx = 2 OR sheet_id % 5 = 3 THEN slot ELSE {LABEL_SLOT} END AS extra_slot,
  CASE row_idx WHEN 0 THEN 99 WHEN 2 THEN 80 ELSE 95 END AS extra_tag,
  CASE row_idx WHEN 0 THEN concat('page ', sheet_id) WHEN 2 THEN 'note' ELSE section END AS extra_text,
  CASE WHEN row_idx = 0 THEN 40.0 WHEN row_idx = 2 THEN 95.0 WHEN sheet_id % 5 = 3 THEN 10.0 WHEN sheet_id % 5 = 4 THEN 170.0 ELSE 40.0 + sheet_id % 3 END AS extra_x0,
  CASE WHEN row_idx = 0 THEN 90.0 WHEN row_idx = 2 THEN 105.0 WHEN sheet_id % 5 = 3 THEN 30.0 WHEN sheet_id % 5 = 4 THEN 230.0 ELSE 90.0 END AS extra_x1
FROM {{v_spec_cell}}
"""

# kind: 0 and 1 lines of the row header, 2 and 3 lines of the cell, 4 label, note or footer.
_FRAGMENTS = f"""
SELECT sheet_id AS doc_id, 1 AS page, CAST(slot * 100 + tag AS INT) AS frag_id, text, x0 AS minx, 100.0 + 20.0 * slot + y0 AS miny, x1 AS maxx, 100.0 + 20.0 * slot + y1 AS maxy
FROM (
SELECT sheet_id,
  CASE WHEN kind < 4 THEN slot ELSE extra_slot END AS slot,
  CASE kind WHEN 0 THEN 90 WHEN 1 THEN 91 WHEN 2 THEN col_idx * 10 WHEN 3 THEN col_idx * 10 + 1 ELSE extra_tag END AS tag,
  CASE kind WHEN 0 THEN CASE WHEN wrapped_head THEN 'Dimen' ELSE property END WHEN 1 THEN 'sions'
    WHEN 2 THEN CASE WHEN wrapped THEN 'approx.' ELSE value END WHEN 3 THEN value ELSE extra_text END AS text,
  CASE WHEN kind < 2 THEN head_x WHEN kind = 4 THEN extra_x0 WHEN kind = 3 THEN cell_x + 1.0 ELSE cell_x END AS x0,
  CASE WHEN kind < 2 THEN 90.0 WHEN kind = 4 THEN extra_x1 WHEN kind = 3 THEN cell_x + 41.0 ELSE cell_x + 40.0 END AS x1,
  CASE WHEN kind < 2 AND wrapped_head THEN 8.0 * kind - 4.0 WHEN kind = 2 AND between_rows THEN 8.0 WHEN kind IN (2, 3) AND wrapped THEN 10.0 * kind - 26.0 ELSE 0.0 END AS y0,
  CASE WHEN kind < 2 AND wrapped_head THEN 8.0 * kind + 3.0 WHEN kind = 2 AND between_rows THEN 18.0 WHEN kind IN (2, 3) AND wrapped THEN 10.0 * kind - 18.0 ELSE 10.0 END AS y1
FROM ({_CELL_LAYOUT}) AS c EACH(kind, 0, 4)
WHERE (kind = 0 AND col_idx = 0) OR (kind = 1 AND col_idx = 0 AND wrapped_head) OR (kind = 2 AND shown) OR (kind = 3 AND wrapped) OR (kind = 4 AND col_idx = 0 AND has_extra)
) AS f
"""


def _html() -> str:
    """A page of tables per sheet: header row, section rows, spanned rows, a two-column row."""
    td = "<td>"
    agg = []
    for i in range(SHEET_COLUMNS):
        agg.append(f"max(CASE WHEN col_idx = {i} THEN value END) AS c{i}")
    rows = f"SELECT sheet_id, row_idx, section, property, {', '.join(agg)} FROM {{v_spec_cell}} GROUP BY sheet_id, row_idx, section, property"
    plain = ", ".join(f"'{td}', c{i}, '</td>'" for i in range(SHEET_COLUMNS))
    line = (
        "CASE "
        "WHEN row_idx = 4 AND sheet_id % 3 = 0 THEN concat('<TR><td>', property, '</td><td colspan=\"2\"> ', c0, '</td><td colspan=2>', c2, ' </td></TR>') "
        "WHEN row_idx = 5 THEN concat('<tr><td>', property, '</td><td>', c0, ' &amp;&#8211;&deg; ', c1, '</td></tr>') "
        "WHEN row_idx = 6 AND sheet_id % 6 = 1 THEN concat('<tr><td>', property, '</td><td>', c0, '</td><td>', c1, '</td></tr>') "
        "WHEN row_idx = 7 THEN concat('<tr><th>skip</th><td>', property, '</td>', '<td class=\"x\" colspan=\"3\"><b>', c1, '</b></td><td>', c3, '</td></tr>') "
        f"ELSE concat('<tr class=\"r\"><td>', property, '</td>', {plain}, '</tr>') END"
    )
    label = "CASE WHEN row_idx IN (1, 4, 6) THEN concat('<tr><td colspan=\"5\">', section, '</td></tr>') ELSE '' END"
    piece = f"SELECT sheet_id, row_idx, concat({label}, {line}) AS tr FROM ({rows}) AS r"
    body = []
    for i in range(len(SHEET_ROWS)):
        body.append(f"max(CASE WHEN row_idx = {i} THEN tr END)")
    repeat = "CASE WHEN max(sheet_id) % 4 = 2 THEN max(CASE WHEN row_idx = 3 THEN replace(tr, '+', ' and ') END) ELSE '' END"
    first = ", ".join(body[:4])
    second = ", ".join(body[4:])
    return (
        "SELECT sheet_id AS page_id, concat('https://example.org/spec/', sheet_id, '.html') AS url, "
        f"concat('<html><body><p>specs</p><table border=\"1\">', {first}, '</table><hr><TABLE>', {second}, {repeat}, '</TABLE></body></html>') AS html "
        f"FROM ({piece}) AS t GROUP BY sheet_id"
    )


VIEWS: dict[str, str] = {
    "v_part": (
        "SELECT CAST(floor(p_partkey / 4) AS BIGINT) AS sheet_id, CAST(p_partkey % 4 AS INT) AS col_idx, "
        "p_partkey, p_name, p_size, p_retailprice, p_brand, p_type FROM {part}"
    ),
    "v_spec_cell": _CELLS,
    "v_fragment": _FRAGMENTS,
    "v_cfg": (
        "SELECT doc_id, doc_id AS sheet_id, 1 AS page, 5.79 AS x, 90.63 AS y, 390.04 AS w, 400.49 AS h, "
        "CASE doc_id % 5 WHEN 2 THEN 'none' WHEN 3 THEN 'first-col' WHEN 4 THEN 'table-center' ELSE 'empty-line' END AS sections, "
        "doc_id % 9 = 2 AS multiline_row_header, doc_id % 2 = 1 AND doc_id % 5 = 3 AS multiline_section_header "
        "FROM (SELECT DISTINCT sheet_id AS doc_id FROM {v_part}) AS d"
    ),
    "v_fixed": "SELECT sheet_id, fix_id, CASE fix_id WHEN 0 THEN 'Noise (dB)' WHEN 1 THEN 'Noise' ELSE 'Nothing' END AS row_text, CASE WHEN fix_id = 1 THEN ARRAY_OF(1, 3) ELSE ARRAY_OF(2, 2) END AS spans FROM {v_cfg} EACH(fix_id, 0, 2) WHERE sheet_id % 16 = 3",
    "v_joiner": "SELECT sheet_id, 'Input Current' AS row_text, '' AS seq FROM {v_cfg} WHERE sheet_id % 2 = 0",
    "v_added": "SELECT sheet_id, 0 AS fix_id, 'Weight' AS row_text, 'page' AS col_text, 'never' AS text FROM {v_cfg} WHERE sheet_id % 4 = 0 "
    "UNION ALL SELECT sheet_id, 1, 'Cooling', 'Max ', 'by hand' FROM {v_cfg} WHERE sheet_id % 7 = 5 "
    "UNION ALL SELECT sheet_id, 2, 'Noise (dB)', 'note', 'quiet' FROM {v_cfg} WHERE sheet_id % 6 = 0",
    "v_html": _html(),
    "v_glyph": (
        "SELECT p_partkey AS line_id, CAST(floor(p_partkey / 4) AS BIGINT) AS doc_id, 1 AS page, seq, "
        "CASE WHEN ch = '_' THEN NULL ELSE ch END AS ch, ch <> '_' AS has_font, "
        "CAST(10.0 + 6.0 * seq AS DOUBLE) AS minx, CAST(700.0 - 0.5 * (seq % 3) AS DOUBLE) AS miny, "
        "CAST(16.0 + 6.0 * seq AS DOUBLE) AS maxx, CAST(710.0 + 0.5 * (seq % 2) AS DOUBLE) AS maxy "
        "FROM (SELECT p_partkey, pos AS seq, substring(line, pos, 1) AS ch FROM "
        "(SELECT p_partkey, concat(' ', replace(p_name, ' ', CASE WHEN p_partkey % 3 = 0 THEN '_' ELSE ' ' END), ' _', p_type, '__ ') AS line FROM {part}) AS t "
        "EACH(pos, 1, length(line))) AS g WHERE ch <> ''"
    ),
    "v_loose": (
        "SELECT doc_id, page, line_id * 1000 + seq AS glyph_id, coalesce(ch, chr(160)) AS ch, minx, "
        "miny - 15.0 * (line_id % 4) AS miny, CASE WHEN ch = 'e' THEN maxx - 6.5 ELSE maxx END AS maxx, maxy - 15.0 * (line_id % 4) AS maxy FROM {v_glyph}"
    ),
    "v_panel": (
        "SELECT p_partkey AS panel_id, CAST(p_partkey % 25 AS INT) AS request, CAST(10 * p_size AS DOUBLE) AS watts, 900 + p_size AS w, 1600 + 2 * p_size AS h, p_retailprice AS price, "
        "CASE p_partkey % 5 WHEN 0 THEN concat(900 + p_size, 'x', 1600 + 2 * p_size) "
        "WHEN 1 THEN concat(90 + p_size, '.5cmx', 160 + p_size, 'cm') "
        "WHEN 2 THEN concat(1 + p_size % 2, '.05x', 1 + p_size % 3, '.755m') "
        "WHEN 3 THEN concat(900 + p_size, 'mmx', 900 + p_size) "
        "ELSE concat(900 + p_size, 'mmx1.', 10 + p_size, 'm') END AS size_text FROM {part}"
    ),
    "v_area": (
        "SELECT s_suppkey AS area_id, s_nationkey AS request, "
        "CASE s_suppkey % 3 WHEN 0 THEN concat(3 + s_suppkey % 5, 'x', 4 + s_suppkey % 7, 'm') "
        "WHEN 1 THEN concat(300 + 10 * (s_suppkey % 11), 'cmx', 250 + s_suppkey % 13, 'cm') "
        "ELSE concat(150 + 10 * (s_suppkey % 9), 'x', 9000) END AS area_text FROM {supplier}"
    ),
    "v_artefact": (
        "SELECT concat('stem', o_custkey % 97) AS stem, concat('grp', o_custkey) AS grp, "
        "CASE o_orderstatus WHEN 'P' THEN 'download' WHEN 'F' THEN 'extract' ELSE 'map' END AS stage, "
        "concat('file', o_orderkey % 3) AS filename, "
        "CASE o_orderstatus WHEN 'P' THEN 'pdf' WHEN 'F' THEN 'csv' ELSE 'json' END AS ext, "
        "max(o_orderdate) AS mtime FROM {orders} GROUP BY 1, 2, 3, 4, 5"
    ),
    "v_job": (
        "SELECT concat('stem', c_custkey % 97) AS stem, concat('grp', c_custkey) AS grp, "
        "concat('file', c_custkey % 3) AS filename, c_nationkey, c_acctbal, c_mktsegment FROM {customer}"
    ),
    "v_points": "SELECT user_id, event_id, CAST(floor(date_part('epoch', ts) / 60) AS BIGINT) AS minute, event_type, value FROM {events}",
}

# a decimal literal is written as a double, which both engines read the same way
_DECIMAL = re.compile(r"(?<![\w.'])(\d+\.\d+)(?![\w.'])")
VIEWS = {name: _DECIMAL.sub(r"\1e0", text) for name, text in VIEWS.items()}
# views that turn one input row into many
_MULTIPLIED = ("v_part", "v_glyph")

_NAME = re.compile(r"\{(\w+)\}")
# EACH(name, first, last) repeats a row for every integer of a range.
_EACH = re.compile(r"EACH\((\w+), (\d+), (\d+|length\(\w+\))\)")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table or view as a DataFrame."""
    if name in TABLES:
        return table(spark, sf_dir, name)
    text = _spark_text(VIEWS[name])
    args = {n: view(spark, sf_dir, n) for n in dict.fromkeys(_NAME.findall(text))}
    if name in _MULTIPLIED:
        args = {n: spread(spark, n, df) for n, df in args.items()}
    return spark.sql(text, **args)


def spread(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """A table stored in fewer files than there are cores is spread before its rows multiply."""
    cores = spark.sparkContext.defaultParallelism
    return df if name not in TABLES or len(df.inputFiles()) >= cores else df.repartition(cores)


def _spark_text(text: str) -> str:
    text = text.replace("ARRAY_OF(", "array(")
    text = _EACH.sub(r"LATERAL VIEW explode(sequence(\2, \3)) _e AS \1", text)
    return text.replace("date_part('epoch', ts)", "unix_timestamp(ts)")


def ctes(*names: str) -> str:
    """The same views for the oracle, as the start of a WITH clause (ends without a comma)."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in TABLES or name in order:
            return
        for dep in _NAME.findall(_duck_text(VIEWS[name])):
            visit(dep)
        order.append(name)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({_NAME.sub(r'\1', _duck_text(VIEWS[n]))})" for n in order)


def _duck_text(text: str) -> str:
    text = text.replace("ARRAY_OF(", "list_value(")
    return _EACH.sub(r", LATERAL (SELECT CAST(unnest(range(\2, \3 + 1)) AS INT) AS \1) AS _e", text)
