"""Queries of the mapping stage over the sheet views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specloom.functions import records as R
from specloom.functions import text as X
from specloom.operators import diff, diff_json, mapping, reshape, scan
from specloom.operators.mapping import Rule
from specloom.plans.registry import query
from specloom.plans.views import SHEET_COLUMNS, ctes, spread, view

RULES = [
    Rule(["model"], row=("includes", "model")),
    Rule(["pv_input.w_max"], section=("includes", "pv"), row=("exact", "Max. DC Power"), fn="integers"),
    Rule(["pv_input.v_mppt.min", "pv_input.v_mppt.max"], section=("includes", "PV"), row=("regex", "^MPPT.*Range$"), fn="integers"),
    Rule(["pv_input.v_crit.max"], row=("includes", "voltage range"), fn="numbers"),
    Rule(["pv_input.i_sc"], section=("exact", "PV Input"), row=("includes", "input current"), fn="numbers"),
    Rule(["battery_input.i_charge_ac"], section=("regex", "^Batt"), row=("includes", "charge current"), fn="numbers"),
    Rule(["general_data.noice"], row=("includes", "noise"), fn="assign"),
    Rule(["general_data.size.width", "general_data.size.height", "general_data.size.depth"], row=("exact", "Dimensions"), fn="integers"),
    Rule(["brand"], const="ACME"),
    Rule(["tags"], row=("exact", "Cooling"), fn="integers"),
    Rule(["battery_input.i_charge_pv"], row=("exact", "Charge Current"), col=("regex", "^Max ([0-9.]+) A$"), fn="regex_groups"),
    Rule(["general_data.weigth"], row=("exact", "Weight"), col=("regex", "^([0-9]+(?:[.][0-9]+)?) kg$"), fn="regex_groups"),
    Rule(["general_data.size.width"], row=("exact", "Weight"), fn="numbers"),
    Rule(["pv_input.n_mppt"], row=("exact", "Max. DC Power"), fn="integers"),
    Rule(["pv_input.n_mppt"], const="2"),
    Rule(["pv_input.w_max"], row=("exact", "Noise (dB)"), fn="integers"),
]
SINGLE_RULES = [r for r in RULES if len(r.targets) == 1]
TARGETS = sorted({t for r in RULES for t in r.targets})
SINGLE_TARGETS = sorted({t for r in SINGLE_RULES for t in r.targets})


def flat(path: str) -> str:
    return path.replace(".", "__")


# ---- inputs -----------------------------------------------------------------


def wide_sheets(spark: SparkSession, sf: str) -> DataFrame:
    """Stored form: one row per property, repeated sections blanked."""
    return _wide(spark, sf)[0]


def _wide(spark: SparkSession, sf: str) -> tuple[DataFrame, bool]:
    """The stored form, and whether a sheet is hot: asked once, of the cells, before any shuffle."""
    cells = view(spark, sf, "v_spec_cell")
    hot = scan.has_hot_key(cells, reshape.SHEET)
    return reshape.blank_sections(reshape.long_to_wide(cells, SHEET_COLUMNS), hot=hot), hot


def sheet_rows(spark: SparkSession, sf: str) -> DataFrame:
    wide, hot = _wide(spark, sf)
    return reshape.sheet_rows(wide, SHEET_COLUMNS, hot=hot).withColumn("ruleset", F.lit("main"))


def entries(spark: SparkSession, sf: str, rules=RULES) -> DataFrame:
    return mapping.cell_entries(mapping.single_matches(sheet_rows(spark, sf), {"main": rules}))


def filled(spark: SparkSession, sf: str) -> DataFrame:
    return mapping.fill(entries(spark, sf), {"main": RULES})


def records(spark: SparkSession, sf: str, strict: bool = False) -> DataFrame:
    return mapping.map_sheets(sheet_rows(spark, sf), {"main": RULES}, strict=strict)


# ---- oracle text --------------------------------------------------------------

_COLS = ", ".join(f"max(CASE WHEN col_idx = {i} THEN value END) AS c{i}" for i in range(SHEET_COLUMNS))
_VALS = "[" + ", ".join(f"c{i}" for i in range(SHEET_COLUMNS)) + "]"


def _lit(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _rule_rows(rules) -> str:
    out = []
    for i, r in enumerate(rules):
        s, w, c = (m or (None, None) for m in (r.section, r.row, r.col))
        targets = "[" + ", ".join(_lit(t) for t in r.targets) + "]"
        out.append(f"({i}, {targets}, {', '.join(_lit(x) for x in (*s, *w, *c, r.const))}, {_lit(r.fn)})")
    return ", ".join(out)


def _holds(kind: str, pat: str, value: str) -> str:
    return (
        f"CASE {kind} WHEN 'exact' THEN {value} = {pat} WHEN 'includes' THEN contains(lower({value}), lower({pat})) "
        f"WHEN 'regex' THEN regexp_matches({value}, {pat}) ELSE true END"
    )


WIDE = (
    ctes("v_spec_cell")
    + f""",
pivoted AS (SELECT sheet_id, row_idx, section, property, {_COLS} FROM v_spec_cell GROUP BY ALL),
wide AS (SELECT sheet_id, row_idx, CASE WHEN section IS NOT DISTINCT FROM lag(section) OVER (PARTITION BY sheet_id ORDER BY row_idx)
  THEN NULL ELSE section END AS section, property, c0, c1, c2, c3 FROM pivoted),
filled AS (SELECT sheet_id, row_idx, property, coalesce(last_value(nullif(section, '') IGNORE NULLS)
  OVER (PARTITION BY sheet_id ORDER BY row_idx), '') AS section, {_VALS} AS vals FROM wide)"""
)


def matched_sql(rules=RULES) -> str:
    return WIDE + f""",
rule(rule_idx, targets, section_kind, section_pat, row_kind, row_pat, col_kind, col_pat, const, fn) AS (VALUES {_rule_rows(rules)}),
pair AS (SELECT f.*, r.* FROM filled f JOIN rule r ON r.const IS NULL
  AND {_holds('section_kind', 'section_pat', 'f.section')} AND {_holds('row_kind', 'row_pat', 'f.property')}),
fit AS (SELECT p.* FROM pair p WHERE NOT EXISTS (SELECT 1 FROM (SELECT coalesce(unnest(p.vals), '') AS v) u
  WHERE NOT ({_holds('p.col_kind', 'p.col_pat', 'u.v')}))),
one AS (SELECT * FROM fit QUALIFY count(*) OVER (PARTITION BY sheet_id, rule_idx) = 1)"""


def entry_sql(rules=RULES) -> str:
    arrays = ", ".join(_lit(t) for t in R.array_targets(R.DEVICE))
    return matched_sql(rules) + f""",
cell AS (SELECT *, unnest(range(0, len(vals))) AS col_idx FROM one),
text AS (SELECT *, vals[col_idx + 1] AS value, CASE WHEN vals[col_idx + 1] IS NULL THEN NULL ELSE CASE fn
  WHEN 'assign' THEN list_transform(targets, lambda t: vals[col_idx + 1])
  WHEN 'integers' THEN regexp_extract_all(vals[col_idx + 1], '\\d+')
  WHEN 'numbers' THEN regexp_extract_all(vals[col_idx + 1], '\\d+(?:\\.\\d+)?')
  ELSE [regexp_extract(vals[col_idx + 1], col_pat, 1)] END END AS texts FROM cell),
entry AS (SELECT sheet_id, col_idx, rule_idx, row_idx, value, targets, CASE
  WHEN len(targets) = 1 AND targets[1] IN ({arrays}) THEN [texts]
  WHEN len(texts) = len(targets) THEN list_transform(texts, lambda t: [t]) END AS vals FROM text)"""


def fold_sql(rules=RULES, targets=tuple(TARGETS)) -> str:
    """The rules applied strictly one after another, one CTE per rule."""
    cols = ", ".join(f"CAST(NULL AS VARCHAR[]) AS {flat(t)}" for t in targets)
    sql = entry_sql(rules) + f""",
state_0 AS (SELECT sheet_id, col_idx, {cols} FROM v_spec_cell WHERE row_idx = 0)"""
    for i, r in enumerate(rules):
        sets = []
        free = " AND ".join(f"s.{flat(t)} IS NULL" for t in r.targets)
        for t in targets:
            name = flat(t)
            if t not in r.targets:
                sets.append(f"s.{name}")
            elif r.const:
                sets.append(f"[{_lit(r.const)}] AS {name}")
            else:
                at = list(r.targets).index(t) + 1
                sets.append(f"CASE WHEN e.vals IS NOT NULL AND {free} THEN e.vals[{at}] ELSE s.{name} END AS {name}")
        sql += f""",
state_{i + 1} AS (SELECT s.sheet_id, s.col_idx, {', '.join(sets)} FROM state_{i} s
  LEFT JOIN entry e ON e.sheet_id = s.sheet_id AND e.col_idx = s.col_idx AND e.rule_idx = {i})"""
    return sql + f""",
folded AS (SELECT * FROM state_{len(rules)})"""


def _typed(t: str) -> str:
    """Typed value of one leaf; numbers as DuckDB would read them only where Spark does too."""
    kind = R.leaf_types(R.DEVICE)[t].simpleString()
    one = f"{flat(t)}[1]"
    if kind == "string":
        return one
    if kind == "int":
        return f"CASE WHEN regexp_matches({one}, '^\\s*[+-]?\\d+\\s*$') THEN CAST({one} AS INTEGER) END"
    if kind == "double":
        return f"CASE WHEN regexp_matches({one}, '^\\s*[+-]?\\d+(\\.\\d+)?\\s*$') THEN CAST({one} AS DOUBLE) END"
    return f"array_to_string({flat(t)}, '|')"


def _typed_column(t: str):
    kind = R.leaf_types(R.DEVICE)[t].simpleString()
    col = F.col(f"`{t}`")
    if kind == "array<double>":
        col = F.transform(col, lambda v: F.regexp_replace(v.cast("string"), r"\.0$", ""))
    return (F.array_join(col, "|") if kind.startswith("array") else col).alias(flat(t))


TYPED = ", ".join(f"{_typed(t)} AS {flat(t)}" for t in TARGETS)


# ---- queries --------------------------------------------------------------------


@query("section_ffill", WIDE + " SELECT sheet_id, row_idx, section, property FROM filled")
def section_ffill(spark, sf):
    return reshape.fill_sections(wide_sheets(spark, sf)).select("sheet_id", "row_idx", "section", "property")


@query(
    "reshape_wide",
    ctes("v_spec_cell")
    + """,
first_seen AS (SELECT sheet_id, section, property, min(col_idx * 1000 + 99 - row_idx) AS k FROM v_spec_cell GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY sheet_id ORDER BY k) - 1 AS row_no FROM first_seen)
SELECT r.sheet_id, CAST(r.row_no AS INT) AS row_no, r.section, r.property,
"""
    + _COLS
    + " FROM ranked r JOIN v_spec_cell c ON c.sheet_id = r.sheet_id AND c.section = r.section AND c.property = r.property GROUP BY ALL",
)
def reshape_wide(spark, sf):
    """Rows in order of first appearance; the sequence inside a column runs bottom-up here."""
    cells = view(spark, sf, "v_spec_cell").withColumn("seq", 99 - F.col("row_idx"))
    wide = reshape.long_to_wide(cells, SHEET_COLUMNS, keys=["sheet_id", "section", "property"], order=("col_idx", "seq"))
    names = [F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(reshape.column_names(SHEET_COLUMNS))]
    return wide.select("sheet_id", F.col("row_idx").alias("row_no"), "section", "property", *names)


@query("reshape_long", WIDE + " SELECT sheet_id, row_idx, property, CAST(unnest(range(0, 4)) AS INT) AS col_idx, unnest(vals) AS value FROM filled")
def reshape_long(spark, sf):
    return reshape.wide_to_long(wide_sheets(spark, sf), SHEET_COLUMNS).select("sheet_id", "row_idx", "property", "col_idx", "value")


@query("rule_row_join", matched_sql() + " SELECT sheet_id, rule_idx, row_idx, property FROM one JOIN filled USING (sheet_id, row_idx, property)")
def rule_row_join(spark, sf):
    rows = sheet_rows(spark, sf)
    found = mapping.single_matches(rows, {"main": RULES}, keep=["property"])
    return found.filter(F.col("const").isNull() & (F.col("rule_idx") >= 0)).select("sheet_id", "rule_idx", "row_idx", "property")


_MANY_ROWS = "SELECT 'many' AS ruleset, c_custkey AS sheet_id, 0 AS row_idx, c_mktsegment AS section, concat(c_name, ' (', c_nationkey, ')') AS property, CAST(c_acctbal AS {text}) AS value FROM {customer}"
# One rule for each supplier: a substring that one row has, one that some have, a pattern with a literal, a
# named section with a pattern without one, and a pattern without a literal alone.
_MANY_RULES = """SELECT 'many' AS ruleset, s_suppkey AS rule_idx,
 CASE WHEN k = 3 THEN 'exact' END AS section_kind, CASE WHEN k = 3 THEN CASE s_nationkey % 3 WHEN 0 THEN 'MACHINERY' WHEN 1 THEN 'BUILDING' ELSE 'None' END END AS section_pat,
 CASE WHEN k < 2 THEN 'includes' ELSE 'regex' END AS row_kind,
 CASE k WHEN 0 THEN concat('MER#', lpad(concat(s_suppkey * 7), 9, '0')) WHEN 1 THEN concat(lpad(concat(s_suppkey), 3, '0'), ' (')
  WHEN 2 THEN concat('^Customer#0+', s_suppkey, '[0-9] [(]', s_suppkey % 25, '[)]$') WHEN 3 THEN '2[0-4].$' ELSE concat('[13579] [(]', s_suppkey % 25, '[)]') END AS row_pat
FROM (SELECT *, CASE WHEN s_suppkey % 16 = 4 THEN 4 ELSE s_suppkey % 4 END AS k FROM {supplier}) AS s"""


@query(
    "rule_row_index",
    f"WITH r AS ({_MANY_ROWS.format(text='VARCHAR', customer='customer')}), m AS ({_MANY_RULES.format(supplier='supplier')})"
    " SELECT sheet_id, rule_idx FROM r JOIN m ON (section_kind IS NULL OR section = section_pat)"
    " AND CASE row_kind WHEN 'includes' THEN contains(lower(property), lower(row_pat)) ELSE regexp_matches(property, row_pat) END",
)
def rule_row_index(spark, sf):
    """As many rules as there are suppliers on as many rows as there are customers, by the literal index."""
    rows = spark.sql(_MANY_ROWS.replace("{text}", "STRING"), customer=spread(spark, "customer", view(spark, sf, "customer")))
    rows = rows.withColumn("vals", F.array("value")).drop("value")
    rules = spark.sql(_MANY_RULES, supplier=view(spark, sf, "supplier"))
    unused = {n: F.lit(None).cast("string") for n in ("col_kind", "col_pat", "const")}
    rules = rules.withColumns(unused).withColumns({"targets": F.array().cast("array<string>"), "fn": F.lit("assign"), "n_groups": F.lit(0)})
    return mapping.match_rows(rows, rules).select("sheet_id", "rule_idx")


def _match_query(kind: str, condition: str):
    return ctes("v_spec_cell") + f" SELECT sheet_id, row_idx, col_idx, value FROM v_spec_cell WHERE {condition}"


@query("match_exact", _match_query("exact", "property = 'MPPT Range'"))
def match_exact(spark, sf):
    cells = view(spark, sf, "v_spec_cell")
    return cells.filter(X.match_exact(F.col("property"), "MPPT Range")).select("sheet_id", "row_idx", "col_idx", "value")


@query("match_includes", _match_query("includes", "contains(lower(property), 'current')"))
def match_includes(spark, sf):
    cells = view(spark, sf, "v_spec_cell")
    return cells.filter(X.match_includes(F.col("property"), "CURRENT")).select("sheet_id", "row_idx", "col_idx", "value")


@query("match_regex", _match_query("regex", "regexp_matches(value, '[0-9]{2,}-[0-9]+ V')"))
def match_regex(spark, sf):
    cells = view(spark, sf, "v_spec_cell")
    return cells.filter(X.match_regex(F.col("value"), "[0-9]{2,}-[0-9]+ V")).select("sheet_id", "row_idx", "col_idx", "value")


@query(
    "all_columns_match",
    ctes("v_spec_cell")
    + " SELECT sheet_id, row_idx, property, count(*) AS n_cols FROM v_spec_cell GROUP BY ALL HAVING bool_and(regexp_matches(value, '^[0-9.]+ kg$') OR value = 'Fan')",
)
def all_columns_match(spark, sf):
    """Long form: one boolean per (sheet, row), combined map-side."""
    cells = view(spark, sf, "v_spec_cell")
    holds = X.match_regex(F.col("value"), "^[0-9.]+ kg$") | X.match_exact(F.col("value"), "Fan")
    rows = cells.groupBy("sheet_id", "row_idx", "property").agg(F.count(F.lit(1)).alias("n_cols"), F.bool_and(holds).alias("_ok"))
    return rows.filter("_ok").drop("_ok")


_ENTRY = "sheet_id, CAST(col_idx AS INT) AS col_idx, rule_idx"


@query(
    "assign_cell",
    entry_sql() + f" SELECT {_ENTRY}, targets[1] AS target, vals[1][1] AS value_text FROM entry WHERE rule_idx IN (0, 6)",
)
def assign_cell(spark, sf):
    rows = entries(spark, sf).filter(F.col("rule_idx").isin(0, 6))
    return rows.select("sheet_id", "col_idx", "rule_idx", F.col("targets")[0].alias("target"), F.col("vals")[0][0].alias("value_text"))


@query(
    "const_value",
    ctes("v_spec_cell") + " SELECT sheet_id, col_idx, 'brand' AS target, 'ACME' AS value_text FROM v_spec_cell WHERE row_idx = 0"
    " UNION ALL SELECT sheet_id, col_idx, 'pv_input.n_mppt', '2' FROM v_spec_cell WHERE row_idx = 0",
)
def const_value(spark, sf):
    rows = entries(spark, sf).filter("overwrite")
    return rows.select("sheet_id", "col_idx", F.col("targets")[0].alias("target"), F.col("vals")[0][0].alias("value_text"))


@query(
    "match_arity",
    entry_sql() + f" SELECT {_ENTRY}, len(targets) AS n_targets, vals IS NOT NULL AS fits FROM entry",
)
def match_arity(spark, sf):
    rows = entries(spark, sf).filter("not overwrite and rule_idx >= 0")
    return rows.select("sheet_id", "col_idx", "rule_idx", F.size("targets").cast("bigint").alias("n_targets"), F.col("vals").isNotNull().alias("fits"))


@query(
    "extract_numbers",
    ctes("v_spec_cell")
    + " SELECT sheet_id, row_idx, col_idx, array_to_string(regexp_extract_all(value, '\\d+'), '|') AS integers,"
    " array_to_string(regexp_extract_all(value, '\\d+(?:\\.\\d+)?'), '|') AS numbers FROM v_spec_cell",
)
def extract_numbers(spark, sf):
    cells = view(spark, sf, "v_spec_cell")
    ints, nums = F.array_join(X.integers(F.col("value")), "|"), F.array_join(X.numbers(F.col("value")), "|")
    return cells.select("sheet_id", "row_idx", "col_idx", ints.alias("integers"), nums.alias("numbers"))


_GROUP_RE = "^([0-9]+)(?:[.]([0-9]+))? kg|Max ([0-9]+)"


@query(
    "extract_groups",
    ctes("v_spec_cell")
    + f" SELECT sheet_id, row_idx, col_idx, nullif(regexp_extract(value, '{_GROUP_RE}', 1), '') AS g1, nullif(regexp_extract(value, '{_GROUP_RE}', 2), '') AS g2,"
    f" nullif(regexp_extract(value, '{_GROUP_RE}', 3), '') AS g3 FROM v_spec_cell WHERE regexp_matches(value, '{_GROUP_RE}')",
)
def extract_groups(spark, sf):
    cells = view(spark, sf, "v_spec_cell").withColumn("_g", X.groups(F.col("value"), _GROUP_RE, 3)).filter("_g IS NOT NULL")
    return cells.select("sheet_id", "row_idx", "col_idx", *[F.col("_g")[i].alias(f"g{i + 1}") for i in range(3)])


def _joined(targets) -> str:
    return ", ".join(f"array_to_string({flat(t)}, '|') AS {flat(t)}" for t in targets)


@query("first_filled_wins", fold_sql() + f" SELECT sheet_id, CAST(col_idx AS INT) AS col_idx, {_joined(TARGETS)} FROM folded")
def first_filled_wins(spark, sf):
    texts = [F.array_join(F.col(f"`{t}`"), "|").alias(flat(t)) for t in TARGETS]
    return filled(spark, sf).select("sheet_id", "col_idx", *texts)


@query(
    "first_filled_wins_single",
    fold_sql(SINGLE_RULES, tuple(SINGLE_TARGETS)) + f" SELECT sheet_id, CAST(col_idx AS INT) AS col_idx, {_joined(SINGLE_TARGETS)} FROM folded",
)
def first_filled_wins_single(spark, sf):
    """Rules with one target each take the aggregate path."""
    rows = mapping.fill(entries(spark, sf, SINGLE_RULES), {"main": SINGLE_RULES})
    texts = [F.array_join(F.col(f"`{t}`"), "|").alias(flat(t)) for t in SINGLE_TARGETS]
    return rows.select("sheet_id", "col_idx", *texts)


@query("coerce_typed", fold_sql() + f" SELECT sheet_id, CAST(col_idx AS INT) AS col_idx, {TYPED} FROM folded")
def coerce_typed(spark, sf):
    leaves = mapping.typed_leaves(filled(spark, sf))
    return leaves.select("sheet_id", "col_idx", *[_typed_column(t) for t in TARGETS])


@query(
    "coerce_strict",
    fold_sql()
    + f", typed AS (SELECT sheet_id, CAST(col_idx AS INT) AS col_idx, {TYPED}, general_data__noice[1] AS raw_noise FROM folded),"
    " bad AS (SELECT DISTINCT sheet_id FROM typed WHERE raw_noise IS NOT NULL AND general_data__noice IS NULL)"
    " SELECT * EXCLUDE (raw_noise) FROM typed ANTI JOIN bad USING (sheet_id)",
)
def coerce_strict(spark, sf):
    """One bad value rejects its whole sheet."""
    leaves = mapping.typed_leaves(filled(spark, sf), strict=True)
    return leaves.select("sheet_id", "col_idx", *[_typed_column(t) for t in TARGETS])


@query(
    "quarantine_stop",
    fold_sql()
    + f", typed AS (SELECT sheet_id, CAST(col_idx AS INT) AS col_idx, {TYPED}, general_data__noice[1] AS raw_noise FROM folded),"
    " bad AS (SELECT DISTINCT sheet_id FROM typed WHERE raw_noise IS NOT NULL AND general_data__noice IS NULL)"
    " SELECT * EXCLUDE (raw_noise) FROM typed ANTI JOIN bad USING (sheet_id)",
)
def quarantine_stop(spark, sf):
    """The run that a bad value would stop, over the sheets that have none: all of their records."""
    texts = filled(spark, sf)
    clean = texts.join(mapping.quarantine(texts).select("sheet_id").distinct(), "sheet_id", "left_anti")
    leaves = mapping.typed_leaves(clean, on_error="stop")
    return leaves.select("sheet_id", "col_idx", *[_typed_column(t) for t in TARGETS])


@query(
    "quarantine_errors",
    fold_sql() + " SELECT sheet_id, CAST(col_idx AS INT) AS col_idx, 'general_data.noice' AS path, general_data__noice[1] AS raw FROM folded"
    " WHERE general_data__noice IS NOT NULL AND NOT regexp_matches(general_data__noice[1], '^\\d+(\\.\\d+)?$')",
)
def quarantine_errors(spark, sf):
    return mapping.quarantine(filled(spark, sf))


_NESTED = """ SELECT sheet_id, CAST(col_idx AS INT) AS col_idx, model, pv_input__v_mppt__min AS mppt_min, pv_input__v_mppt__max AS mppt_max,
 (pv_input__v_mppt__min IS NULL AND pv_input__v_mppt__max IS NULL) AS mppt_unset, true AS crit_unset, true AS start_unset,
 (general_data__size__width IS NULL AND general_data__size__height IS NULL) AS size_unset,
 general_data__size__depth AS depth, pv_input__i_sc AS i_sc FROM typed"""


@query("nested_build", fold_sql() + f", typed AS (SELECT sheet_id, col_idx, {TYPED} FROM folded)" + _NESTED)
def nested_build(spark, sf):
    r = records(spark, sf)
    i_sc = F.array_join(F.transform("pv_input.i_sc", lambda v: F.regexp_replace(v.cast("string"), r"\.0$", "")), "|")
    return r.select(
        "sheet_id",
        "col_idx",
        "model",
        F.col("pv_input.v_mppt.min").alias("mppt_min"),
        F.col("pv_input.v_mppt.max").alias("mppt_max"),
        F.col("pv_input.v_mppt").isNull().alias("mppt_unset"),
        F.col("pv_input.v_crit").isNull().alias("crit_unset"),
        F.col("pv_input.v_start").isNull().alias("start_unset"),
        F.col("general_data.size").isNull().alias("size_unset"),
        F.col("general_data.size.depth").alias("depth"),
        i_sc.alias("i_sc"),
    )


@query(
    "nested_get",
    fold_sql() + " SELECT sheet_id, CAST(col_idx AS INT) AS col_idx, CAST(pv_input__i_sc[2] AS DOUBLE) AS second_isc, CAST(pv_input__i_sc[6] AS DOUBLE) AS sixth_isc,"
    " CAST(general_data__size__height[1] AS DOUBLE) AS height, CAST(NULL AS INT) AS crit_min FROM folded",
)
def nested_get(spark, sf):
    r = records(spark, sf).select("sheet_id", "col_idx", F.struct("pv_input", "general_data").alias("rec"))
    return r.select(
        "sheet_id",
        "col_idx",
        R.get_path("rec", "pv_input.i_sc.1").alias("second_isc"),
        R.get_path("rec", "pv_input.i_sc.5").alias("sixth_isc"),
        R.get_path("rec", "general_data.size.height").alias("height"),
        R.get_path("rec", "pv_input.v_crit.min").alias("crit_min"),
    )


@query(
    "path_safe_name",
    ctes("v_spec_cell") + " SELECT sheet_id, col_idx, value AS model, CASE WHEN col_idx = 3 THEN 'col:3' ELSE trim(replace(value, '/', '_'), '.') END AS file_name"
    " FROM v_spec_cell WHERE row_idx = 0",
)
def path_safe_name(spark, sf):
    models = view(spark, sf, "v_spec_cell").filter("row_idx = 0")
    model = F.when(F.col("col_idx") < 3, F.col("value")).otherwise("")
    return models.select("sheet_id", "col_idx", F.col("value").alias("model"), X.path_safe(model, F.col("col_idx")).alias("file_name"))


_EDITED = """, other AS (SELECT sheet_id, row_idx, col_idx, CASE WHEN row_idx = 2 AND col_idx = 1 THEN concat(value, '*') ELSE value END AS value
 FROM v_spec_cell WHERE NOT (row_idx = 4 AND col_idx = 3) UNION ALL SELECT sheet_id, 99, col_idx, 'extra' FROM v_spec_cell WHERE row_idx = 0 AND col_idx = 0)"""


def _edited(cells: DataFrame) -> DataFrame:
    value = F.when((F.col("row_idx") == 2) & (F.col("col_idx") == 1), F.concat("value", F.lit("*"))).otherwise(F.col("value"))
    kept = cells.filter("not (row_idx = 4 and col_idx = 3)").select("sheet_id", "row_idx", "col_idx", value.alias("value"))
    extra = cells.filter("row_idx = 0 and col_idx = 0").select("sheet_id", F.lit(99).alias("row_idx"), "col_idx", F.lit("extra").alias("value"))
    return kept.unionByName(extra)


@query(
    "spec_diff",
    ctes("v_spec_cell") + _EDITED + " SELECT coalesce(a.sheet_id, b.sheet_id) AS sheet_id, coalesce(a.row_idx, b.row_idx) AS row_idx,"
    " coalesce(a.col_idx, b.col_idx) AS col_idx, a.value AS old_value, b.value AS new_value,"
    " CASE WHEN a.sheet_id IS NULL THEN 'added' WHEN b.sheet_id IS NULL THEN 'removed' ELSE 'changed' END AS status"
    " FROM v_spec_cell a FULL JOIN other b ON a.sheet_id = b.sheet_id AND a.row_idx = b.row_idx AND a.col_idx = b.col_idx"
    " WHERE a.sheet_id IS NULL OR b.sheet_id IS NULL OR a.value IS DISTINCT FROM b.value",
)
def spec_diff(spark, sf):
    cells = view(spark, sf, "v_spec_cell").select("sheet_id", "row_idx", "col_idx", "value")
    return diff.diff_cells(cells, _edited(cells), ["sheet_id", "row_idx", "col_idx"])


@query(
    "key_difference",
    ctes("v_spec_cell") + _EDITED + ", a AS (SELECT DISTINCT sheet_id, row_idx, col_idx FROM v_spec_cell), b AS (SELECT DISTINCT sheet_id, row_idx, col_idx FROM other)"
    " SELECT *, 'a' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT *, 'b' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)"
    " UNION ALL SELECT *, 'both' FROM (SELECT * FROM a INTERSECT SELECT * FROM b)",
)
def key_difference(spark, sf):
    cells = view(spark, sf, "v_spec_cell").select("sheet_id", "row_idx", "col_idx", "value")
    return diff.key_difference(cells, _edited(cells), ["sheet_id", "row_idx", "col_idx"])


@query(
    "concat_attributes",
    ctes("v_part") + """, cells AS (SELECT sheet_id, col_idx, CAST(p_size % 3 AS VARCHAR) AS section, p_type AS property, CAST(p_partkey AS INT) AS frag_id,
 CAST(p_size % 7 AS DOUBLE) AS midy, p_name AS value FROM v_part)
 SELECT CAST(floor(sheet_id / 25) AS BIGINT) AS sheet_id, col_idx, section, property, string_agg(value, ' ' ORDER BY midy, frag_id) AS value FROM cells GROUP BY ALL""",
)
def concat_attributes(spark, sf):
    cells = view(spark, sf, "v_part").select(
        F.floor(F.col("sheet_id") / 25).alias("sheet_id"),
        "col_idx",
        (F.col("p_size") % 3).cast("string").alias("section"),
        F.col("p_type").alias("property"),
        F.col("p_partkey").alias("frag_id"),
        (F.col("p_size") % 7).cast("double").alias("midy"),
        F.col("p_name").alias("value"),
    )
    return reshape.concat_attributes(cells)


# The same parts before and after: a key gone, a key new, a number that became a text, another length, an
# object that became an array, another value, and parts that one side lacks.
_DOC_TEXT = """concat('{{"name":"', p_name, '"', CASE WHEN {new} AND p_partkey % 5 = 0 THEN '' ELSE concat(',"brand":"', p_brand, '"') END,
 ',"size":', CASE WHEN {new} AND p_partkey % 4 = 1 THEN concat('"', p_size, '"') ELSE concat(p_size) END,
 ',"dims":[', p_size, ',{{"w":', p_size * 2, '.5}}', CASE WHEN {new} AND p_partkey % 6 = 2 THEN ',null' ELSE '' END, ']',
 ',"in":', CASE WHEN {new} AND p_partkey % 7 = 3 THEN '[{{"v":1}}]' ELSE concat('{{"v":', p_size % 9 + CASE WHEN {new} AND p_partkey % 3 = 1 THEN 1 ELSE 0 END, CASE WHEN {new} AND p_partkey % 8 = 5 THEN ',"a b":{{"x":true}}' ELSE '' END, '}}') END, '}}')"""
_DOCS = {side: f"SELECT p_partkey, {_DOC_TEXT.format(new=new)} AS json FROM PART WHERE p_partkey % 11 <> {gone}" for side, new, gone in (("a", "false", 4), ("b", "true", 9))}


def _tree_sql(side: str) -> str:
    kind = "CASE WHEN type IS NULL THEN 'null' WHEN type = 'VARCHAR' THEN 'string' WHEN type LIKE '%BIGINT' THEN 'int' WHEN type = 'DOUBLE' THEN 'float' ELSE lower(type) END"
    return f"""{side} AS (SELECT d.p_partkey, t.fullkey AS path, CASE WHEN t.fullkey <> '$' THEN t.path END AS parent, {kind} AS kind,
 CASE WHEN t.type = 'ARRAY' THEN json_array_length(t.value) END AS length, CASE WHEN t.type = 'VARCHAR' THEN t.value ->> '$' ELSE CAST(t.atom AS VARCHAR) END AS value
 FROM ({_DOCS[side].replace('PART', 'part')}) d, json_tree(d.json) t)"""


@query(
    "spec_diff_nested",
    f"WITH {_tree_sql('a')}, {_tree_sql('b')},"
    " m AS (SELECT coalesce(a.p_partkey, b.p_partkey) AS p_partkey, coalesce(a.path, b.path) AS path, coalesce(a.parent, b.parent) AS parent, a.kind AS ak, b.kind AS bk, a.length AS al, b.length AS bl, a.value AS av, b.value AS bv"
    " FROM a FULL JOIN b ON a.p_partkey = b.p_partkey AND a.path = b.path),"
    " s AS (SELECT *, CASE WHEN ak IS NULL THEN 'only_new' WHEN bk IS NULL THEN 'only_old' WHEN ak <> bk THEN 'type' WHEN ak = 'array' AND al <> bl THEN 'length' WHEN ak NOT IN ('array', 'object') AND av IS DISTINCT FROM bv THEN 'value' END AS status FROM m)"
    " SELECT p_partkey, path, status, CASE WHEN status = 'length' THEN CAST(al AS VARCHAR) WHEN status = 'value' THEN av ELSE ak END AS old_value, CASE WHEN status = 'length' THEN CAST(bl AS VARCHAR) WHEN status = 'value' THEN bv ELSE bk END AS new_value"
    " FROM s WHERE status IS NOT NULL AND (status NOT LIKE 'only%' OR parent IS NULL OR EXISTS (SELECT 1 FROM m o WHERE o.p_partkey = s.p_partkey AND o.path = s.parent AND o.ak = 'object' AND o.bk = 'object'))",
)
def spec_diff_nested(spark, sf):
    """Differences of nested documents by path: types, lengths, keys of one side, values."""
    part = view(spark, sf, "part")
    text = {s: t.replace("{", "{{").replace("}", "}}").replace("PART", "{part}") for s, t in _DOCS.items()}
    old, new = (spark.sql(text[s], part=part) for s in "ab")
    return diff_json.diff_json(old, new, ["p_partkey"])
