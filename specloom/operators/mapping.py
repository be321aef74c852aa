"""Rule-driven attribute mapping: sheet rows + ordered rules -> typed device records."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from specloom.functions import records as R
from specloom.functions import text as X
from specloom.operators import guard, rule_index
from specloom.operators.joins import lookup_join
from specloom.session import stable

KINDS = ("exact", "includes", "regex")
PRESENCE = -1
# Up to so many rules become predicates of the plan.
LITERAL_RULES = 200
FUNCTIONS = ("assign", "integers", "numbers", "regex_groups")

_TEXT = pa.string()
RULE_SCHEMA = pa.schema(
    [
        ("ruleset", _TEXT),
        ("rule_idx", pa.int32()),
        ("targets", pa.list_(_TEXT)),
        ("section_kind", _TEXT),
        ("section_pat", _TEXT),
        ("row_kind", _TEXT),
        ("row_pat", _TEXT),
        ("col_kind", _TEXT),
        ("col_pat", _TEXT),
        ("const", _TEXT),
        ("fn", _TEXT),
        ("n_groups", pa.int32()),
    ]
)


@dataclass(frozen=True)
class Rule:
    """One mapping action; a matcher is (kind, pattern) or None."""

    targets: Sequence[str]
    section: tuple[str, str] | None = None
    row: tuple[str, str] | None = None
    col: tuple[str, str] | None = None
    const: str | None = None
    fn: str = "assign"


def check_rule(rule: Rule, schema: T.StructType = R.DEVICE) -> None:
    """Plan-time checks, before any job starts."""
    R.check_targets(schema, list(rule.targets))
    for matcher in (rule.section, rule.row, rule.col):
        if matcher is not None and (matcher[0] not in KINDS or not matcher[1]):
            raise ValueError(f"a matcher needs exactly one of {KINDS}: {matcher}")
    if rule.fn not in FUNCTIONS:
        raise ValueError(f"unknown function {rule.fn}")
    if rule.const and len(rule.targets) != 1:
        raise ValueError("a constant goes to exactly one target")
    if rule.fn == "regex_groups" and (rule.col is None or rule.col[0] != "regex"):
        raise ValueError("regex_groups needs a column regex")


def rule_table(spark: SparkSession, rulesets: dict[str, Sequence[Rule]], schema: T.StructType = R.DEVICE) -> DataFrame:
    """Checked rules as a table; rule_idx is their order inside the ruleset.

    Each ruleset also gets a rule -1 without targets; it keeps a model that no rule fills.
    """
    out = []
    for name, rules in rulesets.items():
        out.append({"ruleset": name, "rule_idx": PRESENCE, "targets": [], "fn": "assign", "n_groups": 0})
        for idx, rule in enumerate(rules):
            check_rule(rule, schema)
            row = {"ruleset": name, "rule_idx": idx, "targets": list(rule.targets), "const": rule.const or None, "fn": rule.fn}
            for part, matcher in (("section", rule.section), ("row", rule.row), ("col", rule.col)):
                row[f"{part}_kind"], row[f"{part}_pat"] = matcher or (None, None)
            row["n_groups"] = re.compile(rule.col[1]).groups if rule.fn == "regex_groups" else 0
            out.append(row)
    return spark.createDataFrame(pa.Table.from_pylist(out, RULE_SCHEMA))


def _holds(kind: str, pat: str, value: str) -> Column:
    return F.col(kind).isNull() | X.matches(F.col(kind), F.col(pat), F.col(value))


def _matched(matcher: tuple[str, str] | None, value: Column) -> Column:
    """One matcher as a literal predicate, so a pattern is compiled once for a task."""
    if matcher is None:
        return F.lit(True)
    kind, pattern = matcher
    return {"exact": X.match_exact, "includes": X.match_includes, "regex": X.match_regex}[kind](value, pattern)


def _literal(rule: Rule | None, idx: int) -> tuple[Column, Column]:
    """Condition of a rule on a sheet row, and its fields; no rule stands for the presence marker."""
    if rule is None:
        rule = Rule([])
    if rule.const or idx == PRESENCE:
        holds = F.col("row_idx") == 0
    else:
        columns = F.lit(True) if rule.col is None else F.forall("vals", lambda v: _matched(rule.col, F.coalesce(v, F.lit(""))))
        holds = _matched(rule.section, F.col("section")) & _matched(rule.row, F.col("property")) & columns
    groups = re.compile(rule.col[1]).groups if rule.fn == "regex_groups" else 0
    fields = {
        "rule_idx": F.lit(idx),
        "targets": F.array(*[F.lit(t) for t in rule.targets]).cast("array<string>"),
        "col_pat": F.lit(rule.col[1] if rule.col else None).cast("string"),
        "const": F.lit(rule.const or None).cast("string"),
        "fn": F.lit(rule.fn),
        "n_groups": F.lit(groups),
    }
    return holds, F.struct(*[c.alias(n) for n, c in fields.items()])


def match_literal(rows: DataFrame, rulesets: dict[str, Sequence[Rule]], schema: T.StructType = R.DEVICE) -> DataFrame:
    """Every (sheet row, rule) pair that matches, without a join: each rule is a literal predicate of
    the plan, and the rules a row fits are exploded from it."""
    hits = []
    for name, rules in rulesets.items():
        for idx, rule in [(PRESENCE, None), *enumerate(rules)]:
            if rule is not None:
                check_rule(rule, schema)
            holds, fields = _literal(rule, idx)
            hits.append(F.when((F.col("ruleset") == name) & holds, fields))
    return rows.select("*", F.inline(F.array_compact(F.array(*hits))))


def match_rows(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """The same by join, for rule tables too large for a plan.

    A rule meets the rows whose property or section it names, or whose text holds the rarest piece of a
    literal that its matcher needs (see `rule_index`); all matchers follow as residual condition. Rules
    without such a text meet all rows of their ruleset, those with equal matchers as one. A constant (and the presence marker) belongs to
    the sheet as a whole, so it pairs with row 0 only.
    """
    whole = F.col("const").isNotNull() | (F.col("rule_idx") == PRESENCE)
    columns_ok = F.col("col_kind").isNull() | F.forall(
        "vals", lambda v: X.matches(F.col("col_kind"), F.col("col_pat"), F.coalesce(v, F.lit("")))
    )
    fits = _holds("section_kind", "section_pat", "section") & _holds("row_kind", "row_pat", "property") & columns_ok
    # Patterns of a large rule table are read by all cores, in how few files it may be stored.
    marked = stable(rule_index.anchored(rules.repartition(rules.sparkSession.sparkContext.defaultParallelism)).withColumn("_whole", whole))
    named = ~F.col("_whole") & F.col("anchor").isNotNull()
    sizes = marked.agg(F.count_if("_whole").alias("whole"), F.count_if(named).alias("named"), F.count(F.lit(1)).alias("all")).first()
    anchor = ["anchor_field", "anchor_how", "anchor"]
    parts = []
    if sizes["named"]:
        parts.append(rule_index.anchored_rows(rows, marked.filter(named).drop("_whole"), fits))
    if sizes["whole"]:
        parts.append(lookup_join(rows.filter("row_idx = 0"), marked.filter("_whole").drop("_whole", *anchor), ["ruleset"], small_rows=sizes["whole"]))
    rest = sizes["all"] - sizes["named"] - sizes["whole"]
    if rest or not parts:
        others = marked.filter(~F.col("_whole") & ~named).drop("_whole", *anchor)
        parts.append(rule_index.fitting_rows(rows, others, ["ruleset"], fits))
    return reduce(DataFrame.unionByName, parts)


def single_matches(rows: DataFrame, rulesets: dict[str, Sequence[Rule]], keep: Sequence[str] = (), schema: T.StructType = R.DEVICE, literal_rules: int = LITERAL_RULES) -> DataFrame:
    """Rules that match exactly one row of a sheet, with that row's values.

    One aggregate row per (sheet, rule) leaves each task, however many rows a sheet has.
    """
    n_rules = sum(len(r) + 1 for r in rulesets.values())
    if n_rules <= literal_rules:
        paired = match_literal(rows, rulesets, schema)
    else:
        paired = match_rows(rows, rule_table(rows.sparkSession, rulesets, schema))
    rule_cols = ["targets", "col_pat", "const", "fn", "n_groups"]
    found = paired.groupBy("sheet_id", "rule_idx").agg(
        F.count(F.lit(1)).alias("_n"),
        F.first(F.struct("row_idx", "vals", *rule_cols, *keep)).alias("_m"),
    )
    return found.filter(F.col("_n") == 1).select("sheet_id", "rule_idx", "_m.*")


def extracted(fn: Column, value: Column, targets: Column, col_pat: Column, n_groups: Column) -> Column:
    """Texts a rule takes from one cell."""
    by_group = F.transform(F.sequence(F.lit(1), n_groups), lambda k: F.nullif(F.call_function("regexp_extract", value, col_pat, k), F.lit("")))
    return (
        F.when(fn == "assign", F.transform(targets, lambda _: value))
        .when(fn == "integers", X.integers(value))
        .when(fn == "numbers", X.numbers(value))
        .when((fn == "regex_groups") & (n_groups > 0), by_group)
    )


def fitted(targets: Column, texts: Column, arrays: Sequence[str]) -> Column:
    """One array of texts per target, or null when the counts do not agree.

    A single array-typed target takes the whole list, even an empty one.
    """
    whole_list = (F.size(targets) == 1) & F.try_element_at(targets, F.lit(1)).isin(*arrays) if arrays else F.lit(False)
    each = F.transform(texts, lambda t: F.when(t.isNotNull(), F.array(t)))
    return F.when(whole_list, F.array(texts)).when(F.size(texts) == F.size(targets), each)


def cell_entries(matched: DataFrame, schema: T.StructType = R.DEVICE) -> DataFrame:
    """One entry per (sheet, model column, rule): targets and the texts for each of them."""
    cells = matched.select("*", F.posexplode("vals").alias("col_idx", "value")).drop("vals")
    texts = extracted(F.col("fn"), F.col("value"), F.col("targets"), F.col("col_pat"), F.col("n_groups"))
    is_const = F.col("const").isNotNull()
    arrays = R.array_targets(schema)
    vals = F.when(is_const, F.array(F.array("const"))).when(
        F.col("value").isNotNull(), fitted(F.col("targets"), texts, arrays)
    )
    return cells.select("sheet_id", "col_idx", "rule_idx", "row_idx", "targets", "value", vals.alias("vals"), is_const.alias("overwrite"))


def fill_single(entries: DataFrame, targets: Sequence[str]) -> DataFrame:
    """First filled wins for rules with one target each: plain min_by / max_by aggregates."""
    goal, text = F.try_element_at("targets", F.lit(1)), F.try_element_at("vals", F.lit(1))
    flat = entries.select("sheet_id", "col_idx", "rule_idx", "overwrite", goal.alias("_t"), text.alias("_v"))
    picks = []
    for t in targets:
        here = (F.col("_t") == t) & F.col("_v").isNotNull()
        constant = F.max_by("_v", F.when(here & F.col("overwrite"), F.col("rule_idx")))
        first = F.min_by("_v", F.when(here & ~F.col("overwrite"), F.col("rule_idx")))
        picks.append(F.coalesce(constant, first).alias(t))
    return flat.groupBy("sheet_id", "col_idx").agg(*picks)


def fill_ordered(entries: DataFrame, targets: Sequence[str]) -> DataFrame:
    """First filled wins for rules with several targets: all of them must still be empty.

    The array holds at most one entry per rule of the ruleset.
    """
    steps = F.array_sort(F.collect_list(F.struct("rule_idx", "targets", "vals", "overwrite")))
    start = F.create_map().cast("map<string,array<string>>")

    def apply(state: Column, e: Column) -> Column:
        free = F.forall(e["targets"], lambda t: F.try_element_at(state, t).isNull())
        rest = F.map_filter(state, lambda k, _: ~F.array_contains(e["targets"], k))
        filled = F.map_concat(rest, F.map_from_arrays(e["targets"], e["vals"]))
        return F.when(e["vals"].isNotNull() & (e["overwrite"] | free), filled).otherwise(state)

    folded = entries.groupBy("sheet_id", "col_idx").agg(F.reduce(steps, start, apply).alias("_state"))
    return folded.select("sheet_id", "col_idx", *[F.try_element_at("_state", F.lit(t)).alias(t) for t in targets])


def fill(entries: DataFrame, rulesets: dict[str, Sequence[Rule]]) -> DataFrame:
    """Texts per leaf for every model column; the cheap path is taken when it is exact."""
    rules = [r for rs in rulesets.values() for r in rs]
    targets = sorted({t for r in rules for t in r.targets})
    if all(len(r.targets) == 1 for r in rules):
        return fill_single(entries, targets)
    return fill_ordered(entries, targets)


def mapped_targets(filled: DataFrame, schema: T.StructType = R.DEVICE) -> list[str]:
    known = R.leaf_types(schema)
    return [c for c in filled.columns if c in known]


def quarantine(filled: DataFrame, schema: T.StructType = R.DEVICE) -> DataFrame:
    """Texts that do not fit their leaf, one row each."""
    types = R.leaf_types(schema)
    reports = []
    for t in mapped_targets(filled, schema):
        bad = R.is_bad(F.col(f"`{t}`"), types[t])
        reports.append(F.when(bad, F.struct(F.lit(t).alias("path"), F.array_join(F.col(f"`{t}`"), "|").alias("raw"))))
    rows = filled.select("sheet_id", "col_idx", F.explode(F.array_compact(F.array(*reports))).alias("_q"))
    return rows.select("sheet_id", "col_idx", "_q.path", "_q.raw")


def stop_on_bad(filled: DataFrame, schema: T.StructType = R.DEVICE) -> DataFrame:
    """The texts as they are; the first that does not fit its leaf fails the job, named in the error."""
    types = R.leaf_types(schema)
    at = F.concat(F.lit("sheet "), F.col("sheet_id").cast("string"), F.lit(", column "), F.col("col_idx").cast("string"))
    found = [F.when(R.is_bad(F.col(f"`{t}`"), types[t]), F.concat(at, F.lit(f", {t}: "), F.array_join(F.col(f"`{t}`"), "|"))) for t in mapped_targets(filled, schema)]
    return guard.stop_on(filled, F.coalesce(*found)) if found else filled


def typed_leaves(filled: DataFrame, schema: T.StructType = R.DEVICE, *, strict: bool = False, on_error: str | None = None) -> DataFrame:
    """Texts to typed leaves. What happens on a bad one says `on_error`: `quarantine` makes it null, `drop`
    (also strict=True) drops its whole sheet, `stop` fails the job."""
    on_error = on_error or (guard.DROP if strict else guard.QUARANTINE)
    if on_error not in guard.ON_ERROR:
        raise ValueError(f"on_error must be one of {guard.ON_ERROR}")
    types = R.leaf_types(schema)
    targets = mapped_targets(filled, schema)
    strict = on_error == guard.DROP
    if on_error == guard.STOP:
        filled = stop_on_bad(filled, schema)
    if strict:
        bad = X.any_of(F.coalesce(R.is_bad(F.col(f"`{t}`"), types[t]), F.lit(False)) for t in targets)
        rejected = filled.filter(bad).select("sheet_id").distinct()
        filled = filled.join(rejected, "sheet_id", "left_anti")
    return filled.select("sheet_id", "col_idx", *[R.coerce(F.col(f"`{t}`"), types[t]).alias(t) for t in targets])


def nested_records(leaves: DataFrame, schema: T.StructType = R.DEVICE) -> DataFrame:
    """Typed leaves to the nested record."""
    leaf = {t: F.col(f"`{t}`") for t in mapped_targets(leaves, schema)}
    return leaves.select("sheet_id", "col_idx", *R.nest(schema, leaf))


def fill_sheets(rows: DataFrame, rulesets: dict[str, Sequence[Rule]], schema: T.StructType = R.DEVICE) -> DataFrame:
    """Sheet rows (ruleset, sheet_id, row_idx, section, property, vals) to the texts of each leaf."""
    return fill(cell_entries(single_matches(rows, rulesets, schema=schema), schema), rulesets)


def typed_records(filled: DataFrame, schema: T.StructType = R.DEVICE, *, strict: bool = False, on_error: str | None = None) -> DataFrame:
    return nested_records(typed_leaves(filled, schema, strict=strict, on_error=on_error), schema)


def map_sheets(rows: DataFrame, rulesets: dict[str, Sequence[Rule]], schema: T.StructType = R.DEVICE, *, strict: bool = False) -> DataFrame:
    """Sheet rows to device records."""
    return typed_records(fill_sheets(rows, rulesets, schema), schema, strict=strict)


def first_writer(records: DataFrame, existing: DataFrame | None = None, keys: Sequence[str] = ("sheet_id", "file_name")) -> DataFrame:
    """Records still to be written: the first model per file name, none that exist already."""
    named = records.withColumn("file_name", X.path_safe(F.col("model"), F.col("col_idx")))
    first = named.groupBy(*keys).agg(F.min_by(F.struct(*named.columns), "col_idx").alias("_r")).select("_r.*")
    return first if existing is None else first.join(existing.select(*keys), list(keys), "left_anti")
