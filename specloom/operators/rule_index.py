"""Index of large rule tables by the literals that their matchers need.

A rule that asks for a substring, or for a pattern in which a run of plain characters must occur, can only
fit texts that hold all `GRAM`-character pieces of that run. The rarest of these pieces proposes the texts
by an equi join; the matcher itself decides. Texts are looked up once each, however many rows have them.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specloom.functions import text as X
from specloom.operators.joins import lookup_join, pair_join, shuffled
from specloom.session import broadcast_rows, hot_rows, stable

# Characters of an indexed piece; shorter literals are not indexed.
GRAM = 3
# Characters of the piece that proposes the texts, where a literal has so many.
LONG = 6

# Columns of a rule that say which rows it fits.
MATCHERS = ["section_kind", "section_pat", "row_kind", "row_pat", "col_kind", "col_pat"]

_CUT = "\u0001"
# What a literal cannot be read from safely (choices, flags and look-arounds, quoting, escapes
# of several characters, nested classes, groups that may be absent), and what ends a run of plain characters.
_OPAQUE = r"\||\(\?|\\[QEpPxucNk0-9]|\[[^\]]*\[|\)[*?{]"
_ENDS = (
    (r"\\[\s\S]", _CUT),  # escapes
    (r"\[\^?\]?[^\]]*\]", _CUT),  # classes
    (r"[\s\S](?:[*?]|\{[^}]*\})[+?]?", _CUT),  # what may be absent or is counted
    (r"([\s\S])\+[+?]?", f"$1{_CUT}"),  # what may be repeated
    (r"[\^$.()]", _CUT),
)


def grams(text: Column, size: int = GRAM) -> Column:
    """Distinct pieces of `size` characters of a text; none of a shorter one."""
    places = F.sequence(F.lit(1), F.char_length(text) - (size - 1))
    return F.when(F.char_length(text) >= size, F.array_distinct(F.transform(places, lambda i: F.substring(text, i, F.lit(size))))).otherwise(F.array().cast("array<string>"))


def required_runs(kind: Column, pattern: Column) -> Column:
    """Lower-case texts that the lower-case form of every matching value contains; null if none are known.

    Of a regular expression these are the runs of plain ASCII characters that no construct makes optional;
    what is not read safely has none.
    """
    plain = F.when(~F.rlike(pattern, F.lit(_OPAQUE)), pattern)
    for found, new in _ENDS:
        plain = F.regexp_replace(plain, found, new)
    runs = F.filter(F.split(plain, _CUT), lambda r: F.rlike(r, F.lit(r"^[\x20-\x7E]+$")))
    return F.transform(F.when(kind == "includes", F.array(pattern)).when(kind == "regex", runs), lambda r: F.lower(r))


def required_literal(kind: Column, pattern: Column) -> Column:
    """The longest of the required runs; empty if there are none, null if none are known."""
    return F.reduce(required_runs(kind, pattern), F.lit(""), lambda best, r: F.when(F.char_length(r) > F.char_length(best), r).otherwise(best))


def anchored(rules: DataFrame) -> DataFrame:
    """Rules with how their rows are found: `anchor_field` (property or section), `anchor_how` (equal or
    gram) and `anchor` (a text); all null for rules that no text selects."""
    options = []
    for part, field in (("row", "property"), ("section", "section")):
        kind, pattern = F.col(f"{part}_kind"), F.col(f"{part}_pat")
        literal = required_literal(kind, pattern)
        entry = lambda how, text: F.struct(F.lit(field).alias("field"), F.lit(how).alias("how"), text.alias("text"))  # noqa: B023, E731
        options.append(F.when(kind == "exact", entry("equal", pattern)).when(F.char_length(literal) >= GRAM, entry("gram", literal)))
    chosen = F.coalesce(*options)
    return rules.withColumns({"anchor_field": chosen["field"], "anchor_how": chosen["how"], "anchor": chosen["text"]})


def selected_texts(texts: DataFrame, rules: DataFrame, kind: str, pattern: str) -> DataFrame:
    """(ruleset, text, rule_idx) of the texts that fit the matcher in the named columns of the rules;
    the rules have an `anchor` that every fitting text contains in lower case. The rarest piece of any
    required run, as the longest run may stand in all texts, and what stands around it in the run propose the
    texts; the whole run is looked for before the matcher is tried.

    Texts are cut anew wherever their pieces are needed, as pieces take far more room than texts. Rules beyond
    what may be broadcast are taken in turns, so pieces are not shuffled for them either.

    texts: (ruleset, text), each once.
    """
    limit = broadcast_rows(texts.sparkSession)
    pieces = lambda size: texts.select("ruleset", "text", F.lower("text").alias("_low"), F.explode(grams(F.lower("text"), size)).alias("gram"))
    runs = required_runs(F.col(kind), F.col(pattern))
    wanted = rules.select("ruleset", "rule_idx", F.explode(runs).alias("run")).withColumn("gram", F.explode(grams(F.col("run"))))
    # Only pieces that some rule asks for are counted, if those are few; counts combine before the shuffle.
    asked = stable(wanted.select("ruleset", "gram").distinct())
    n_asked = asked.count()
    counted = pieces(GRAM).select("ruleset", "gram")
    if n_asked <= limit:
        counted = lookup_join(counted, asked, ["ruleset", "gram"], how="left_semi", small_rows=n_asked)
    often = stable(counted.groupBy("ruleset", "gram").agg(F.count(F.lit(1)).alias("n")))
    low = F.struct(F.coalesce("n", F.lit(0)).alias("n"), (-F.char_length("run")).alias("shortness"), "gram", "run")
    rarest = lookup_join(wanted, often, ["ruleset", "gram"], how="left").groupBy("ruleset", "rule_idx").agg(F.min(low).alias("low"))
    keys = rarest.where("low.n > 0").select("ruleset", "rule_idx", "low.gram", "low.run")
    matchers = rules.select("ruleset", "rule_idx", "anchor", F.col(kind).alias("kind"), F.col(pattern).alias("pattern"), runs.alias("_runs"))
    # Where rules share a number, the run is that of one of them.
    run = F.when(F.array_contains("_runs", F.col("run")), F.col("run")).otherwise("")
    long = F.char_length("run") >= LONG
    around = F.substring("run", F.least(F.instr("run", F.col("gram")), F.char_length("run") - (LONG - 1)), F.lit(LONG))
    keyed = keys.join(shuffled(matchers), ["ruleset", "rule_idx"]).withColumn("run", run).drop("_runs")
    keyed = stable(keyed.withColumns({"gram": F.when(long, around).otherwise(F.col("gram")), "long": long}))
    fits = F.contains("_low", "run") & F.contains("_low", "anchor") & X.matches(F.col("kind"), F.col("pattern"), F.col("text"))
    hits = []
    for size in (GRAM, LONG):
        own = keyed.where(F.col("long") == (size == LONG)).drop("long")
        n = own.count()
        turns = math.ceil(n / limit) if 0 < limit < n else 1
        for turn in range(turns):
            some = own if turns == 1 else own.where(F.pmod(F.xxhash64("ruleset", "rule_idx"), F.lit(turns)) == turn)
            met = lookup_join(pieces(size), some, ["ruleset", "gram"], fits, small_rows=n if turns == 1 else limit)
            hits.append(stable(met.select("ruleset", "text", "rule_idx")))
    return reduce(DataFrame.unionByName, hits)


def fitting_rows(rows: DataFrame, rules: DataFrame, on: list[str], fits: Column) -> DataFrame:
    """Every (row, rule) pair that agrees in `on` and `fits`. Rules with equal matchers are tried once on a row,
    and only the rows that fit are repeated for each of them. The rules are read several times."""
    n = rules.count()
    matchers = stable(rules.select(*on, *MATCHERS).distinct())
    different = matchers.count()
    if different == n:
        return lookup_join(rows, rules, on, fits, small_rows=n)
    matchers = matchers.withColumn("_matcher", F.monotonically_increasing_id())
    known = [F.col(f"r.{c}").eqNullSafe(F.col(f"m.{c}")) for c in (*on, *MATCHERS)]
    numbered = rules.alias("r").join(shuffled(matchers.alias("m")), known).select("r.*", "m._matcher").drop(*on)
    hits = lookup_join(rows, matchers, on, fits, small_rows=different).drop(*MATCHERS)
    return lookup_join(hits, numbered, ["_matcher"], small_rows=n).drop("_matcher")


def anchored_rows(rows: DataFrame, rules: DataFrame, fits: Column) -> DataFrame:
    """Every (row, rule) pair that `fits`, for rules with an anchor; rows have ruleset, section, property."""
    spark = rows.sparkSession
    parts = []
    for field, prefix in (("property", "row"), ("section", "section")):
        own = rules.where(F.col("anchor_field") == field)
        equal = own.where("anchor_how = 'equal'").withColumn("_text", F.col("anchor"))
        keyed = rows.withColumn("_text", F.col(field))
        parts.append(fitting_rows(keyed, equal, ["ruleset", "_text"], fits))
        grammed = own.where("anchor_how = 'gram'")
        if grammed.isEmpty():
            continue
        texts = rows.where(F.col(field).isNotNull()).groupBy("ruleset", F.col(field).alias("text")).agg(F.count(F.lit(1)).alias("n"))
        # Dealt by their number: by bytes a few tasks would cut them all into pieces.
        texts = stable(texts.repartition(4 * spark.sparkContext.defaultParallelism, "ruleset", "text"))
        hits = selected_texts(texts.select("ruleset", "text"), grammed, f"{prefix}_kind", f"{prefix}_pat").withColumnRenamed("text", "_text")
        n_hits = hits.count()
        found = hits.join(shuffled(grammed), ["ruleset", "rule_idx"])
        if n_hits <= broadcast_rows(spark):
            parts.append(lookup_join(keyed, found, ["ruleset", "_text"], fits, small_rows=n_hits))
        else:
            hot = texts.where(F.col("n") > hot_rows(spark)).select("ruleset", F.col("text").alias("_text"))
            parts.append(pair_join(keyed, found, ["ruleset", "_text"], fits, hot=hot))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.drop("_text", "anchor_field", "anchor_how", "anchor")
