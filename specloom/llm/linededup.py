"""Lines that many sites share, by HyperLogLog sketches, kept once.

Each distinct line hash gets a sketch of the sites it occurs on; partial sketches are made before the
shuffle and merged after it. Lines whose estimate lies near the threshold are counted exactly. Lines on
enough distinct sites are boilerplate: they stay at their first place in the corpus and go elsewhere.
Everything is DataFrame functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specloom.llm.joins import broadcast_if_small, row_key, without
from specloom.session import stable

# A line on so many distinct sites is boilerplate.
MIN_SITES = 5
# log2 of the registers of a sketch, and how many standard errors count as near the threshold.
LG_K = 12
NEAR_ERRORS = 6
# Fixed value: what is taken off both ends of a line before it is compared.
BLANK = " \t\r\x0b\x0c"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANK))


def line_rows(docs: DataFrame, doc_id: str, text: str, site: str) -> DataFrame:
    """One row for each line that is not blank: row key, document, site, position from 0, line hash."""
    base = docs.select(*row_key(F.col(doc_id), F.col(text)), F.col(doc_id).alias("doc"), F.col(site).alias("site"), _lines(F.col(text)).alias("lines"))
    out = base.select("k1", "k2", "doc", "site", F.posexplode("lines").alias("pos", "line")).withColumn("line", _trimmed(F.col("line"))).where("line <> ''")
    return out.select("k1", "k2", "doc", "site", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2"))


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """(h1, h2, first_doc) of the lines on at least `min_sites` distinct sites; null is no site."""
    if min_sites < 2:
        raise ValueError("min_sites must be at least 2")
    near = max(1.0, NEAR_ERRORS * 1.04 / math.sqrt(1 << LG_K) * min_sites)
    sketched = lines.groupBy("h1", "h2").agg(F.hll_sketch_agg(F.col("site").cast("string"), F.lit(LG_K)).alias("sketch"), F.min("doc").alias("first_doc"))
    judged = sketched.select("h1", "h2", "first_doc", F.hll_sketch_estimate("sketch").alias("sites")).where(F.col("sites") >= min_sites - near)
    likely = stable(judged)
    doubtful = likely.where(F.abs(F.col("sites") - min_sites) <= near).select("h1", "h2")
    sure = likely.where(F.col("sites") > min_sites + near).select("h1", "h2", "first_doc")
    exact = lines.join(broadcast_if_small(doubtful), ["h1", "h2"]).groupBy("h1", "h2").agg(F.countDistinct("site").alias("sites"), F.min("doc").alias("first_doc"))
    return sure.unionByName(exact.where(F.col("sites") >= min_sites).select("h1", "h2", "first_doc"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """All rows and columns, with `kept_text`, `n_lines` and `n_removed` (lines that are not blank, and
    those of them removed). A boilerplate line stays in the document of the smallest id that holds it,
    at its first place there; equal rows are treated alike. Null texts stay null, blank lines and the
    white space of kept lines stay. Rows without an id are one document as far as this goes: a boilerplate
    line that only they hold stays in all of them, at its first place in each. Input columns of the three
    names are replaced, k1 and k2 are left out, others may have any name."""
    docs = without(docs, "kept_text", "n_lines", "n_removed", "k1", "k2")
    lines = line_rows(docs, doc_id, text, site)
    known = stable(boilerplate(lines, min_sites))
    hits = lines.join(broadcast_if_small(known), ["h1", "h2"])
    # Places of a line in one document, as a set: repeated rows add nothing.
    places = hits.groupBy("k1", "k2", "h1", "h2").agg(F.sort_array(F.collect_set("pos")).alias("at"), F.min("doc").alias("doc"), F.min("first_doc").alias("first_doc"))
    spare = F.when(F.col("doc").eqNullSafe(F.col("first_doc")), F.slice("at", 2, F.greatest(F.size("at") - 1, F.lit(0)))).otherwise(F.col("at"))
    removed = places.select("k1", "k2", F.explode(spare).alias("pos")).groupBy("k1", "k2").agg(F.sort_array(F.collect_list("pos")).alias("removed"))
    # The input row is one struct until the end, so no name of it meets a working name.
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *row_key(F.col(doc_id), F.col(text)))
    both = keyed.join(broadcast_if_small(stable(removed), "removed"), ["k1", "k2"], "left")
    # The lines between one removed place and the next, joined as slices, so a long text costs its length.
    r, n = F.col("removed"), F.size("removed")
    own = F.col("row")[text]

    def between(i: Column) -> Column:
        start = F.when(i == 0, F.lit(0)).otherwise(F.get(r, i - 1) + 1)
        end = F.when(i == n, F.size("lines")).otherwise(F.get(r, i))
        return F.slice(F.col("lines"), start + 1, end - start)

    both = both.withColumn("lines", _lines(own))
    kept = F.when(F.col("removed").isNull(), own).otherwise(F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), n), between)), "\n"))
    counted = F.size(F.filter("lines", lambda x: _trimmed(x) != ""))
    out = both.select("row", kept.alias("kept_text"), counted.alias("n_lines"), F.coalesce(n, F.lit(0)).alias("n_removed"))
    return out.select("row.*", "kept_text", "n_lines", "n_removed")
