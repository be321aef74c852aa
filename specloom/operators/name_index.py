"""Substring lookup of names among the fragments of their sheet, by an index of short pieces.

Every fragment is entered under its whole text and under the pieces of it that some name of its sheet asks
for. A name that stands as a whole text is settled by counting; any other is looked up under the rarest
of its own pieces, and the fragments found there are compared with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specloom.operators.joins import lookup_join, shuffled
from specloom.session import stable

# Characters of a piece; shorter names are entered as they are.
PIECE = 3

# What is entered begins with one of these: a whole text, or a piece.
_WHOLE, _PIECE = "=", "~"


def _pieces(text: Column, size: Column) -> Column:
    places = F.sequence(F.lit(1), F.char_length(text) - size + 1)
    return F.when(F.char_length(text) >= size, F.transform(places, lambda i: F.concat(F.lit(_PIECE), F.substring(text, i, size)))).otherwise(F.array().cast("array<string>"))


def _whole(text: Column) -> Column:
    return F.concat(F.lit(_WHOLE), text)


def find_names(fragments: DataFrame, names: DataFrame, keep: list[str]) -> DataFrame:
    """(sheet_id, name, n_exact, n_any, box) of each (sheet_id, name) that occurs: how many fragments of the
    sheet have it as text, how many contain it (counted only if `n_exact` is not 1), and as a struct of
    frag_id and `keep` the one exact fragment, else one that contains it. Null names and texts find nothing.
    """
    names = names.select("sheet_id", "name").where("name is not null").distinct()
    size = F.least(F.char_length("name"), F.lit(PIECE))
    asked = names.select("sheet_id", "name", F.explode(F.array_distinct(F.concat(F.array(_whole(F.col("name"))), _pieces(F.col("name"), size)))).alias("piece"))
    asked = stable(asked)
    # Pieces of one and two characters, and the empty one, are entered only where a name is that short.
    sizes = [r[0] for r in asked.where(F.startswith("piece", F.lit(_PIECE))).select(F.char_length("piece") - 1).distinct().collect()]
    entered = F.array_distinct(F.concat(F.array(_whole(F.col("text"))), *[_pieces(F.col("text"), F.lit(s)) if s else F.array(F.lit(_PIECE)) for s in sizes]))
    box = F.struct("frag_id", *keep)
    sheets = asked.select("sheet_id").distinct()
    ours = lookup_join(fragments.where("text is not null"), sheets, ["sheet_id"], how="left_semi")
    entries = ours.select("sheet_id", "text", box.alias("box"), F.explode(entered).alias("piece"))
    found = stable(lookup_join(entries, asked.select("sheet_id", "piece").distinct(), ["sheet_id", "piece"], how="left_semi"))

    often = found.groupBy("sheet_id", "piece").agg(F.count(F.lit(1)).alias("n"), F.min("box").alias("box"))
    counted = asked.join(shuffled(often), ["sheet_id", "piece"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    whole = F.startswith("piece", F.lit(_WHOLE))
    rarest = F.min(F.when(~whole, F.struct("n", "piece")))
    each = counted.groupBy("sheet_id", "name").agg(F.max(F.when(whole, F.col("n"))).alias("n_exact"), F.max(F.when(whole, F.col("box"))).alias("exact"), rarest.alias("low"))
    each = stable(each)
    # A piece that no fragment has rules the name out.
    open_ = each.where("n_exact <> 1 and low.n > 0").select("sheet_id", "name", "low.piece")
    holds = F.contains("text", F.col("name"))
    hits = lookup_join(found, open_, ["sheet_id", "piece"], holds).groupBy("sheet_id", "name").agg(F.count(F.lit(1)).alias("n_any"), F.min("box").alias("any"))
    done = each.join(shuffled(hits), ["sheet_id", "name"], "left").where("n_exact > 0 or n_any > 0")
    return done.select("sheet_id", "name", "n_exact", "n_any", F.when(F.col("n_exact") == 1, F.col("exact")).otherwise(F.col("any")).alias("box"))
