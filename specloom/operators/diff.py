"""Comparing two outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def diff_cells(old: DataFrame, new: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Cells added, removed or changed; equal cells are left out."""
    a = old.select(*keys, F.struct(F.col(value).alias("v")).alias("_a"))
    b = new.select(*keys, F.struct(F.col(value).alias("v")).alias("_b"))
    both = a.join(b, list(keys), "full_outer")
    status = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").otherwise("changed")
    differing = both.filter(~F.col("_a").eqNullSafe(F.col("_b")))
    return differing.select(*keys, F.col("_a.v").alias("old_value"), F.col("_b.v").alias("new_value"), status.alias("status"))


def key_difference(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys found only in A, only in B, or in both, in one aggregation."""
    a = left.select(*keys, F.lit(1).alias("a"), F.lit(0).alias("b"))
    b = right.select(*keys, F.lit(0).alias("a"), F.lit(1).alias("b"))
    seen = a.unionByName(b).groupBy(*keys).agg(F.max("a").alias("a"), F.max("b").alias("b"))
    side = F.when(F.col("b") == 0, "a").when(F.col("a") == 0, "b").otherwise("both")
    return seen.select(*keys, side.alias("side"))


def unconfigured(artefacts: DataFrame, configs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Artefacts without a configuration and configurations without an artefact."""
    only = key_difference(artefacts, configs, keys).filter("side <> 'both'")
    return only.withColumn("side", F.when(F.col("side") == "a", "no_config").otherwise("no_artefact"))
