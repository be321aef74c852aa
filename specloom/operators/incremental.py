"""Which work is stale: manifests, inherited options, artefact times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specloom.operators.joins import lookup_join, shuffled

# Fixed value: a download older than this is fetched again.
MAX_AGE_DAYS = 84
GROUP = ["stem", "grp"]


def split_bad(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """Rows without and with a reason to set them aside."""
    marked = df.withColumn("reason", reason)
    return marked.filter("reason IS NULL").drop("reason"), marked.filter("reason IS NOT NULL")


def stage_list(manifest: DataFrame, infos: str = "infos") -> DataFrame:
    """A stage given as a list of option maps becomes one row per entry, in order."""
    return manifest.select("*", F.posexplode(infos).alias("seq", "opts")).drop(infos)


def inherit_defaults(manifest: DataFrame, defaults: DataFrame) -> DataFrame:
    """Options of a stage: the named default overlaid by the stage's own keys.

    The overlay is shallow, and an own key that is present with null still wins. A name without
    default is reported in `reason`.
    """
    named = defaults.select("stem", "stage", F.col("name").alias("inherit"), F.col("opts").alias("_base"))
    joined = lookup_join(manifest, named, ["stem", "stage", "inherit"], how="left")
    own_keys = F.map_keys("opts")
    missing = F.map_filter("_base", lambda k, _: ~F.array_contains(own_keys, k))
    merged = F.when(F.col("_base").isNull(), F.col("opts")).otherwise(F.map_concat(missing, F.col("opts")))
    lost = F.col("inherit").isNotNull() & F.col("_base").isNull()
    reason = F.when(lost, F.concat(F.lit("no default named "), "inherit"))
    return joined.withColumns({"merged": merged, "reason": reason}).drop("_base", "opts").withColumnRenamed("merged", "opts")


def manifest_filter(manifest: DataFrame, condition: str | None) -> DataFrame:
    """Keep work for which a SQL condition over stem, grp, stage and properties holds."""
    return manifest if condition is None else manifest.filter(F.expr(condition))


def stage_times(artefacts: DataFrame) -> DataFrame:
    """Newest and oldest file of each stage."""
    return artefacts.groupBy(*GROUP, "stage").agg(F.max("mtime").alias("newest"), F.min("mtime").alias("oldest"))


def stale_by_age(items: DataFrame, artefacts: DataFrame, now: Column, *, force: bool = False) -> DataFrame:
    """Items with no download yet, or one older than the allowed age."""
    have = artefacts.filter("stage = 'download'").groupBy(*GROUP, "filename").agg(F.max("mtime").alias("mtime"))
    oldest = now - F.expr(f"INTERVAL {MAX_AGE_DAYS} DAYS")
    stale = F.lit(True) if force else F.col("mtime").isNull() | (F.col("mtime") < oldest)
    return items.join(shuffled(have), [*GROUP, "filename"], "left").filter(stale)


def stale_by_source(artefacts: DataFrame, source: str, target: str, *, force: bool = False) -> DataFrame:
    """Files whose target is missing or older than the source; one aggregation, no self join."""
    times = artefacts.filter(F.col("stage").isin(source, target)).groupBy(*GROUP, "filename").agg(
        F.max(F.when(F.col("stage") == source, F.col("mtime"))).alias("source_time"),
        F.max(F.when(F.col("stage") == target, F.col("mtime"))).alias("target_time"),
    )
    have = times.filter("source_time IS NOT NULL")
    return have if force else have.filter("target_time IS NULL OR target_time < source_time")


def stage_state(artefacts: DataFrame, manifests: DataFrame, source: str, target: str) -> DataFrame:
    """Per group: `run`, `skip`, or `error` when there is no input.

    A stage is skipped only if every input and the manifest are strictly older than every output.
    """
    times = artefacts.filter(F.col("stage").isin(source, target)).groupBy(*GROUP).agg(
        F.max(F.when(F.col("stage") == source, F.col("mtime"))).alias("newest_in"),
        F.min(F.when(F.col("stage") == target, F.col("mtime"))).alias("oldest_out"),
    )
    timed = lookup_join(times, manifests.select("stem", "manifest_time"), ["stem"], how="left")
    fresh = F.greatest("newest_in", "manifest_time") < F.col("oldest_out")
    state = F.when(F.col("newest_in").isNull(), "error").when(fresh, "skip").otherwise("run")
    return timed.withColumn("state", state)


def stale_stage(artefacts: DataFrame, manifests: DataFrame, source: str, target: str, *, force: bool = False) -> DataFrame:
    """Groups whose target is older than its source or manifest; with `force` all that have a source."""
    state = stage_state(artefacts, manifests, source, target)
    return state.filter("state <> 'error'" if force else "state = 'run'")
