"""One-dimensional clustering of sorted values inside a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specloom.operators import scan
from specloom.session import hot_rows, stable

# A run of distinct values longer than this is not folded as an array.
FOLD_VALUES = 1_000


def merge_adjacent(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    carried: dict[str, Column],
    joins_previous,
    *,
    name: str = "cluster_id",
    hot: bool | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Number runs of consecutive rows in which each row belongs with the one before it.

    `carried` names expressions of a row that the next row may look at; `joins_previous` maps the
    columns of the row before (same names) to a condition.
    """
    if hot is None:
        hot = scan.has_hot_key(df, keys, limit)
    before = {f"_p_{n}": scan.previous(e) for n, e in carried.items()}
    marked = scan.run(df, keys, order, {**before, "_pos": scan.position()}, hot=hot, limit=limit)
    joined = F.coalesce(joins_previous({n: F.col(f"_p_{n}") for n in carried}), F.lit(False))
    starts = F.when((F.col("_pos") > 0) & ~joined, 1).otherwise(0)
    out = scan.run(marked, keys, order, {name: scan.running_sum(starts)}, hot=hot, limit=limit)
    return out.drop("_pos", *before)


def cluster_gap(df: DataFrame, keys: Sequence[str], value: str, tie: Sequence[str], eps: float, **options) -> DataFrame:
    """A new cluster starts where the gap to the value before is above eps."""
    near = lambda prev: F.abs(F.col(value) - prev[value]) <= eps
    return merge_adjacent(df, keys, [value, *tie], {value: F.col(value)}, near, **options)


def cluster_equal(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str], **options) -> DataFrame:
    """Runs of equal values in the given order."""
    return merge_adjacent(df, keys, order, {value: F.col(value)}, lambda prev: F.col(value).eqNullSafe(prev[value]), **options)


def cluster_anchor(df: DataFrame, keys: Sequence[str], value: str, eps: float, *, limit: int | None = None) -> DataFrame:
    """A new cluster starts where the gap to the *first* value of the cluster is above eps.

    Rows with equal values fall together, and a gap above eps always starts a cluster, so the
    clusters follow from the distinct values of each gap run. A run short enough is folded as an
    array; longer runs are solved by pointer doubling, so no task ever holds one.
    """
    keys = list(keys)
    limit = hot_rows(df.sparkSession) if limit is None else limit
    values = df.select(*keys, value).distinct()
    runs = cluster_gap(values, keys, value, [], eps, name="_run", limit=limit)
    if scan.has_hot_key(runs, [*keys, "_run"], min(limit, FOLD_VALUES)):
        starts = _starts_by_doubling(runs, keys, value, eps, limit)
    else:
        starts = _starts_by_fold(runs, keys, value, eps)
    marks = starts.withColumn("_new", F.lit(1))
    marked = values.join(marks, [*keys, value], "left")
    numbered = scan.run(marked, keys, [value], {"_n": scan.running_sum(F.coalesce("_new", F.lit(0)))}, limit=limit)
    clusters = numbered.select(*keys, value, (F.col("_n") - 1).alias("cluster_id"))
    return df.join(clusters, [*keys, value])


def _starts_by_fold(runs: DataFrame, keys: list[str], value: str, eps: float) -> DataFrame:
    """First values of the clusters of each run, by one pass over its sorted values."""
    seen = F.array_sort(F.collect_set(value))

    def step(acc: Column, v: Column) -> Column:
        return F.when((F.size(acc) == 0) | (v - F.element_at(acc, -1) > eps), F.concat(acc, F.array(v))).otherwise(acc)

    kind = runs.schema[value].dataType.simpleString()
    empty = F.array().cast(f"array<{kind}>")
    folded = runs.groupBy(*keys, "_run").agg(F.reduce(seen, empty, step).alias("_starts"))
    return folded.select(*keys, F.explode("_starts").alias(value))


def _starts_by_doubling(runs: DataFrame, keys: list[str], value: str, eps: float, limit: int) -> DataFrame:
    """Every value points to the first value more than eps above it; the clusters' first values are
    those reached from the first value of the run. Jumps are doubled until nothing new is reached."""
    run_keys = [*keys, "_run"]
    around = {"_p1": scan.previous(F.col(value)), "_n1": scan.following(F.col(value))}
    near = scan.run(runs, run_keys, [value], around, limit=limit)
    node = near.select(*run_keys, F.col(value).alias("_pos"), F.lit(1).alias("_kind"), F.col(value).alias("_from"), "_p1", "_n1")
    ask = node.select(*run_keys, (F.col("_pos") + eps).alias("_pos"), F.lit(2).alias("_kind"), "_from", "_p1", "_n1")
    at = F.when(F.col("_kind") == 1, F.struct("_p1", "_from", "_n1"))
    both = scan.run(node.unionByName(ask), run_keys, ["_pos", "_kind", "_from"], {"_lo": scan.last_known(at), "_hi": scan.next_known(at)}, limit=limit)
    # The sum above is rounded; whether a value is far enough is decided by the difference, as in the
    # fold, among the values on either side of it.
    beside = F.array("_lo._p1", "_lo._from", "_hi._from", "_hi._n1")
    both = both.withColumn("_to", F.get(F.filter(beside, lambda v: v - F.col("_from") > eps), F.lit(0)))
    jump = stable(both.filter("_kind = 2 and _to is not null").select(*run_keys, "_from", "_to"))
    reached = stable(runs.groupBy(*run_keys).agg(F.min(value).alias("_at")))
    known = reached.count()
    while True:
        step = jump.withColumnRenamed("_from", "_at")
        ahead = reached.join(step, [*run_keys, "_at"]).select(*run_keys, F.col("_to").alias("_at"))
        reached = stable(reached.unionByName(ahead).distinct())
        total = reached.count()
        if total == known:
            return reached.select(*keys, F.col("_at").alias(value))
        known = total
        onward = jump.select(*run_keys, F.col("_from").alias("_to"), F.col("_to").alias("_far"))
        jump = stable(jump.join(onward, [*run_keys, "_to"]).select(*run_keys, "_from", F.col("_far").alias("_to")))
