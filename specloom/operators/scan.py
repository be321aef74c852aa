"""Ordered analytics inside a key that stay parallel when one key is huge.

A window partitioned by a key sends the whole key to one task. That is the best plan while keys
are small, so it is what runs by default. When a count shows a key above the limit, the rows are
range-partitioned on (key, order) instead, each range becomes a chunk, the window runs inside
chunks, and one summary row per chunk carries the running state across chunk borders.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from specloom.session import hot_rows, stable

CHUNK = "_chunk"
# Rows of a task in which many ordered passes follow each other: each pass sorts them anew. With fewer, the
# code that every task compiles takes longer than its rows.
PASS_ROWS = 300_000


@dataclass(frozen=True)
class Step:
    """One running value: the kind of state and the expression it runs over."""

    kind: str
    expr: Column


def running_sum(expr: Column) -> Step:
    """Sum of all rows up to and including the current one."""
    return Step("sum", expr)


def running_min(expr: Column) -> Step:
    return Step("min", expr)


def max_before(expr: Column) -> Step:
    """Largest value of the rows before the current one."""
    return Step("max_before", expr)


def position() -> Step:
    """0-based position in the key."""
    return Step("position", F.lit(1))


def previous(expr: Column) -> Step:
    """Value on the row before (null on the first)."""
    return Step("previous", expr)


def following(expr: Column) -> Step:
    """Value on the row after (null on the last)."""
    return Step("following", expr)


def last_known(expr: Column) -> Step:
    """Last non-null value up to and including the current row."""
    return Step("last", expr)


def next_known(expr: Column) -> Step:
    """First non-null value from the current row on."""
    return Step("next", expr)


def has_hot_key(df: DataFrame, keys: Sequence[str], limit: int | None = None) -> bool:
    """True if some key has more rows than the limit (counts combine map-side)."""
    limit = hot_rows(df.sparkSession) if limit is None else limit
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return (counts.agg(F.max("n").alias("most")).first()["most"] or 0) > limit


def hot_keys(df: DataFrame, keys: Sequence[str], limit: int | None = None) -> DataFrame | None:
    """The keys above the limit as a small table, or None: at most one key for every `limit` rows."""
    if not has_hot_key(df, keys, limit):
        return None
    limit = hot_rows(df.sparkSession) if limit is None else limit
    return stable(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > limit).select(*keys))


def run(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    steps: dict[str, Step],
    *,
    hot: bool | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Add one column per step, ordered by `order` inside `keys`.

    `order` must be free of ties for a reproducible result. `hot` skips the count when the caller
    already knows the answer.
    """
    limit = hot_rows(df.sparkSession) if limit is None else limit
    if hot is None:
        hot = has_hot_key(df, keys, limit)
    if not hot:
        return df.withColumns({name: _in_window(s, list(keys), list(order)) for name, s in steps.items()})
    return _run_chunked(df, list(keys), list(order), steps, limit)


def dealt(df: DataFrame, keys: Sequence[str], rows: int, most: int = PASS_ROWS) -> DataFrame:
    """The frame dealt by its keys for many ordered passes; `rows` is about how many rows it has.

    A partition for each core, and more where a task would get over `most` of them. The number is never that of
    the session: Spark drops an exchange that deals rows like the join before it, and adaptive execution then
    merges the partitions of that join by their bytes, which say little about the passes to come.
    """
    session = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(min(session, df.sparkSession.sparkContext.defaultParallelism), math.ceil(rows / most))
    return df.repartition(parts + 1 if parts == session else parts, *keys)


def totals(df: DataFrame, keys: Sequence[str], aggs: dict[str, Column], *, hot: bool | None = None) -> DataFrame:
    """Add aggregates over the whole key to every row.

    An unordered window while keys are small; with a hot key the aggregate (combined map-side) is
    joined back, and the join may be split by adaptive execution.
    """
    if hot is None:
        hot = has_hot_key(df, keys)
    if not hot:
        win = Window.partitionBy(*keys)
        return df.withColumns({name: agg.over(win) for name, agg in aggs.items()})
    return df.join(df.groupBy(*keys).agg(*[agg.alias(name) for name, agg in aggs.items()]), list(keys))


def _in_window(step: Step, keys: list[str], order: list[str]) -> Column:
    win = Window.partitionBy(*keys).orderBy(*order)
    upto = win.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    match step.kind:
        case "sum":
            return F.sum(step.expr).over(upto)
        case "min":
            return F.min(step.expr).over(upto)
        case "max_before":
            return F.max(step.expr).over(win.rowsBetween(Window.unboundedPreceding, -1))
        case "position":
            return F.row_number().over(win) - 1
        case "previous":
            return F.lag(step.expr).over(win)
        case "following":
            return F.lead(step.expr).over(win)
        case "last":
            return F.last(step.expr, ignorenulls=True).over(upto)
        case "next":
            # a frame up to the end of the key is recomputed for every row; the same frame in
            # reverse order only grows
            back = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
            return F.last(step.expr, ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    raise ValueError(f"unknown step {step.kind}")


def range_chunks(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int) -> DataFrame:
    """Tag rows with a chunk number that grows with (keys, order); written once, so it is stable."""
    parts = max(2, math.ceil(df.count() / max(rows, 1)))
    ranged = df.repartitionByRange(parts, *keys, *order)
    return stable(ranged.withColumn(CHUNK, F.spark_partition_id()))


def _run_chunked(df, keys, order, steps, limit) -> DataFrame:
    values = {f"_v_{name}": s.expr for name, s in steps.items()}
    chunked = range_chunks(df.withColumns(values), keys, order, limit)
    inside = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    local = {name: _in_window(Step(s.kind, F.col(f"_v_{name}")), [*keys, CHUNK], order) for name, s in steps.items()}
    rows = chunked.withColumns({f"_l_{name}": expr for name, expr in local.items()})
    rows = rows.withColumns(
        {
            f"_e_{name}": (F.lag if s.kind == "previous" else F.lead)(F.lit(True)).over(inside)
            for name, s in steps.items()
            if s.kind in ("previous", "following")
        }
    )

    at = F.struct(*order)
    summary = chunked.groupBy(*keys, CHUNK).agg(
        *[_chunk_summary(s.kind, F.col(f"_v_{name}"), at).alias(f"_s_{name}") for name, s in steps.items()]
    )
    across = Window.partitionBy(*keys).orderBy(CHUNK)
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*keys).orderBy(F.col(CHUNK).desc()).rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(
        *keys,
        CHUNK,
        *[_carry(s.kind, F.col(f"_s_{name}"), across, before, after).alias(f"_c_{name}") for name, s in steps.items()],
    )
    joined = rows.join(carry, [*keys, CHUNK])
    out = {name: _combine(s.kind, name) for name, s in steps.items()}
    keep = [c for c in df.columns if c not in out]
    return joined.select(*keep, *[expr.alias(name) for name, expr in out.items()])


def _chunk_summary(kind: str, value: Column, at: Column) -> Column:
    match kind:
        case "sum" | "position":
            return F.sum(value)
        case "min":
            return F.min(value)
        case "max_before":
            return F.max(value)
        case "previous":
            return F.max_by(F.struct(value.alias("v")), at)
        case "following":
            return F.min_by(F.struct(value.alias("v")), at)
        case "last":
            return F.max(F.when(value.isNotNull(), F.struct(at.alias("at"), value.alias("v"))))
        case "next":
            return F.min(F.when(value.isNotNull(), F.struct(at.alias("at"), value.alias("v"))))
    raise ValueError(f"unknown step {kind}")


def _carry(kind: str, state: Column, across, before, after) -> Column:
    match kind:
        case "sum" | "position":
            return F.sum(state).over(before)
        case "min":
            return F.min(state).over(before)
        case "max_before":
            return F.max(state).over(before)
        case "previous":
            return F.lag(state["v"]).over(across)
        case "following":
            return F.lead(state["v"]).over(across)
        case "last":
            return F.last(state["v"], ignorenulls=True).over(before)
        case "next":
            return F.last(state["v"], ignorenulls=True).over(after)
    raise ValueError(f"unknown step {kind}")


def _combine(kind: str, name: str) -> Column:
    local, carry = F.col(f"_l_{name}"), F.col(f"_c_{name}")
    match kind:
        case "sum":
            return F.when(carry.isNull(), local).when(local.isNull(), carry).otherwise(local + carry)
        case "position":
            return (local + F.coalesce(carry, F.lit(0))).cast("int")
        case "min":
            return F.least(local, carry)
        case "max_before":
            return F.greatest(local, carry)
        case "previous" | "following":
            return F.when(F.col(f"_e_{name}"), local).otherwise(carry)
        case "last" | "next":
            return F.coalesce(local, carry)
    raise ValueError(f"unknown step {kind}")


def ordered_text(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    text: str,
    sep: str,
    aggs: dict[str, Column] | None = None,
    *,
    hot: bool | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Concatenate `text` in `order` inside `keys`; null texts are left out.

    `aggs` may add associative aggregates (min, max) whose input columns carry the output names.
    A hot key is first concatenated range by range, so no task ever holds its rows.
    """
    aggs = aggs or {}
    limit = hot_rows(df.sparkSession) if limit is None else limit
    if hot is None:
        hot = has_hot_key(df, keys, limit)

    def gather(rows: DataFrame, by: list[str], at: list[str]) -> DataFrame:
        pieces = F.array_sort(F.collect_list(F.struct(*at, F.col(text).alias("_text"))))
        texts = F.transform(pieces, lambda p: p["_text"])
        # null while nothing is there to join, so a later join leaves it out
        joined = F.when(F.exists(texts, lambda t: t.isNotNull()), F.array_join(texts, sep))
        return rows.groupBy(*by).agg(joined.alias(text), *[a.alias(n) for n, a in aggs.items()])

    pieces = gather(range_chunks(df, keys, order, limit), [*keys, CHUNK], list(order)) if hot else df
    return gather(pieces, list(keys), [CHUNK] if hot else list(order)).fillna("", [text])
