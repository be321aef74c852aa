"""Joins whose small side is checked before it is broadcast."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specloom.session import broadcast_rows

SALTS = 32


def at_most(df: DataFrame, rows: int) -> bool:
    """One distributed count; a limit before it would send many rows through a single task."""
    return df.count() <= rows


def shuffled(df: DataFrame) -> DataFrame:
    """A side of a join that may be as large as the data, so that it is never broadcast on an estimate: for
    files of repeated values, and for rows that were multiplied, Spark's estimate is far too low."""
    return df.hint("merge")


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    condition: Column | None = None,
    how: str = "inner",
    *,
    limit: int | None = None,
    small_rows: int | None = None,
) -> DataFrame:
    """Equi join with an optional residual condition; `how` is inner, left, left_semi or left_anti.

    A small side of checked size is broadcast, so the big side is not shuffled. Beyond the bound
    the small side is repeated over salts and the big side is spread over them, so one hot key is
    shared by many tasks. `small_rows` is given when the size is known without counting.
    """
    on = list(on)
    limit = broadcast_rows(big.sparkSession) if limit is None else limit
    if small_rows <= limit if small_rows is not None else at_most(small, limit):
        return _equi(big, small, on, condition, how, F.broadcast)
    spread = big.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in _hashable(big)]), F.lit(SALTS)))
    repeated = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
    return _equi(spread, repeated, [*on, "_salt"], condition, how, shuffled).drop("_salt")


def pair_join(big: DataFrame, small: DataFrame, on: Sequence[str], condition: Column | None = None, *, hot: DataFrame) -> DataFrame:
    """Inner equi join with an optional residual condition of two sides that may both be as large as the data:
    a row of either is shuffled once. Only for the keys in `hot`, a table of few rows that names those with many
    rows on the big side, the small side is repeated over salts. `hot` is read several times."""
    on = list(on)
    if hot.isEmpty():
        return _equi(big, small, on, condition, "inner", shuffled)
    only = lambda side, how: lookup_join(side, hot, on, how=how, small_rows=0, limit=0)
    spread = lookup_join(only(big, "left_semi"), only(small, "left_semi"), on, condition, small_rows=1, limit=0)
    return spread.unionByName(_equi(only(big, "left_anti"), only(small, "left_anti"), on, condition, "inner", shuffled))


def _hashable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if "map" not in f.dataType.simpleString()]


def _equi(left: DataFrame, right: DataFrame, on: list[str], condition: Column | None, how: str, sent: Callable[[DataFrame], DataFrame]) -> DataFrame:
    right = sent(right.select(*[F.col(f"`{c}`").alias(f"_r_{c}" if c in on else c) for c in right.columns]))
    cond = F.col(on[0]) == F.col(f"_r_{on[0]}")
    for c in on[1:]:
        cond = cond & (F.col(c) == F.col(f"_r_{c}"))
    if condition is not None:
        cond = cond & condition
    return left.join(right, cond, how).drop(*[f"_r_{c}" for c in on])
