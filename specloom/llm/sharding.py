"""Reproducible shuffle into shards: a Feistel permutation with cycle walking over row numbers.

Rows get gapless numbers in a content order; a keyed Feistel network over the next even power of two,
walked until the value falls below the row count, permutes the numbers. Shard is the permuted number
modulo the shard count and slot the quotient, so both can be computed from a number alone, and a
number from (shard, slot), without touching the data.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from specloom.llm.joins import without
from specloom.session import stable

ROUNDS = 6
SEED = 0x5EED
# Distinct rows for each numbering window; the number of windows is bounded by MAX_BUCKETS.
BUCKET_ROWS = 20_000
MAX_BUCKETS = 1 << 16
# Copies of one row that are numbered by one array.
COPIES = 4096
# Beyond so many copies of one row, its chunks of numbers are spread over all tasks.
SPREAD_COPIES = 100_000


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Feistel:
    """A keyed permutation of 0 .. n-1."""

    def __init__(self, n: int, seed: int = SEED, rounds: int = ROUNDS):
        if n < 0:
            raise ValueError("n must not be negative")
        self.n = n
        self.half = np.uint64(max(1, ((max(n, 2) - 1).bit_length() + 1) // 2))
        self.mask = (np.uint64(1) << self.half) - np.uint64(1)
        with np.errstate(over="ignore"):
            self.keys = _mix(np.uint64(seed) + np.arange(1, rounds + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def _round(self, right: np.ndarray, key: np.uint64) -> np.ndarray:
        with np.errstate(over="ignore"):
            return _mix(right + key) & self.mask

    def _once(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in self.keys:
            left, right = right, left ^ self._round(right, key)
        return (left << self.half) | right

    def _once_back(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in self.keys[::-1]:
            left, right = right ^ self._round(left, key), left
        return (left << self.half) | right

    def _walk(self, x, step) -> np.ndarray:
        x = np.asarray(x, dtype=np.uint64)
        if x.size and int(x.max()) >= self.n:
            raise ValueError("row number beyond the row count")
        y = step(x)
        while (out := y >= np.uint64(self.n)).any():
            y[out] = step(y[out])
        return y.astype(np.int64)

    def forward(self, numbers) -> np.ndarray:
        return self._walk(numbers, self._once)

    def backward(self, places) -> np.ndarray:
        return self._walk(places, self._once_back)


def locate(numbers, n: int, shards: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(shard, slot) of row numbers out of n rows."""
    place = Feistel(n, seed).forward(numbers)
    return place % shards, place // shards


def number_at(shard, slot, n: int, shards: int, seed: int = SEED) -> np.ndarray:
    """Row number that stands at (shard, slot); the inverse of `locate`."""
    return Feistel(n, seed).backward(np.asarray(slot, dtype=np.int64) * shards + np.asarray(shard, dtype=np.int64))


def number_rows(rows: DataFrame, name: str = "row_number") -> tuple[DataFrame, int]:
    """All rows with a gapless number from 0, and their count.

    The order is a hash bucket of the whole row, then its columns, so it depends on the rows alone and
    not on partitions. Equal rows are counted before the shuffle and numbered as one, so a row that
    makes up a third of the input is one row here; nulls are values like others. An empty frame gives
    an empty frame.
    """
    # The input row is one struct until the end, so no name of it meets a working name.
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row")
    groups = stable(rows.select(row).groupBy("row").agg(F.count(F.lit(1)).alias("_copies")))
    total, distinct, most = groups.agg(F.sum("_copies"), F.count(F.lit(1)), F.max("_copies")).first()
    buckets = max(1, min(MAX_BUCKETS, -(-distinct // BUCKET_ROWS)))
    groups = groups.withColumn("_bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)))
    # At most MAX_BUCKETS rows pass the window without a key, and they are what is broadcast.
    sizes = groups.groupBy("_bucket").agg(F.sum("_copies").alias("_n"))
    starts = sizes.select("_bucket", (F.sum("_n").over(Window.orderBy("_bucket")) - F.col("_n")).alias("_start"))
    inside = Window.partitionBy("_bucket").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    placed = groups.withColumn("_before", F.sum("_copies").over(inside) - F.col("_copies")).join(F.broadcast(starts), "_bucket")
    first = F.col("_start") + F.col("_before")
    chunks = placed.select("row", first.alias("_first"), "_copies", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(_copies - 1) div {COPIES}"))).alias("_chunk"))
    if (most or 0) > SPREAD_COPIES:
        chunks = chunks.repartition("_first", "_chunk")
    low = F.col("_chunk") * COPIES
    numbers = F.sequence(F.col("_first") + low, F.col("_first") + F.least(low + COPIES, F.col("_copies")) - 1)
    numbered = chunks.select("row", F.explode(numbers).alias("_number"))
    return numbered.select("row.*", F.col("_number").alias(name)), int(total or 0)


def feistel_shards(rows: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """Every row with `row_number`, `shard` (0 .. shards-1) and `slot` (gapless from 0 in its shard).

    Shard sizes differ by at most one row. Input columns of these names are left out, also from the
    order that numbers the rows.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    rows = without(rows, "row_number", "shard", "slot")
    numbered, n = number_rows(rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row")))

    @F.pandas_udf("bigint")
    def place(numbers: pd.Series) -> pd.Series:
        return pd.Series(Feistel(n, seed).forward(numbers.to_numpy()))

    at = numbered.withColumn("_place", place("row_number"))
    return at.select("row.*", "row_number", F.pmod("_place", F.lit(shards)).cast("int").alias("shard"), F.expr(f"_place div {shards}").alias("slot"))
