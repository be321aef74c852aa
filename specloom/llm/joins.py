"""Broadcasts behind a check of their size in bytes, and keys of whole rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 48 << 20
# A fixed-width column of a hashed row, with its share of pointers and hash table.
CELL_BYTES = 16


def broadcast_if_small(df: DataFrame, *arrays: str, bytes_each: int = 0, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The frame marked for broadcast if its cells, counting those of the named arrays, and `bytes_each`
    more a row take at most `limit` bytes; else as it is, for a shuffled join. Callers pass frames that
    are cheap to read twice."""
    cells = F.lit(len(df.columns))
    for a in arrays:
        cells = cells + F.coalesce(F.size(a), F.lit(0))
    size = df.agg(F.sum(cells * CELL_BYTES + bytes_each).alias("bytes")).first().bytes or 0
    return F.broadcast(df) if size <= limit else df


def shuffled(df: DataFrame) -> DataFrame:
    """A side of a join that may be as large as the data, so that it is never broadcast on the small size of
    its files."""
    return df.hint("merge")


def row_key(*columns: Column) -> list[Column]:
    """Two 64-bit hashes that stand for the values, nulls included, in an equi join or grouping."""
    return [F.xxhash64(F.lit(1), *columns).alias("k1"), F.xxhash64(F.lit(2), *reversed(columns)).alias("k2")]


def without(df: DataFrame, *names: str) -> DataFrame:
    """The frame without columns of these names, whatever their case."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])
