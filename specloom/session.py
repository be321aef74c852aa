"""Session-level settings shared by all operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# A key with more rows than this is cut into range chunks before a window runs over it.
HOT_ROWS = 200_000
# A side is broadcast only after a bounded count proved it has at most this many rows.
BROADCAST_ROWS = 100_000

_HOT_CONF = "specloom.hotRows"
_BROADCAST_CONF = "specloom.broadcastRows"


def hot_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(_HOT_CONF, str(HOT_ROWS)))


def broadcast_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(_BROADCAST_CONF, str(BROADCAST_ROWS)))


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach; taken from the session, never machine-local on a cluster."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    local = tempfile.mkdtemp(prefix="specloom-")
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def stable(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint, so recomputed tasks see the same rows."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """The same for rows that a loop joins again and again: they are written as a table and read back. A
    checkpoint keeps Spark's estimate of its size, the product of those of the tables joined, whose digits
    multiply with each turn until they fill the driver; a table has the size of its files."""
    path = f"{shared_dir(df.sparkSession)}/turn-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
