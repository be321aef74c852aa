"""Size of the batches in which texts go to Python workers, and what the workers keep afterwards."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import SparkSession

_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
# Spark's own number, and the one used for texts, of which a few rows make a batch large enough.
DEFAULT_ROWS = "10000"
TEXT_ROWS = "500"


def text_batches() -> None:
    """Lowers the session's rows in an Arrow batch for jobs over texts, unless the session has a number of
    its own: batches of ten thousand texts take hundreds of MB beside the heap of an executor."""
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.conf.get(_ROWS, DEFAULT_ROWS) == DEFAULT_ROWS:
        spark.conf.set(_ROWS, TEXT_ROWS)


def trimmed(batches: Iterator) -> Iterator:
    """The batches of a task; after the last, memory that is free goes back to the system, as the worker
    lives on beside those of later stages."""
    yield from batches
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
