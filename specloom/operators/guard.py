"""Errors that stop a job instead of being set aside.

The guard is part of the plan, so the job fails in the task that meets the first bad row, and a sink that
commits at the end of its job (Spark's own writers, `Store.publish`) leaves nothing that a reader sees.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How errors are met: bad values are set aside, lose their sheet, or stop the run.
QUARANTINE, DROP, STOP = ON_ERROR = ("quarantine", "drop", "stop")


def stop_on(df: DataFrame, reason: Column) -> DataFrame:
    """The frame as it is; reading a row with a reason fails the job with it.

    The number of the partition, which is never negative, keeps the optimizer from moving the condition below a join or
    filter that has taken bad rows away.
    """
    passed = F.when(reason.isNotNull() & (F.spark_partition_id() > -1), F.raise_error(reason).cast("boolean")).otherwise(F.lit(True))
    return df.filter(passed)


def stop_on_rejects(records: DataFrame, rejects: DataFrame, message: Column) -> DataFrame:
    """The records, in a plan that fails if there is any reject. Reading a reject is what fails, so none of
    them ever gets past this point."""
    failing = stop_on(rejects, F.coalesce(message, F.lit("rejected")))
    return records.unionByName(failing.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in records.schema.fields]))
