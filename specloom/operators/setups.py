"""Which devices can take the panels that fit: strings of panels against typed device ranges.

A voltage meets the ranges that hold it by an equi join: a range is entered into the one or two bins of
its own order of magnitude that it covers, and a voltage is looked up once for each order of magnitude
that occurs, so neither wide nor narrow ranges multiply. Equal panels and equal devices are one class each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specloom.session import stable

# The smallest bin is 2**LEAST_LEVEL wide.
LEAST_LEVEL = -20


def _bin(value: Column, level: Column) -> Column:
    return F.floor(value / F.pow(F.lit(2.0), level))


def in_range(points: DataFrame, ranges: DataFrame, at: str, low: str, high: str) -> DataFrame:
    """Every (point, range) with low <= at <= high. Nulls, NaN and ranges that end before they begin fit
    nothing."""
    good = ranges.where(f"{low} <= {high} and not isnan({low}) and not isnan({high}) and abs({low}) < double('infinity') and abs({high}) < double('infinity')")
    level = F.greatest(F.ceil(F.log2(F.greatest(F.col(high) - F.col(low), F.pow(F.lit(2.0), F.lit(LEAST_LEVEL))))), F.lit(LEAST_LEVEL)).cast("int")
    leveled = stable(good.withColumn("_level", level))
    levels = [r[0] for r in leveled.select("_level").distinct().collect()]  # one for each power of two of a double
    entered = leveled.withColumn("_bin", F.explode(F.array_distinct(F.array(_bin(F.col(low), F.col("_level")), _bin(F.col(high), F.col("_level"))))))
    seen = points.where(f"{at} is not null and not isnan({at}) and abs({at}) < double('infinity')")
    seen = seen.withColumn("_level", F.explode(F.lit(levels).cast("array<int>"))).withColumn("_bin", _bin(F.col(at), F.col("_level")))
    met = seen.join(entered, ["_level", "_bin"]).where(F.col(at).between(F.col(low), F.col(high)))
    return met.drop("_level", "_bin")


def strings(panels: DataFrame) -> DataFrame:
    """The ways to wire `pieces` panels as equal strings: series, parallel, and the volts and amperes they
    give, of (pieces, volts, amps) each once."""
    kinds = panels.where("pieces > 0").select("pieces", "volts", "amps").distinct()
    each = kinds.withColumn("series", F.explode(F.filter(F.sequence(F.lit(1).cast("bigint"), F.col("pieces")), lambda s: F.col("pieces") % s == 0)))
    wired = each.withColumn("parallel", F.expr("pieces div series"))
    return wired.withColumns({"string_volts": F.col("series") * F.col("volts"), "string_amps": F.col("parallel") * F.col("amps")})


def setups(panels: DataFrame, devices: DataFrame) -> DataFrame:
    """(pieces, volts, amps, v_min, v_max, i_max, n_devices, device_id, series, parallel): the panel and
    device classes that go together, each in its longest strings.

    panels: panel_id, pieces, volts and amps of one panel; devices: device_id, v_min, v_max, i_max. The
    voltage of a string lies in the device's range and the current of all strings is at most `i_max`;
    `device_id` is the smallest of the class. Devices with a null range fit nothing.
    """
    kinds = devices.where("i_max is not null").groupBy("v_min", "v_max", "i_max").agg(F.count(F.lit(1)).alias("n_devices"), F.min("device_id").alias("device_id"))
    met = in_range(strings(panels), kinds, "string_volts", "v_min", "v_max").where("string_amps <= i_max")
    keys = ["pieces", "volts", "amps", "v_min", "v_max", "i_max"]
    longest = met.groupBy(*keys).agg(F.max(F.struct("series", "parallel", "n_devices", "device_id")).alias("s"))
    return longest.select(*keys, "s.n_devices", "s.device_id", "s.series", "s.parallel")


def best_setups(panels: DataFrame, devices: DataFrame) -> DataFrame:
    """Per panel: how many devices take it, and the one with the fewest strings, then the narrowest upper
    limits; `n_devices` 0 and nulls where there is none."""
    classes = ["pieces", "volts", "amps"]
    pick = F.min(F.struct("parallel", "v_max", "i_max", "v_min", "series", "device_id")).alias("s")
    best = setups(panels, devices).groupBy(*classes).agg(F.sum("n_devices").alias("n_devices"), pick)
    named = panels.join(best, classes, "left")
    return named.select("panel_id", F.coalesce("n_devices", F.lit(0).cast("bigint")).alias("n_devices"), "s.device_id", "s.series", "s.parallel")
