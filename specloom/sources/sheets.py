"""Stored wide sheets: reading, writing, and the column-wise JSON form."""

from __future__ import annotations

import math
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from specloom.operators import scan
from specloom.session import written

HEADER = "section,property"
# Files that one task writes, about: a file takes far longer than the rows in it.
TASK_FILES = 1000
# The folder of what one task writes, and how many of them are listed and read at a time: the driver holds an
# entry for each file that it lists.
FOLDER = "batch"
READ_FOLDERS = 100
# Settings while they are read: what a file counts for, besides its bytes, when files are dealt to tasks, and that
# folders are listed by tasks, one folder each.
READING = {"spark.sql.files.openCostInBytes": str(128 << 10), "spark.sql.sources.parallelPartitionDiscovery.threshold": "0"}
# Hadoop's local file system starts a process for each folder, file and checksum file, to set its permissions; the
# raw one has no checksum files. Other file systems are not concerned.
RAW_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def sheet_schema(columns: int) -> T.StructType:
    names = ["section", "property", *[f"col:{i}" for i in range(columns)]]
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def widest(spark: SparkSession, path: str | list[str]) -> int:
    """Largest number of value columns of any sheet, from the first line of each file."""
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(path)
    heads = lines.filter(F.col("value").startswith(HEADER)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value"
    )
    first = heads.groupBy("file").agg(F.min_by("value", F.struct("block", "at")).alias("head"))
    return first.agg(F.max(F.size(F.split("head", ",")) - 2).alias("n")).first()["n"] or 0


def read_sheets(spark: SparkSession, path: str, columns: int | None = None, *, multi_line: bool = True, hot: bool | None = None) -> DataFrame:
    """Every sheet under a folder, one file each: sheet_id, row_idx, section, property, col:0...

    Columns are read by position, so files with fewer columns are padded with null. Fields may hold
    line breaks, so a file is read by one task; where none does, `multi_line=False` splits a large file
    between tasks: rows are numbered inside each split, the splits put in order by their start. `hot` skips the pass
    over all files that asks whether one is too large for a task, when the caller already knows. What `write_sheets`
    wrote is read some folders at a time, and at once; other trees are listed as a whole.
    """
    batches = _folders(spark, path)
    if columns is None:
        columns = max(widest(spark, b) for b in batches or [path])
    reader = spark.read.schema(sheet_schema(columns)).option("header", True).option("recursiveFileLookup", True)
    reader = reader.option("pathGlobFilter", "*.csv").option("multiLine", multi_line)
    placed = _stored(spark, (_placed(reader.csv(b)) for b in batches)) if batches else _placed(reader.csv(path))
    ordered = scan.run(placed, ["sheet_id"], ["_block", "_at"], {"row_idx": scan.position()}, hot=hot)
    return ordered.drop("_block", "_at")


def _placed(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("_metadata.file_path").alias("sheet_id"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
        *[F.col(f"`{c}`") for c in raw.columns],
    )


def _folders(spark: SparkSession, path: str) -> list[list[str]]:
    """The folders that `write_sheets` made under a path, READ_FOLDERS at a time; none if there is anything else."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    fs = make(path).getFileSystem(spark._jsc.hadoopConfiguration())
    own = fs.globStatus(make(f"{path.rstrip('/')}/{FOLDER}=*")) or []
    visible = fs.globStatus(make(f"{path.rstrip('/')}/[^_.]*")) or []
    if not len(own) or len(own) != len(visible):
        return []
    names = sorted(x.getPath().toString() for x in own)
    return [names[i : i + READ_FOLDERS] for i in range(0, len(names), READ_FOLDERS)]


def _stored(spark: SparkSession, frames: Iterable[DataFrame]) -> DataFrame:
    """Rows of many small files as a table, one frame after another, so that the driver holds the files of one."""
    parts, before = [], {k: spark.conf.get(k) for k in READING}
    try:
        for k, v in READING.items():
            spark.conf.set(k, v)
        for df in frames:
            parts.append(written(df))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return reduce(DataFrame.unionByName, parts)


def write_sheets(wide: DataFrame, path: str, by: list[str]) -> None:
    """Wide sheets as CSV below one folder per key; rows of a sheet stay in order.

    The tasks are cut by the number of files: cut by bytes, as adaptive execution does, a few of them would
    write all the files, as sheets are small. What a task writes is in one folder of its own, so the job is committed
    by moving a folder for each task.
    """
    values = [F.col(f"`{c}`") for c in wide.columns if c.startswith("col:")]
    files = wide.select(*by).distinct().count()
    parts = max(wide.sparkSession.sparkContext.defaultParallelism, math.ceil(files / TASK_FILES))
    dealt = wide.withColumn(FOLDER, F.pmod(F.xxhash64(*by), F.lit(parts)).cast("int")).repartitionById(parts, F.col(FOLDER))
    ordered = dealt.sortWithinPartitions(FOLDER, *by, "row_idx")
    ordered.select(FOLDER, *by, "section", "property", *values).write.partitionBy(FOLDER, *by).options(**RAW_FILES).option("header", True).csv(path)


def column_json(cells: DataFrame) -> DataFrame:
    """One record per model column: {idx, props: {section: {property: value}}}. Of a repeated property
    the last row counts, the largest value where rows have no number."""
    last = F.max_by("value", "row_idx") if "row_idx" in cells.columns else F.max("value")
    cells = cells.groupBy("sheet_id", "col_idx", "section", "property").agg(last.alias("value"))
    by_section = cells.groupBy("sheet_id", "col_idx", F.coalesce("section", F.lit("")).alias("section")).agg(
        F.map_from_entries(F.collect_list(F.struct("property", "value"))).alias("attrs")
    )
    return by_section.groupBy("sheet_id", F.col("col_idx").alias("idx")).agg(F.map_from_entries(F.collect_list(F.struct("section", "attrs"))).alias("props"))


def write_records(records: DataFrame, path: str, by: list[str]) -> None:
    """Typed records as JSON, nulls kept; appends, existing files are never replaced."""
    records.write.mode("append").partitionBy(*by).option("ignoreNullFields", False).json(path)


PRICE_SCHEMA = T.StructType(
    [
        T.StructField("watts", T.DoubleType()),
        T.StructField("w", T.IntegerType()),
        T.StructField("h", T.IntegerType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("extra", T.StringType()),
    ]
)
TABLE_JSON_SCHEMA = T.ArrayType(
    T.StructType([T.StructField("data", T.ArrayType(T.ArrayType(T.StructType([T.StructField("text", T.StringType())]))))])
)


def read_prices(spark: SparkSession, path: str) -> DataFrame:
    """Price lists without header: watts, width, height, price, one ignored column."""
    return spark.read.schema(PRICE_SCHEMA).csv(path)


def read_table_json(spark: SparkSession, path: str, suffix: str = "*.json") -> DataFrame:
    """Nested block/line/cell files, one document each: doc_id, blocks."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", suffix).text(path, wholetext=True)
    blocks = F.from_json("value", TABLE_JSON_SCHEMA)
    return files.select(F.col("_metadata.file_path").alias("doc_id"), blocks.alias("blocks"))


def read_table_records(spark: SparkSession, path: str) -> DataFrame:
    """The same as records, one document per line: doc_id, specset, blocks."""
    fields = [T.StructField("doc_id", T.StringType()), T.StructField("specset", T.StringType()), T.StructField("blocks", TABLE_JSON_SCHEMA)]
    return spark.read.schema(T.StructType(fields)).json(path)


def read_artefacts(spark: SparkSession, path: str, suffix: str | None = None) -> DataFrame:
    """Files of a tree with change time and size; file contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    return reader.load(path).select("path", F.col("modificationTime").alias("mtime"), F.col("length").alias("bytes"))


def artefact_key(path: Column) -> Column:
    """<...>/stem/group/stage/filename.ext as struct."""
    parts = F.split(path, "/")
    name = F.element_at(parts, -1)
    return F.struct(
        F.element_at(parts, -4).alias("stem"),
        F.element_at(parts, -3).alias("grp"),
        F.element_at(parts, -2).alias("stage"),
        F.regexp_replace(name, r"\.[^.]*$", "").alias("filename"),
        F.regexp_extract(name, r"\.([^.]*)$", 1).alias("ext"),
    )
