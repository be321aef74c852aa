"""Records that are published batch by batch, each record once.

A run writes its batch into a folder of its own and then publishes it by one numbered commit file. Readers
see only batches that a commit names, so a run that dies halfway leaves nothing visible. Commit numbers
are taken exclusively: of two runs that reach for one number the later is refused, reads what the other
has published, takes those records out of its batch and tries the next number. The first writer of a
record therefore wins against whatever really is in the folder.

Layout: `<root>/batches/<id>/records` (JSON), `<root>/batches/<id>/groups` (parquet: the work that the batch
has done) and `<root>/commits/<number>` (one line of JSON).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Store:
    """A folder of published records.

    `keys` name a record, `by` the work it belongs to (columns that records and groups share). The folder's
    file system must rename without replacing, as HDFS does; on local files a hard link does the same.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], by: Sequence[str]):
        self.spark, self.root = spark, root.rstrip("/")
        self.schema, self.keys, self.by = schema, list(keys), list(by)
        self.groups_schema = T.StructType([schema[c] for c in self.by] + [T.StructField("done_at", T.TimestampType())])
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(f"{self.root}/commits"))

    # ---- commits --------------------------------------------------------------

    def commits(self, start: int = 0) -> list[str]:
        """Ids of the published batches in the order of their commits, from a number on: a few bytes each."""
        names = sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.root}/commits")))
        paths = [f"{self.root}/commits/{n}" for n in names if n.isdigit() and int(n) >= start]
        if not paths:
            return []
        lines = self.spark.read.schema("n long, batch string").json(paths).orderBy("n").collect()
        return [r["batch"] for r in lines]

    def _commit(self, number: int, batch: str) -> bool:
        """Publishes a batch under a number; False if the number is taken."""
        target = f"{self.root}/commits/{number:020d}"
        own = self._path(f"{self.root}/batches/{batch}/commit")
        out = self._fs.create(own, True)
        out.write(bytearray((json.dumps({"n": number, "batch": batch}) + "\n").encode()))
        out.close()
        jvm = self.spark._jvm
        try:
            if self._fs.getUri().getScheme() == "file":
                files, local = jvm.java.nio.file.Files, lambda p: jvm.java.io.File(p.toUri().getPath()).toPath()
                files.createLink(local(self._path(target)), local(own))
                return True
            return self._fs.rename(own, self._path(target))
        except Py4JJavaError as e:
            if "AlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise

    # ---- contents --------------------------------------------------------------

    def _read(self, batches: Sequence[str], part: str) -> DataFrame:
        paths = [f"{self.root}/batches/{b}/{part}" for b in batches]
        if not paths:
            return self.spark.createDataFrame([], self.schema if part == "records" else self.groups_schema)
        return self.spark.read.schema(self.schema).json(paths) if part == "records" else self.spark.read.schema(self.groups_schema).parquet(*paths)

    def records(self) -> DataFrame:
        return self._read(self.commits(), "records")

    def groups(self) -> DataFrame:
        """Work done so far with the time of its last run."""
        done = self._read(self.commits(), "groups")
        return done.groupBy(*self.by).agg(F.max("done_at").alias("done_at"))

    # ---- runs ----------------------------------------------------------------

    def publish(self, records: DataFrame, groups: DataFrame, *, retries: int = 100) -> int:
        """Publishes those of the records that no commit holds yet, the first of each key, and the groups
        (columns `by` and done_at) as done; the number of records written.

        Nulls in keys are values. Nothing new and no group done: nothing is written.
        """
        batch = uuid.uuid4().hex
        seen = self.commits()
        self._write(records, groups, batch, seen)
        number = len(seen)
        for _ in range(retries):
            n = self._read([batch], "records").count()
            if not n and self._read([batch], "groups").isEmpty():
                return 0
            if self._commit(number, batch):
                return n
            # Another run was first: its records go out of a new batch.
            later = self.commits(number)
            old, batch = batch, uuid.uuid4().hex
            self._write(self._read([old], "records"), self._read([old], "groups"), batch, later)
            number += len(later)
        raise RuntimeError(f"no free commit number after {retries} tries")

    def _write(self, records: DataFrame, groups: DataFrame, batch: str, against: Sequence[str]) -> None:
        names = [f.name for f in self.schema.fields]
        rest = [c for c in names if c not in self.keys]
        # One record for each key, whichever sorts first; keys compare as a struct, so nulls are values.
        key = F.struct(*self.keys).alias("_key")
        each = records.select(key, F.struct(*rest).alias("_rest")) if rest else records.select(key, F.lit(1).alias("_rest"))
        one = each.groupBy("_key").agg(F.min("_rest").alias("_rest"))
        known = self._read(against, "records").select(key)
        fresh = one.join(known, "_key", "left_anti")
        flat = fresh.select("_key.*", "_rest.*") if rest else fresh.select("_key.*")
        path = f"{self.root}/batches/{batch}"
        flat.select(*names).write.option("ignoreNullFields", False).json(f"{path}/records")
        groups.select(*[F.col(c).cast(self.groups_schema[c].dataType).alias(c) for c in [*self.by, "done_at"]]).write.parquet(f"{path}/groups")

    def run(self, work: DataFrame, make: Callable[[DataFrame], DataFrame], now=None) -> int:
        """One run of a stage: the groups of `work` (columns `by` and input_time) that were never done, or
        whose input is not older than their last run, go through `make`, and what it returns is published.
        A run over work that is all done writes nothing.
        """
        same = reduce(lambda a, b: a & b, [F.col(f"w.{c}").eqNullSafe(F.col(f"d.{c}")) for c in self.by])
        joined = work.alias("w").join(self.groups().alias("d"), same, "left")
        due = joined.where("d.done_at is null or d.done_at <= w.input_time").select("w.*")
        if due.isEmpty():
            return 0
        done = due.select(*self.by).distinct().withColumn("done_at", F.current_timestamp() if now is None else now)
        return self.publish(make(due), done)
