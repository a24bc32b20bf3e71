"""The commit point of a warehouse: numbered versions, each a small JSON file
that names one file manifest per table.

Data files are never changed: a write goes to a folder of its own
(``data/_write=<id>``), and a manifest, JSON too, lists the files that make up the
table then, with their rows, bytes and first and last day: what Spark's driver
lists to plan a read anyway, a few hundred bytes per data file. A version is
published by renaming a finished file to the next number, which fails if another
run has taken that number; readers open the highest number. Until then a run's
files are seen by that run alone, whatever becomes of it.

The rename must be atomic, as on HDFS and local file systems; an object store
needs a committer or a catalog of its own.
"""

from __future__ import annotations

import json
import os
import uuid
from collections import namedtuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path

File = namedtuple("File", "file write month rows bytes first_day last_day undated")


def read_json(spark: SparkSession, path: str):
    system, p = shared_path(spark, path)
    stream = system.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_json(spark: SparkSession, path: str, content) -> None:
    system, p = shared_path(spark, path)
    out = system.create(p)
    out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    out.close()


class LostRace(RuntimeError):
    """Another run has published since this one began."""


class Versions:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.folder = os.path.join(root, "_versions")

    def numbers(self) -> list[int]:
        """Published versions, oldest first."""
        system, path = shared_path(self.spark, self.folder)
        if not system.exists(path):
            return []
        names = [str(s.getPath().getName()) for s in system.listStatus(path)]
        return sorted(int(n) for n in names if n.isdigit())

    def load(self, number: int | None = None) -> dict:
        """A version, the newest by default; version 0 has no tables."""
        number = number if number is not None else max(self.numbers(), default=0)
        if number == 0:
            return {"version": 0, "tables": {}}
        return read_json(self.spark, f"{self.folder}/{number:08d}")

    def publish(self, base: int, tables: dict) -> int:
        """Make ``tables`` the version after ``base``."""
        jvm = self.spark.sparkContext._jvm
        number = base + 1
        draft = f"{self.folder}/.draft-{uuid.uuid4().hex}"
        write_json(self.spark, draft, {"version": number, "tables": tables})
        system, path = shared_path(self.spark, draft)
        _, final = shared_path(self.spark, f"{self.folder}/{number:08d}")
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            system.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        plain = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            files.rename(path, final, plain)  # never replaces a file
        except Py4JJavaError as e:
            system.delete(path, False)
            if "FileAlreadyExists" in str(e.java_exception.getClass()):
                raise LostRace(f"version {number} of {self.root} is taken; run again from the newest") from e
            raise
        return number

    def forget(self, number: int) -> None:
        system, path = shared_path(self.spark, f"{self.folder}/{number:08d}")
        system.delete(path, False)


def manifest_rows(data: DataFrame, write: str, day) -> DataFrame:
    """One row per file of a freshly written folder, from one narrow scan."""
    month = F.col("_month").cast("string") if "_month" in data.columns else F.lit(None).cast("string")
    rows = data.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"),
                       month.alias("month"), day.alias("day"))
    found = rows.groupBy("path", "size", "month").agg(
        F.count(F.lit(1)).alias("rows"), F.min("day").alias("first_day"), F.max("day").alias("last_day"),
        F.count_if(F.col("day").isNull()).alias("undated"))
    # kept relative to the table's data folder, as the writer named it
    return found.select(F.regexp_extract("path", r"(_write=[^/]+/.*)$", 1).alias("file"), F.lit(write).alias("write"), "month",
                        "rows", F.col("size").alias("bytes"), "first_day", "last_day", "undated")
