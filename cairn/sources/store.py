"""Stored tables that are replaced as a whole: a reader sees the old rows or the new ones, and a failed write changes nothing.

A folder holds runs, each a folder of Parquet files, and a small file ``_current`` that names the run that counts. A
write goes to a new run; only when it has ended is the name replaced, by one atomic rename. The run before it stays until the next
write, for readers that began with it.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CURRENT = "_current"


@dataclass(frozen=True)
class Stored:
    """What a write has stored, counted by the job that wrote it."""

    run: str
    lines: int
    bytes: int


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _put(spark: SparkSession, folder: str, text: str) -> None:
    """``_current`` of the folder with this text, by a rename that replaces the old file."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    fs, aside = _at(spark, f"{folder}/.{CURRENT}-{uuid.uuid4().hex}")
    out = fs.create(aside)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    kind = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE
    # the checksum files of local file systems belong to the name, so the plain interface replaces the file
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(aside).toUri(), conf).rename(fs.makeQualified(aside), fs.makeQualified(_at(spark, f"{folder}/{CURRENT}")[1]), how)


def current_run(spark: SparkSession, folder: str) -> str | None:
    """The folder of the run that counts, if there is one."""
    fs, where = _at(spark, f"{folder}/{CURRENT}")
    if not fs.exists(where):
        return None
    file = fs.open(where)
    try:
        return f"{folder}/{spark._jvm.org.apache.commons.io.IOUtils.toString(file, 'UTF-8')}"
    finally:
        file.close()


def replace(df: DataFrame, folder: str) -> Stored:
    """Store ``df`` as the folder's table. If the write fails, its files go and the stored table is as before."""
    spark, name, seen = df.sparkSession, f"run-{uuid.uuid4().hex}", Observation()
    before = current_run(spark, folder)
    fs, run = _at(spark, f"{folder}/{name}")
    try:
        df.observe(seen, F.count(F.lit(1)).alias("lines")).write.parquet(f"{folder}/{name}")
        size = fs.getContentSummary(run).getLength()
        _put(spark, folder, name)
    except BaseException:
        fs.delete(run, True)
        raise
    keep = {name, (before or "").rsplit("/", 1)[-1]}
    for f in fs.listStatus(_at(spark, folder)[1]):
        if f.getPath().getName().startswith("run-") and f.getPath().getName() not in keep:
            fs.delete(f.getPath(), True)
    return Stored(f"{folder}/{name}", seen.get["lines"], size)


def read(spark: SparkSession, folder: str, schema: str | None = None) -> DataFrame:
    """The folder's table as it is now; without a stored one an empty table of ``schema``, if that is given."""
    run = current_run(spark, folder)
    if run is None:
        if schema is None:
            raise FileNotFoundError(f"no stored table in {folder}")
        return spark.createDataFrame([], schema)
    return (spark.read.schema(schema) if schema else spark.read).parquet(run)
