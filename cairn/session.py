"""A session with the settings that nested inventory data needs."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.caseSensitive": "true",  # sibling fields such as Arn and ARN occur
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.chunkBase64String.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build(master: str | None = None, **more: str) -> SparkSession:
    """A session with SETTINGS and ``more``; the master is the submitter's unless one is given."""
    builder = SparkSession.builder.config(map=SETTINGS | more)
    return (builder.master(master) if master else builder).getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``, a folder that all executors share.

    Only a local master may go without: it gets a temporary one.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        where = spark.conf.get("spark.checkpoint.dir", None)
        if not where and not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(where or tempfile.mkdtemp(prefix="spark-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` with ``checkpoint()`` in the shared folder, so that later reads survive lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
