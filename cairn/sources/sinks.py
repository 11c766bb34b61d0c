"""Writers: JSON lines, raw values, snapshots, several sinks from one source, and files by column."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cairn.sources import store

#: Times keep their microseconds, with and without a zone.
TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def write_jsonl(df: DataFrame, path: str, compression: str = "none", mode: str = "error") -> None:
    """An object a line, times as text; null fields are left out."""
    df.write.mode(mode).options(**TIMES).option("compression", compression).json(path)


def write_counted(df: DataFrame, path: str, kinds: dict[str, Column], mode: str = "error") -> dict[str, int]:
    """As ``write_jsonl``; gives the rows for which each condition holds, and ``lines``, counted by the job that writes them."""
    seen = Observation()
    counts = (F.count(F.when(test, 1)).alias(name) for name, test in kinds.items())
    write_jsonl(df.observe(seen, F.count(F.lit(1)).alias("lines"), *counts), path, mode=mode)
    return seen.get


def write_values(df: DataFrame, column: str, path: str, mode: str = "error") -> None:
    """One column's values, a line each."""
    df.select(df[column].cast("string").alias("value")).where("value is not null").write.mode(mode).text(path)


def save_snapshot(df: DataFrame, path: str) -> store.Stored:
    """The whole table replaced, for ``store.read``; saving it again changes nothing, and a write that fails
    leaves the old table."""
    return store.replace(df, path)


def tee(df: DataFrame, sinks: dict[str, Callable[[DataFrame], None]]) -> None:
    """One computed source for several sinks."""
    kept = df.persist()
    try:
        for write in sinks.values():
            write(kept)
    finally:
        kept.unpersist()


def write_partitioned(df: DataFrame, by: str, path: str, mode: str = "error") -> None:
    """A folder of JSON lines for each value of ``by``. Spark splits a value with many rows over files."""
    df.write.mode(mode).partitionBy(by).options(**TIMES).json(path)
