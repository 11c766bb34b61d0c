"""Streams: shaping, enrichment against a table, several sinks, running totals, bad records set aside, and keyed values that expire."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cairn.operators.logs import call_summary
from cairn.sources.lines import CALL_LOG, split_lines


def read_json_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).json(path)


def shape_stream(pages: DataFrame, *steps: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The batch operators in order: stamp, filter, fetch tags. All are stateless."""
    for step in steps:
        pages = step(pages)
    return pages


def enrich_stream(records: DataFrame, tag_table: DataFrame, keys: list[str]) -> DataFrame:
    """A stream left-joined with a table of tags, one row a key."""
    one = tag_table.groupBy(*keys).agg(F.max_by("tags", F.size("tags")).alias("__t"))
    empty = F.create_map().cast("map<string,string>")
    return records.join(one, keys, "left").withColumn("tags", F.when(F.coalesce(F.size("tags"), F.lit(0)) > 0, F.col("tags")).otherwise(F.coalesce("__t", empty))).drop("__t")


def write_stream(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """All that is there now, as JSON lines, exactly once."""
    return df.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def tee_stream(df: DataFrame, sinks: dict[str, Callable[[DataFrame], DataFrame]], path: str, checkpoint: str) -> StreamingQuery:
    """Each micro-batch, computed once, to a folder for each sink; a batch that is run again replaces itself."""

    def put(batch: DataFrame, number: int) -> None:
        kept = batch.persist()
        for name, transform in sinks.items():
            transform(kept).write.mode("overwrite").json(f"{path}/{name}/batch={number}")
        kept.unpersist()

    return df.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def running_counts(df: DataFrame, by: str) -> DataFrame:
    """Totals by kind while results flow; for output mode complete."""
    return df.groupBy(by).agg(F.count("*").alias("n"))


def tail_call_log(spark: SparkSession, path: str) -> DataFrame:
    """The call summary over a log that grows; for output mode complete."""
    return call_summary(read_json_stream(spark, path, CALL_LOG))


def contain(lines: DataFrame, shape: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Lines that are no JSON objects go to ``bad``, the others shaped to ``good``; the stream goes on."""

    def put(batch: DataFrame, number: int) -> None:
        good, bad = split_lines(batch)
        shape(good).write.mode("overwrite").json(f"{path}/good/batch={number}")
        bad.write.mode("overwrite").text(f"{path}/bad/batch={number}")

    return lines.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_values_stream(log: DataFrame, ttl: float) -> DataFrame:
    """Changes (key, value, ts, gone) of the newest value of each key of a stream (key, value, ts in seconds): a row for a key
    whose newest value has changed, or has become older than the TTL.

    The newest time in the stream stands for now. A value that comes late counts if it is the newest of its key and isn't too
    old by then; empty keys and values don't count, and of equal times the greater value does. State is one value a key, and goes when it expires.
    """
    rows = log.where("key <> '' and value <> '' and ts is not null").select("key", "value", "ts", F.timestamp_millis(F.floor(F.col("ts") * 1000).cast("long")).alias("at"))
    # older ones are left out before they come here; Spark leaves out those at the watermark too, so it stands behind the oldest that counts
    rows = rows.withWatermark("at", f"{math.ceil(ttl * 1000) + 1} milliseconds")
    return rows.groupBy("key").applyInPandasWithState(_newest, "key string, value string, ts double, gone boolean", "value string, ts double", "update", GroupStateTimeout.EventTimeTimeout)


def _newest(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    if state.hasTimedOut:
        value, ts = state.get
        state.remove()
        yield pd.DataFrame([(key[0], value, ts, True)], columns=["key", "value", "ts", "gone"])
        return
    had = (state.get[1], state.get[0]) if state.exists else None
    best = had
    for f in frames:
        top = max(zip(f["ts"].tolist(), f["value"].tolist(), strict=True), default=best)
        best = top if best is None or (top is not None and top > best) else best
    state.update((best[1], best[0]))
    state.setTimeoutTimestamp(max(math.floor(best[0] * 1000) - 1, state.getCurrentWatermarkMs() + 1))
    if best != had:
        yield pd.DataFrame([(key[0], best[1], best[0], False)], columns=["key", "value", "ts", "gone"])


def keep_changes(changes: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Each micro-batch's changes as a folder of their own; a batch that is run again replaces it."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return changes.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def kept_values(spark: SparkSession, path: str, ttl: float) -> DataFrame:
    """The values (key, value, ts) that count after all changes so far: what the last micro-batch made too old goes too."""
    rows = spark.read.schema("key string, value string, ts double, gone boolean, batch long").parquet(path)
    newest = rows.agg(F.max("ts")).first()[0]
    last = rows.groupBy("key").agg(F.max_by(F.struct("value", "ts", "gone"), "batch").alias("c"))
    return last.where(~F.col("c.gone") & (F.col("c.ts") >= F.lit(newest) - ttl)).select("key", "c.value", "c.ts")
