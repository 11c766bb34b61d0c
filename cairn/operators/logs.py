"""Call-log and audit-log analytics. Durations are DECIMAL so that sums don't depend on the order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairn.functions.expr import signature
from cairn.operators.filters import in_window


def call_summary(log: DataFrame, low=None, high=None) -> DataFrame:
    """Calls, time, attempts, retries and errors by service and operation, of a window if both bounds are given."""
    log = log if low is None or high is None else in_window(log, "Ts", low, high)
    return log.groupBy("Service", "Operation").agg(
        F.count("*").alias("calls"), F.sum("DurationS").alias("total_s"), F.sum("Attempts").alias("attempts"),
        (F.sum("Attempts") - F.count("*")).alias("retries"), F.sum(F.when(F.col("Outcome") == "error", 1).otherwise(0)).alias("errors"),
    )


def log_extent(log: DataFrame) -> DataFrame:
    return log.agg(F.min("Ts").alias("first_ts"), F.max("Ts").alias("last_ts"))


def call_share(log: DataFrame) -> DataFrame:
    """Each operation's share of all time, and of its time the share of calls that were retried.

    The total is over one row an operation, not over the log.
    """
    per = log.groupBy("Service", "Operation").agg(F.sum("DurationS").alias("total_s"), F.sum(F.when(F.col("Attempts") > 1, F.col("DurationS")).otherwise(0)).alias("retried_s"))
    total = F.sum("total_s").over(Window.partitionBy())
    share = lambda a, b: F.when(b != 0, F.round(a.cast("double") / b.cast("double"), 6))
    return per.select("Service", "Operation", "total_s", share(F.col("total_s"), total).alias("share"), share(F.col("retried_s"), F.col("total_s")).alias("retried_share"))


def error_summary(log: DataFrame) -> DataFrame:
    """Errors by signature, most first."""
    return log.where("Outcome = 'error'").groupBy(signature(F.col("ErrorCode"), F.col("Message")).alias("signature")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "signature")


def first_errors(log: DataFrame) -> DataFrame:
    """When and where each distinct error occurred first."""
    first = F.min(F.struct("Ts", "Service", "Operation", "Profile", "Region")).alias("f")
    return log.where("Outcome = 'error'").groupBy(signature(F.col("ErrorCode"), F.col("Message")).alias("signature")).agg(first).select("signature", "f.*")


def fanout_outcome(log: DataFrame) -> DataFrame:
    """Calls, failed ones and whether the run was clean, by session; a session with any error is partial."""
    bad = F.sum(F.when(F.col("Outcome") == "error", 1).otherwise(0))
    return log.groupBy("Profile", "Region").agg(F.count("*").alias("calls"), bad.alias("errored"), (bad == 0).alias("clean"))


def is_clean(log: DataFrame) -> bool:
    return log.where("Outcome = 'error'").isEmpty()


def run_stats(results: DataFrame) -> DataFrame:
    """One row of counters over rows (kind, failed): tasks, calls, objects, prefixes, splits, abandons, failures."""
    kinds = {"tasks": "task", "calls": "call", "objects": "object", "prefixes": "prefix", "splits": "split", "abandons": "abandon"}
    return results.agg(*(F.count(F.when(F.col("kind") == k, 1)).alias(n) for n, k in kinds.items()), F.count(F.when(F.col("failed"), 1)).alias("failures"))


def count_by_type(tables: list[DataFrame]) -> DataFrame:
    """Records by ``meta.type`` over all tables; each is counted by itself first."""
    out = None
    for t in tables:
        one = t.groupBy(F.col("meta.type").alias("type")).agg(F.count("*").alias("n"))
        out = one if out is None else out.union(one)
    return out.groupBy("type").agg(F.sum("n").alias("n"))


def audit_summary(audit: DataFrame) -> DataFrame:
    """Runs, seconds, seconds saved and failures by cache outcome."""
    return audit.groupBy("Cache").agg(F.count("*").alias("runs"), F.sum("DurationS").alias("total_s"), F.sum("SavedS").alias("saved_s"), F.count(F.when(F.col("ExitCode") != 0, 1)).alias("failures"))


def overlap_check(log: DataFrame, key: str = "Service") -> DataFrame:
    """First and last call of each key, by start, and whether one starts before its predecessor has ended.

    The window without partitions runs over one row a key.
    """
    spans = log.groupBy(key).agg(F.min("Ts").alias("starts"), F.max("Ts").alias("ends"))
    return spans.withColumn("overlaps", F.col("starts") < F.lag("ends").over(Window.partitionBy().orderBy("starts", key)))


def name_collisions(members: DataFrame, keys: list[str]) -> DataFrame:
    """For each key: members of just that name, members that differ in case only, and services with either."""
    low = F.create_map(*(F.lit(x) for k in keys for x in (k.lower(), k)))
    hit = members.withColumn("key", F.try_element_at(low, F.lower("member"))).where("key is not null")
    return hit.groupBy("key").agg(F.count(F.when(F.col("member") == F.col("key"), 1)).alias("exact"), F.count(F.when(F.col("member") != F.col("key"), 1)).alias("near"), F.countDistinct("service").alias("services"))


def collision_totals(members: DataFrame, keys: list[str]) -> DataFrame:
    """One row: services, and how many (and percent) have an exact, a near or either collision."""
    exact = F.col("member").isin(keys)
    near = ~exact & F.lower("member").isin([k.lower() for k in keys])
    per = members.groupBy("service").agg(F.max(exact).alias("exact"), F.max(near).alias("near"))
    n = lambda test: F.count(F.when(test, 1))
    out = per.agg(F.count("*").alias("services"), n(F.col("exact")).alias("exact"), n(F.col("near")).alias("near"), n(F.col("exact") | F.col("near")).alias("either"))
    return out.withColumn("either_percent", F.round(F.lit(100.0) * F.col("either").cast("double") / F.col("services").cast("double"), 2))


def collision_topk(members: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k services with most exact hits."""
    return members.where(F.col("member").isin(keys)).groupBy("service").agg(F.count("*").alias("hits")).orderBy(F.desc("hits"), "service").limit(k)


def collision_spelling(members: DataFrame, keys: list[str]) -> DataFrame:
    """Near misses by spelling."""
    near = F.lower("member").isin([k.lower() for k in keys]) & ~F.col("member").isin(keys)
    return members.where(near).groupBy("member").agg(F.count("*").alias("n"), F.countDistinct("service").alias("services"))
