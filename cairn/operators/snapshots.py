"""Snapshot reuse by age, upsert plans and keyed caches, over plain tables. Times are seconds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.functions.expr import age_text, hash_key, or_else
from cairn.operators.seal import key_column, opened
from cairn.sources import store


def snapshot_key(*columns: Column) -> Column:
    """The key of everything that shapes a result."""
    return hash_key(*columns)


def reuse_snapshot(requests: DataFrame, snapshots: DataFrame, ttl: int) -> DataFrame:
    """Each request (key, at) with the newest snapshot (key, created) before it: hit within the TTL, else stale or miss."""
    made = snapshots.select("key", F.col("created").alias("at"), F.col("created").alias("__created"))
    both = requests.withColumn("__asks", F.lit(1)).unionByName(made.withColumn("__asks", F.lit(0)), allowMissingColumns=True)
    newest = F.max("__created").over(Window.partitionBy("key").orderBy("at", "__asks").rowsBetween(Window.unboundedPreceding, 0))
    out = both.withColumn("created", newest).where("__asks = 1").drop("__asks", "__created").withColumn("age", F.col("at") - F.col("created"))
    return out.withColumn("decision", F.when(F.col("age").isNull(), "miss").when(F.col("age") <= ttl, "hit").otherwise("stale"))


def sweep(snapshots: DataFrame, now: float, everything: bool = False) -> DataFrame:
    """The snapshots that stay: those that haven't expired, or none. A snapshot without an expiry has expired."""
    return snapshots.where(F.lit(not everything) & F.coalesce(F.col("expires") > now, F.lit(False)))


def list_snapshots(snapshots: DataFrame, now: float, program: str = "cairn") -> DataFrame:
    """A catalogue of snapshots (key, created, expires, argv, lines, bytes, encrypted, duration): age and time to expiry
    in words, and the command as it was typed. Columns that aren't there count as null, an unknown time as now."""
    own = lambda c, kind: F.col(c).cast(kind) if c in snapshots.columns else F.lit(None).cast(kind)
    at = F.lit(float(now))
    age, left = at - F.coalesce(own("created", "double"), at), F.coalesce(own("expires", "double"), at) - at
    command = F.concat_ws(" ", F.lit(program), own("argv", "array<string>"))
    return snapshots.select(
        "key", command.alias("command"), age_text(age).alias("age"), age_text(F.greatest(left, F.lit(0.0))).alias("expires_in"), own("lines", "long").alias("lines"),
        F.coalesce(own("bytes", "long"), F.lit(0)).alias("bytes"), F.coalesce(own("encrypted", "boolean"), F.lit(False)).alias("encrypted"), own("duration", "double").alias("duration"),
    )


ENTRY = "key string, created double, expires double, argv array<string>, duration double, lines long, bytes long, encrypted boolean"


def commit_if_clean(df: DataFrame, clean: bool, path: str) -> bool:
    """Store a complete run, for ``store.read``; a partial one, or one whose write fails, leaves what is there."""
    if clean:
        store.replace(df, path)
    return clean


def record_run(df: DataFrame, clean: bool, path: str, key: str, argv: list[str], created: float, ttl: float, duration: float = 0.0) -> DataFrame:
    """Store a complete run and give its catalogue entry, with the lines and bytes that the write counted as it went; no entry for a
    partial one."""
    spark = df.sparkSession
    if not clean:
        return spark.createDataFrame([], ENTRY)
    done = store.replace(df, path)
    return spark.createDataFrame([(key, float(created), float(created + ttl), list(argv), round(float(duration), 3), done.lines, done.bytes, False)], ENTRY)


def latest_values(log: DataFrame, ttl: int, now: float) -> DataFrame:
    """The newest value (key, value, ts) of each key that isn't older than the TTL; empty keys and values don't count."""
    return log.where((F.col("key") != "") & (F.col("value") != "") & (F.lit(now) - F.col("ts") <= ttl)).groupBy("key").agg(F.max_by("value", F.struct("ts", "value")).alias("value"), F.max("ts").alias("ts"))


def plan_writes(incoming: DataFrame, current: DataFrame, mode: str = "put", force: bool = False, overwrite: bool = False, order: str | None = None, key: str | bytes | None = None, kind: str = "String") -> DataFrame:
    """What writes (Name, Value, Type), one after the other, would do to the table (Name, Value, Type, Version).

    ``update``: a missing name is an error, a value equal to the one in effect unchanged unless forced, the type stays. ``put``: a
    new name is created, an existing one a conflict unless overwritten (a line's own Overwrite comes before the general one), the type
    is the line's or else ``kind``. A write has the version after the one in effect, and a later line of its name sees it. Lines
    without a name or a value are errors, and so are sealed values that ``key``, if given, doesn't open; opened ones are compared and written as their text.

    ``order`` names the column that puts lines in order, else they are as they are read. The rows of one name are sorted
    in one task, which spills; all that a line needs of those before it are counts and the last value.
    """
    value = opened(F.col("Value"), key_column(key)) if key is not None else F.col("Value")
    flag = F.coalesce(F.col("Overwrite").cast("boolean"), F.lit(overwrite)) if "Overwrite" in incoming.columns else F.lit(overwrite)
    own_kind = or_else(F.col("Type"), F.lit(kind)) if "Type" in incoming.columns else F.lit(kind)
    at = F.col(order) if order else F.monotonically_increasing_id()
    lines = incoming.select("Name", value.alias("Value"), own_kind.alias("Type"), flag.alias("__over"), at.alias("__at"))
    valid = F.coalesce(F.col("Name") != "", F.lit(False)) & F.col("Value").isNotNull()
    have = current.select("Name", F.col("Value").alias("__v"), F.col("Type").alias("__t"), F.col("Version").alias("__n"))
    w = Window.partitionBy("Name").orderBy("__at")
    before, so_far = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(Window.unboundedPreceding, 0)
    rows = lines.where(valid).join(have, "Name", "left")
    known = F.col("__n").isNotNull()
    if mode == "update":  # whatever a valid line does, its value is in effect after it
        last = F.when(known, F.when(F.count(F.lit(1)).over(before) > 0, F.last("Value").over(before)).otherwise(F.col("__v")))
        rows = rows.withColumn("__last", last)
        action = F.when(~known, "error").when(F.col("Value").eqNullSafe(F.col("__last")) & F.lit(not force), "unchanged").otherwise("update")
        rows = rows.withColumn("action", action).withColumn("Type", F.coalesce("__t", "Type"))
    else:
        there = known | (F.count(F.lit(1)).over(before) > 0)
        rows = rows.withColumn("action", F.when(~there, "create").when(F.col("__over"), "update").otherwise("conflict"))
        written = F.when(F.col("action").isin("create", "update"), F.struct("Value", "Type"))
        rows = rows.withColumn("__w", F.coalesce(F.last(written, ignorenulls=True).over(so_far), F.struct(F.col("__v").alias("Value"), F.col("__t").alias("Type"))))
        rows = rows.withColumn("__last", F.col("__w.Value")).withColumn("Type", F.col("__w.Type"))
    writes = F.col("action").isin("create", "update")
    count = F.sum(F.when(writes, 1).otherwise(0)).over(so_far)
    version = F.when(F.col("action") != "error", F.coalesce("__n", F.lit(0)) + count).cast(current.schema["Version"].dataType)
    rows = rows.select("Name", F.when(writes, F.col("Value")).otherwise(F.col("__last")).alias("Value"), "Type", "action", version.alias("Version"), "__at")
    bad = lines.where(~valid).select("Name", F.lit(None).cast("string").alias("Value"), "Type", F.lit("error").alias("action"), F.lit(None).cast(current.schema["Version"].dataType).alias("Version"), "__at")
    out = rows.union(bad)
    return out.withColumnRenamed("__at", order) if order else out.drop("__at")


def apply_writes(current: DataFrame, plan: DataFrame) -> DataFrame:
    """The table after a plan's creates and updates: of each name the last version that it wrote, one row."""
    done = plan.where("action in ('create', 'update')").groupBy("Name").agg(F.max_by(F.struct("Value", "Type"), "Version").alias("w"), F.max("Version").alias("Version"))
    done = done.select("Name", "w.Value", "w.Type", "Version")
    return current.join(done, "Name", "left_anti").select("Name", "Value", "Type", "Version").unionByName(done)


def outcome_counts(df: DataFrame, column: str = "action") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))
