"""Posture checks over nested inventory tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.functions.expr import percent

OPEN = "0.0.0.0/0"


def is_open(perms, cidr: str = OPEN):
    """Whether any range of any permission is ``cidr``; a null list is closed."""
    return F.coalesce(F.exists(F.flatten(F.transform(perms, lambda p: p["Ranges"])), lambda r: r["Cidr"] == cidr), F.lit(False))


def check_public_endpoint(clusters: DataFrame, cidr: str = OPEN) -> DataFrame:
    """Rows whose endpoint is public and lists the open range."""
    return clusters.where(F.col("access.public") & F.array_contains("access.cidrs", cidr))


def check_expired(certs: DataFrame, in_use: bool) -> DataFrame:
    """Expired rows that something uses, or that nothing does; a null list of users counts as empty."""
    users = F.coalesce(F.size("used_by"), F.lit(0))
    return certs.where((F.col("status") == "EXPIRED") & ((users > 0) if in_use else (users <= 0)))


def check_privileged_profiles(profiles: DataFrame, roles: DataFrame, policies: DataFrame, suffix: str) -> DataFrame:
    """Profiles (profile, roles) whose role (role) has a policy (role, policy_arn) that ends with ``suffix``."""
    admin = policies.where(F.col("policy_arn").endswith(suffix)).select("role").distinct()
    held = profiles.select("profile", F.explode("roles").alias("role"))
    return held.join(roles, "role").join(admin, "role").select("profile", "role").distinct()


def check_open_databases(databases: DataFrame, groups: DataFrame, cidr: str = OPEN) -> DataFrame:
    """Databases (db, groups) with an open security group (group, Perms), ordered."""
    bad = groups.where(is_open(F.col("Perms"), cidr)).select("group").distinct()
    return databases.select("db", F.explode("groups").alias("group")).distinct().join(bad, "group").select("db", "group").orderBy("db", "group")


def check_flag_off(df: DataFrame, flag: str, *columns: str) -> DataFrame:
    """Distinct rows whose flag is false; null is not."""
    return df.where(~F.col(flag)).select(*columns).distinct()


def check_trail_buckets(trails: DataFrame, buckets: DataFrame, blocks: DataFrame, key: str) -> DataFrame:
    """Distinct trail keys with whether the bucket is known and whether it has a public-access block."""
    out = trails.select(key).join(buckets.select(key, F.lit(True).alias("__b")).distinct(), key, "left").join(blocks.select(key, F.lit(True).alias("__p")).distinct(), key, "left")
    return out.select(key, F.col("__b").isNotNull().alias("bucket_known"), F.col("__p").isNotNull().alias("blocked")).distinct()


def check_unattached_open(groups: DataFrame, attached: list[DataFrame], cidr: str = OPEN) -> DataFrame:
    """Open groups (group, Perms) in none of the id lists (``group``), as SQL's NOT IN has it: a null id in a list
    leaves no finding, and a null group is never one."""
    used = attached[0].select("group")
    for more in attached[1:]:
        used = used.union(more.select("group"))
    found = groups.where(is_open(F.col("Perms"), cidr) & F.col("group").isNotNull()).select("group")
    if not used.where(F.col("group").isNull()).isEmpty():
        return found.limit(0)
    return found.join(used.distinct(), "group", "left_anti")


def check_unversioned(buckets: DataFrame, versioning: DataFrame, key: str) -> DataFrame:
    """Distinct buckets without a versioning status, or with another one than Enabled."""
    return buckets.select(key).join(versioning.select(key, "status"), key, "left").where("status is null or status <> 'Enabled'").select(key, "status").distinct()


def check_stale_keys(keys: DataFrame, used: DataFrame, key: str, as_of: str, max_age: int, max_idle: int) -> DataFrame:
    """Keys (key, created) with their last use (key, last_used): too old, idle for too long, or never used."""
    day = F.lit(as_of).cast("date")
    out = keys.join(used, key, "left").select(key, F.datediff(day, F.col("created").cast("date")).alias("age_days"), F.datediff(day, F.col("last_used").cast("date")).alias("idle_days"))
    return out.where((F.col("age_days") > max_age) | (F.col("idle_days") > max_idle) | F.col("idle_days").isNull())


def check_single_zone(databases: DataFrame, keys: list[str], redundant: str) -> DataFrame:
    """Groups that have rows without redundancy, with counts; a null flag counts as none. Most first."""
    lacking = F.sum(F.when(F.col(redundant), 0).otherwise(1))
    return databases.groupBy(*keys).agg(F.count("*").alias("total"), lacking.alias("not_redundant")).where("not_redundant > 0").orderBy(F.desc("not_redundant"), *keys)


def coverage(df: DataFrame, flag: str) -> DataFrame:
    """One row: total, enabled and percent (null for no rows)."""
    return df.agg(F.count("*").alias("total"), F.coalesce(F.sum(F.when(F.col(flag), 1).otherwise(0)), F.lit(0)).alias("enabled")).withColumn("percent", percent(F.col("enabled"), F.col("total")))
