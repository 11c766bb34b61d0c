"""Chaining and enriching records by joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.functions.expr import id_from_arn, or_else
from cairn.operators.keyspace import with_rank
from cairn.session import cut

#: Regions at most of a plan.
REGIONS = 1000


def bucket_posture(parents: DataFrame, key: str, configs: dict[str, DataFrame]) -> DataFrame:
    """Each parent with one structure column for each table of child settings stamped with its key; null if none.

    Children are first reduced to one row a key, so parents are never repeated.
    """
    for name, child in configs.items():
        one = child.groupBy(key).agg(F.min(F.struct(*(c for c in child.columns if c != key))).alias(name))
        parents = parents.join(one, key, "left")
    return parents


def enrich_tags(df: DataFrame, tag_table: DataFrame, session: tuple[str, ...] = ("profile", "region")) -> DataFrame:
    """Tags from ``tag_table`` (session columns, arn, tags) for rows of ``df`` (arn, name, tags) without any.

    Only rows with an ARN and no tags are looked up; a miss keeps the empty map; an empty name takes the tag Name.
    """
    keys = [*session, "arn"]
    lookup = F.coalesce(F.col("arn") != "", F.lit(False)) & (F.coalesce(F.size("tags"), F.lit(0)) <= 0)
    found = tag_table.groupBy(*keys).agg(F.max_by("tags", F.size("tags")).alias("__tags"))
    some = df.where(lookup).join(found, keys, "left")
    empty = F.create_map().cast("map<string,string>")
    some = some.withColumn("tags", F.coalesce("__tags", empty)).withColumn("name", or_else(F.col("name"), F.try_element_at("tags", F.lit("Name")), F.lit("")))
    return df.where(~lookup).unionByName(some.select(*df.columns))


def describe(listed: DataFrame, detail: DataFrame, id_field: str, scope: tuple[str, ...] = (), batch_size: int | None = None) -> DataFrame:
    """The details of listed ids, within the same scope columns; ids that are ARNs are looked up by their last part.

    A detail that doesn't echo its identifier (null) has it filled in from the lookup key. ``batch_size`` adds the
    number of the batch that such a request would have.
    """
    ids = listed.select(*scope, F.when(F.col(id_field).cast("string").startswith("arn:"), id_from_arn(F.col(id_field).cast("string"))).otherwise(F.col(id_field).cast("string")).alias("__id")).where("__id is not null").distinct()
    if batch_size:
        ids = with_batches(ids, "__id", batch_size, scope)
    d = detail.withColumn("__key", F.coalesce(F.col("__key"), F.col(id_field)).cast("string")) if "__key" in detail.columns else detail.withColumn("__key", F.col(id_field).cast("string"))
    joined = ids.join(d.withColumnRenamed("__key", "__id"), [*scope, "__id"])
    kind = detail.schema[id_field].dataType
    return joined.withColumn(id_field, F.coalesce(F.col(id_field), F.col("__id").cast(kind))).drop("__id")


def with_batches(ids: DataFrame, key: str, n: int, scope: tuple[str, ...] = ()) -> DataFrame:
    """``ids`` with ``batch``, numbered in each scope in blocks of ``n`` by key; without a scope, over all of them."""
    if not scope:
        return with_rank(ids, key, out="__n").withColumn("batch", F.floor((F.col("__n") - 1) / n)).drop("__n")
    return ids.withColumn("batch", F.floor((F.row_number().over(Window.partitionBy(*scope).orderBy(key)) - 1) / n))


def batches(df: DataFrame, key: str, n: int, scope: tuple[str, ...]) -> DataFrame:
    """Rows (scope, batch, ids) with at most ``n`` ids each, in order."""
    return with_batches(df, key, n, scope).groupBy(*scope, "batch").agg(F.sort_array(F.collect_list(key)).alias("ids"))


def chain(stages: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    """Parent list, child list, detail and so on: each stage joins the ones before on its stamped keys."""
    out = stages[0][0]
    for df, keys in stages[1:]:
        out = out.join(df, keys)
    return out


def lookup(names: DataFrame, table: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows of the distinct names, and the names without one."""
    wanted = names.select(key).distinct()
    return table.join(wanted, key, "left_semi"), wanted.join(table, key, "left_anti")


def marker_pairs(members: DataFrame) -> DataFrame:
    """Continuation markers: each output member with the input member it feeds, by equal name or ``Next`` before it.

    ``members`` (service, operation, direction, member). Equality wins over the prefix.
    """
    keys = ["service", "operation"]
    sent = members.where("direction = 'input'").select(*keys, F.col("member").alias("input_marker"))
    got = members.where("direction = 'output'").select(*keys, F.col("member").alias("output_marker"))
    ways = got.withColumn("way", F.explode(F.array(F.struct(F.col("output_marker").alias("name"), F.lit(0).alias("rank")), F.struct(F.regexp_replace("output_marker", "^Next", "").alias("name"), F.lit(1).alias("rank")))))
    ways = ways.where("way.rank = 0 or output_marker like 'Next_%'").select(*keys, "output_marker", F.col("way.name").alias("input_marker"), F.col("way.rank").alias("rank"))
    best = ways.join(sent, [*keys, "input_marker"]).groupBy(*keys, "output_marker").agg(F.min(F.struct("rank", "input_marker")).alias("m"))
    return best.select(*keys, "output_marker", F.col("m.input_marker").alias("input_marker"))


def dedupe_accounts(profiles: DataFrame, explicit: bool = False) -> tuple[DataFrame, DataFrame]:
    """The first profile (by ``pos``) of each account, and the profiles without an account.

    An explicit list keeps all profiles that have one.
    """
    dead = profiles.where("account is null or account = ''")
    alive = profiles.where("account <> ''")
    if explicit:
        return alive, dead
    first = F.row_number().over(Window.partitionBy("account").orderBy("pos"))
    return alive.withColumn("__n", first).where("__n = 1").drop("__n"), dead


def plan_sessions(profiles: DataFrame, regions: DataFrame, enabled: DataFrame | None = None, explicit: bool = False) -> DataFrame:
    """Deduplicated profiles in all regions; opt-in regions only where enabled.

    ``regions`` (region, opt_in boolean): a table of a few dozen rows, REGIONS at most, that becomes a literal;
    ``enabled`` (account, region).
    """
    alive, _ = dedupe_accounts(profiles, explicit)
    known = regions.select("region", "opt_in").limit(REGIONS + 1).collect()
    if len(known) > REGIONS:
        raise ValueError(f"more than {REGIONS} regions")
    kind = "array<struct<region:string,opt_in:boolean>>"
    every = F.array(*(F.struct(F.lit(r.region).alias("region"), F.lit(r.opt_in).alias("opt_in")) for r in known)).cast(kind)
    plan = alive.select("*", F.inline(every))
    free = plan.where("not opt_in")
    if enabled is None:
        return free.drop("opt_in")
    return free.unionByName(plan.where("opt_in").join(enabled, ["account", "region"], "left_semi")).drop("opt_in")


def lint_configs(configs: DataFrame, pairings: DataFrame, members: DataFrame) -> DataFrame:
    """Findings (problem, service, operation, name) on shaping configuration.

    ``configs`` (service, operation, root): the root isn't an output member. ``pairings`` (service, operation,
    target, param): the target operation or its input member is unknown.
    """
    keys = ["service", "operation", "name"]
    outputs = members.where("direction = 'output'").select("service", "operation", F.col("member").alias("name"))
    inputs = members.where("direction = 'input'").select("service", "operation", F.col("member").alias("name"))
    roots = configs.select("service", "operation", F.col("root").alias("name")).join(outputs, keys, "left_anti").select(F.lit("root").alias("problem"), *keys)
    targets = pairings.select("service", "operation", F.col("target").alias("name"))
    known = members.select("service", F.col("operation").alias("name")).distinct()
    unknown = targets.join(known, ["service", "name"], "left_anti").select(F.lit("target").alias("problem"), *keys)
    params = pairings.select("service", F.col("target").alias("operation"), F.col("param").alias("name"))
    bad = params.join(known.withColumnRenamed("name", "operation"), ["service", "operation"], "left_semi").join(inputs, keys, "left_anti").select(F.lit("param").alias("problem"), *keys)
    return roots.union(unknown).union(bad).distinct()


def match_ci(df: DataFrame, names: DataFrame, column: str, name: str) -> DataFrame:
    """``df`` with ``matched``: the name of equal spelling, else the least of equal letters, else null."""
    low = names.groupBy(F.lower(name).alias("__low")).agg(F.min(name).alias("__any"), F.collect_set(name).alias("__all"))
    out = df.withColumn("__low", F.lower(column)).join(low, "__low", "left")
    return out.withColumn("matched", F.when(F.array_contains("__all", F.col(column)), F.col(column)).otherwise(F.col("__any"))).drop("__low", "__any", "__all")


def choose_listing(seeds: DataFrame, versioning: DataFrame, key: str, force: bool = False) -> DataFrame:
    """``seeds`` with ``versions``: whether the bucket's status asks for listing versions; unknown means no."""
    status = versioning.groupBy(key).agg(F.max("status").alias("status"))
    test: Column = F.coalesce(F.col("status").isin("Enabled", "Suspended"), F.lit(False)) | F.lit(force)
    return seeds.join(status, key, "left").withColumn("versions", test).drop("status")


def union_ids(columns: dict[str, DataFrame], out: str = "id") -> DataFrame:
    """The different values of columns (by name, each of its table) that aren't null, by one shuffle of what differs in each task."""
    made = None
    for name, df in columns.items():
        one = df.select(F.col(name).alias(out)).where(F.col(out).isNotNull())
        made = one if made is None else made.union(one)
    return made.distinct()


def findings_diff(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct findings of two snapshots with ``state``: opened, resolved or open."""
    old, new = before.select(*keys).distinct().withColumn("__old", F.lit(True)), after.select(*keys).distinct().withColumn("__new", F.lit(True))
    state = F.when(F.col("__old").isNull(), "opened").when(F.col("__new").isNull(), "resolved").otherwise("open")
    return old.join(new, keys, "full_outer").select(*keys, state.alias("state"))


def digests(rows: DataFrame, keys: list[str], groups: int) -> DataFrame:
    """(group, n, one, two): keys are dealt into groups by hash; of each the number of rows and the sums of two hashes of the keys. Sums
    are made in the tasks that read the rows; only they are shuffled."""
    wide = lambda salt: F.sum(F.xxhash64(F.lit(salt), *keys).cast("decimal(38,0)"))
    return rows.groupBy(F.pmod(F.xxhash64(*keys), F.lit(groups)).alias("group")).agg(F.count("*").alias("n"), wide(1).alias("one"), wide(2).alias("two"))


def differing_groups(before: DataFrame, after: DataFrame, keys: list[str], groups: int) -> DataFrame:
    """The groups of keys whose digests differ."""
    a, b = (digests(df, keys, groups).select("group", F.struct("n", "one", "two").alias(c)) for df, c in ((before, "a"), (after, "b")))
    return a.join(b, "group", "full_outer").where(~F.col("a").eqNullSafe(F.col("b"))).select("group")


def findings_diff_by_digest(before: DataFrame, after: DataFrame, keys: list[str], groups: int = 10_000) -> DataFrame:
    """As ``findings_diff``, for snapshots that differ little: rows are joined only in groups of keys whose digests differ, the others
    are open as they are. ``before`` and ``after`` are read twice; keys should be unique in each, as repeated ones make a group differ.

    Two different groups pass for equal if their counts and both sums of 64-bit hashes agree.
    """
    group = F.pmod(F.xxhash64(*keys), F.lit(groups))
    differ = cut(differing_groups(before, after, keys, groups))  # ``groups`` rows at most
    some = lambda df, how: df.select(*keys, group.alias("group")).join(F.broadcast(differ), "group", how).drop("group")
    same = some(after, "left_anti").withColumn("state", F.lit("open"))
    return findings_diff(some(before, "left_semi"), some(after, "left_semi"), keys).union(same)


def exactly_once(emitted: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """Keys that aren't emitted just once: (key, problem) with missing, surplus or repeated."""
    e, x = emitted.groupBy(key).agg(F.count("*").alias("__n")), expected.select(key).distinct().withColumn("__x", F.lit(True))
    problem = F.when(F.col("__n").isNull(), "missing").when(F.col("__x").isNull(), "surplus").when(F.col("__n") > 1, "repeated")
    return e.join(x, key, "full_outer").select(key, problem.alias("problem")).where("problem is not null")
