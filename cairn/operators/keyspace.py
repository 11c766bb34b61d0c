"""Object-store keyspaces as tables: listings, slices of the key order, and how to cut hot ones.

A slice is (Bucket, start_after, end_at): keys after the first and up to the second; an empty end is no bound.
Strings are ordered by bytes, as the stores order keys.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.functions.expr import branch_end, key_of
from cairn.operators.key_trie import heavy_bounds, lcp_length
from cairn.session import cut

PAGE = 1000
#: Up to so many bounds are a literal array; beyond, keys and bounds are sorted together.
FEW_BOUNDS = 1000


def _rest(key: Column, prefix: Column) -> Column:
    return F.substring(key, F.length(prefix) + 1, F.length(key))


def _child(key: Column, prefix: Column, delimiter: str) -> Column:
    """The common prefix of a key below ``prefix``; null if no delimiter follows."""
    at = F.instr(_rest(key, prefix), delimiter)
    return F.when(at > 0, F.substring(key, F.lit(1), F.length(prefix) + at + len(delimiter) - 1))


def lean_objects(objects: DataFrame) -> DataFrame:
    """Objects with the small envelope of high-volume records."""
    meta = F.struct(F.lit("object").alias("type"), F.concat(F.lit("s3://"), "Bucket", F.lit("/"), "Key").alias("uri"))
    return objects.withColumn("meta", meta)


def list_level(objects: DataFrame, prefix: str = "", delimiter: str = "/", start_after: str = "") -> DataFrame:
    """One level: rows (Bucket, kind, key, n), keys without the delimiter after the prefix and the common prefixes
    of the others with the number of keys below."""
    rows = objects.where(F.col("Key").startswith(prefix) & (F.col("Key") > start_after))
    child = _child(F.col("Key"), F.lit(prefix), delimiter)
    return rows.groupBy("Bucket", F.when(child.isNull(), "object").otherwise("prefix").alias("kind"), F.coalesce(child, F.col("Key")).alias("key")).agg(F.count("*").alias("n"))


def list_schedule(objects: DataFrame, delimiters: list[str], emit_prefixes: bool = True) -> DataFrame:
    """Level i is split by delimiter i, the rest is listed whole: rows (Bucket, level, kind, key), each key once."""
    names = [f"__p{i}" for i in range(len(delimiters))]

    def descend(rows: DataFrame) -> DataFrame:
        """The prefix of each level that the schedule reaches, else null."""
        before = F.lit("")
        for name, d in zip(names, delimiters, strict=True):
            rows, before = rows.withColumn(name, _child(F.col("Key"), before, d)), F.col(name)
        return rows

    rows = descend(objects.select("Bucket", "Key"))
    level = sum((F.when(F.col(p).isNotNull(), 1).otherwise(0) for p in names), F.lit(0))
    out = rows.select("Bucket", level.alias("level"), F.lit("object").alias("kind"), F.col("Key").alias("key"))
    if not emit_prefixes or not names:
        return out
    # The deepest prefixes are few; they pass the same prefixes as the keys below them. Nulls go at the end: a filter
    # here would be pushed to the scan, where it computes the prefixes once more for each level.
    deepest = rows.select("Bucket", F.coalesce(*reversed([F.col(p) for p in names])).alias("Key")).distinct()
    levels = F.explode(F.array(*(F.struct(F.lit(i).alias("level"), F.col(p).alias("key")) for i, p in enumerate(names))))
    prefixes = descend(deepest).select("Bucket", levels.alias("s")).where("s.key is not null").select("Bucket", "s.level", F.lit("prefix").alias("kind"), "s.key").distinct()
    return out.unionByName(prefixes)


def list_from_seeds(objects: DataFrame, seeds: DataFrame) -> DataFrame:
    """The objects below each seed (Bucket, prefix), recursively, a row for each seed that a key is below.

    Seeds may lie in one another. A key is below the seeds, and only them, that its latest seed in key order lies in or is,
    as far as they are prefixes of it: so each seed carries the stack of those it lies in, and keys take the latest stack.
    """
    own = seeds.where("Bucket is not null and prefix is not null").select("Bucket", "prefix").distinct()
    lengths = own.select("Bucket", F.length("prefix").alias("l")).distinct().groupBy("Bucket").agg(F.collect_set("l").alias("ls"))  # at most 1,024, the limit of a key
    outer = own.join(lengths, "Bucket").select("Bucket", "prefix", F.explode(F.filter("ls", lambda l: l <= F.length("prefix"))).alias("l"))  # noqa: E741
    outer = outer.select("Bucket", F.substring(F.col("prefix"), F.lit(1), F.col("l")).alias("outer"), F.col("prefix").alias("inner"))
    stacks = outer.join(own.select("Bucket", F.col("prefix").alias("outer")), ["Bucket", "outer"]).groupBy("Bucket", F.col("inner").alias("at")).agg(F.collect_list("outer").alias("stack"))
    rows = latest(objects, stacks, "stack").where("stack is not null")
    return rows.select(*objects.columns, F.explode(F.filter("stack", lambda s: F.col("Key").startswith(s))).alias("prefix"))


def latest(objects: DataFrame, marks: DataFrame, value: str) -> DataFrame:
    """``objects`` with the ``value`` of the latest mark (Bucket, at, value) of their bucket at or before their key, else
    null. Marks are different. Keys and marks are sorted together by ranges; each task's range takes up the latest
    mark of those before it."""
    kind = marks.schema[value].dataType
    mark = lambda at, v: F.struct(at.alias("at"), v.alias("v"))
    none = F.lit(None).cast(f"struct<at:string,v:{kind.simpleString()}>")
    rows = objects.select(*objects.columns, F.lit(1).alias("__o"), F.col("Key").alias("__k"), none.alias("__m"))
    blank = [F.lit(None).cast(objects.schema[c].dataType).alias(c) if c != "Bucket" else F.col(c) for c in objects.columns]
    both = rows.union(marks.select(*blank, F.lit(0), F.col("at"), mark(F.col("at"), F.col(value))))
    both = cut(both.repartitionByRange("Bucket", "__k", "__o").withColumn("__part", F.spark_partition_id()))
    earlier = Window.partitionBy("Bucket").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    ends = both.where("__o = 0").groupBy("Bucket", "__part").agg(F.max_by("__m", "__k").alias("__last"))
    parts = both.select("Bucket", "__part").distinct().join(ends, ["Bucket", "__part"], "left")
    carried = parts.select("Bucket", "__part", F.last("__last", ignorenulls=True).over(earlier).alias("__before"))
    own = Window.partitionBy("Bucket", "__part").orderBy("__k", "__o").rowsBetween(Window.unboundedPreceding, 0)
    out = both.withColumn("__m", F.last("__m", ignorenulls=True).over(own)).where("__o = 1").join(carried, ["Bucket", "__part"])
    return out.select(*objects.columns, F.coalesce("__m", "__before")["v"].alias(value))


def fan_profile(objects: DataFrame, depth: int = 1, delimiter: str = "/", page: int = PAGE, max_fan: int = 2000, split_after: int = 10) -> DataFrame:
    """Keys, pages and children of each prefix of ``depth`` levels, and what a scan should do with it."""
    prefix = F.concat(F.substring_index("Key", delimiter, depth), F.lit(delimiter))
    rows = objects.where(F.size(F.split("Key", "\\Q" + delimiter + "\\E", -1)) > depth).select("Bucket", prefix.alias("prefix"), "Key")
    child = _child(F.col("Key"), F.col("prefix"), delimiter)
    per = rows.groupBy("Bucket", "prefix", child.alias("child")).agg(F.count("*").alias("n"))  # two steps: no distinct over a hot prefix
    out = per.groupBy("Bucket", "prefix").agg(F.sum("n").alias("n"), F.count("child").alias("fan")).withColumn("pages", F.ceil(F.col("n") / page))
    verdict = (
        F.when(F.col("pages") <= 1, "one-page").when(F.col("fan") > max_fan, "over-shatter").when(F.col("fan") > 0, "fan")
        .when(F.col("pages") > split_after, "under-shatter").otherwise("hot leaf")
    )
    return out.withColumn("verdict", verdict)


def lcp(a: Column, b: Column) -> Column:
    """The longest common prefix of two strings."""
    return F.substring(a, F.lit(1), lcp_length(a, b))


def common_stem(objects: DataFrame, by: list[str]) -> DataFrame:
    """The longest common prefix of all keys of each group: that of the least and the greatest."""
    return objects.groupBy(*by).agg(F.min("Key").alias("low"), F.max("Key").alias("high"), F.count("*").alias("n")).withColumn("stem", lcp(F.col("low"), F.col("high")))


def branches(objects: DataFrame, by: list[str], most: int = 64) -> DataFrame:
    """Of each group its stem and the distinct next characters, in order, ``most`` at most (more are rare).

    The stem is where the keys first part: a key that all the others begin with, such as a folder's marker, doesn't end it. So
    it is what the greatest key shares with the least one that isn't a prefix of it. Groups of which no two keys part
    that way are left out.
    """
    high = objects.groupBy(*by).agg(F.max("Key").alias("__high"))
    parting = objects.join(high, by).where(~F.col("__high").startswith(F.col("Key")))
    stems = parting.groupBy(*by, "__high").agg(F.min("Key").alias("__low")).select(*by, lcp(F.col("__low"), F.col("__high")).alias("stem"))
    rows = objects.join(stems, by).where(F.length("Key") > F.length("stem"))
    chars = rows.groupBy(*by, "stem", F.substring(F.col("Key"), F.length("stem") + 1, F.lit(1)).alias("c")).agg(F.count("*").alias("n"))
    return chars.groupBy(*by, "stem").agg(F.slice(F.sort_array(F.collect_list("c")), 1, most).alias("chars"))


def radix_split(objects: DataFrame, slices: DataFrame, fan_target: int = 256) -> DataFrame:
    """Each slice that holds objects cut at stem + character, or stem + two if that makes ``fan_target`` at most.

    Bounds strictly inside the slice count; the pieces run from its start to its end without gaps. A slice whose keys
    don't part, or only its markers do, stays whole.
    ``objects`` (Bucket, Key, start_after, end_at): assigned to their slices.
    """
    by = ["Bucket", "start_after", "end_at"]
    b = branches(objects.select(*by, "Key"), by)
    two = F.flatten(F.transform("chars", lambda x: F.transform("chars", lambda y: F.concat("stem", x, y))))
    bounds = F.when(F.size("chars") * F.size("chars") <= fan_target, two).otherwise(F.transform("chars", lambda x: F.concat("stem", x)))
    inside = F.filter(F.sort_array(bounds), lambda x: (x > F.col("start_after")) & ((F.col("end_at") == "") | (x < F.col("end_at"))))
    cuts = slices.select(*by).join(b, by, "left").withColumn("bounds", F.coalesce(inside, F.array().cast("array<string>")))
    starts, ends = F.concat(F.array("start_after"), "bounds"), F.concat("bounds", F.array("end_at"))
    return cuts.select("Bucket", F.inline(F.arrays_zip(starts.alias("start_after"), ends.alias("end_at"))))


def alphabet(scheme: str) -> list[str]:
    """Bounds of a fixed scheme: hex2, hex3, alnum2, b64-2 or none."""
    letters = {"hex2": ("0123456789abcdef", 2), "hex3": ("0123456789abcdef", 3), "alnum2": (string.digits + string.ascii_lowercase, 2), "b64-2": ("+/" + string.digits + string.ascii_letters, 2), "none": ("", 0)}
    chars, n = letters[scheme]
    out = [""] if n else []
    for _ in range(n):
        out = [x + c for x in out for c in sorted(chars)]
    return out


def fixed_bounds(scheme: str, prefix: str = "", start_after: str = "", end_at: str = "") -> list[str]:
    """The scheme's bounds below ``prefix`` that lie inside the slice."""
    return [b for b in (prefix + a for a in alphabet(scheme)) if b > start_after and (not end_at or b < end_at)]


def fixed_split(spark: SparkSession, bucket: str, scheme: str, prefix: str = "", start_after: str = "", end_at: str = "") -> DataFrame:
    """One slice cut at the scheme's bounds below ``prefix``."""
    inside = fixed_bounds(scheme, prefix, start_after, end_at)
    ends = [*inside, end_at]
    return spark.createDataFrame([(bucket, a, b) for a, b in zip([start_after, *inside], ends, strict=True)], "Bucket string, start_after string, end_at string")


def fixed_split_all(buckets: DataFrame, scheme: str, prefix: str = "", start_after: str = "", end_at: str = "") -> DataFrame:
    """The same slice of every row's Bucket cut at the scheme's bounds: a literal list of them, 4,096 at most."""
    inside = fixed_bounds(scheme, prefix, start_after, end_at)
    starts, ends = (F.split(F.lit("\n".join(x)), "\n", -1) for x in ([start_after, *inside], [*inside, end_at]))
    return buckets.select("Bucket", F.inline(F.arrays_zip(starts.alias("start_after"), ends.alias("end_at"))))


def assign_slices(objects: DataFrame, slices: DataFrame, few: int = FEW_BOUNDS) -> DataFrame:
    """``objects`` with the start_after and end_at of the slice that holds them; keys in none are left out.

    ``slices`` don't overlap. Few of them are broadcast; beyond that, bounds and keys are sorted
    together by ranges, and each key takes the latest start before it.
    """
    if slices.count() <= few:
        own = F.broadcast(slices.select(F.col("Bucket").alias("__b"), F.col("start_after").alias("__s"), F.col("end_at").alias("__e")))
        inside = (F.col("Bucket") == F.col("__b")) & (F.col("Key") > F.col("__s")) & ((F.col("__e") == "") | (F.col("Key") <= F.col("__e")))
        return objects.join(own, inside).select(*objects.columns, F.col("__s").alias("start_after"), F.col("__e").alias("end_at"))
    # keys and bounds in one order over all tasks; each task begins with the latest start of those before it
    own = objects.select(*objects.columns, F.lit(0).alias("__bound"), F.col("Key").alias("__k"), F.lit(None).cast("string").alias("__e"))
    blank = [F.lit(None).cast(objects.schema[c].dataType).alias(c) if c != "Bucket" else F.col(c) for c in objects.columns]
    bounds = slices.select(*blank, F.lit(1).alias("__bound"), F.col("start_after").alias("__k"), F.col("end_at").alias("__e"))
    parts = int(objects.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = cut(own.union(bounds).repartitionByRange(parts, "Bucket", "__k").withColumn("__part", F.spark_partition_id()))
    start = F.when(F.col("__bound") == 1, F.struct(F.col("__k").alias("start_after"), F.col("__e").alias("end_at")))
    earlier = Window.partitionBy("Bucket").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    carried = both.groupBy("Bucket", "__part").agg(F.max(start).alias("__last")).withColumn("__before", F.last("__last", ignorenulls=True).over(earlier)).drop("__last")
    w = Window.partitionBy("Bucket", "__part").orderBy("__k", "__bound").rowsBetween(Window.unboundedPreceding, 0)
    out = both.join(carried, ["Bucket", "__part"]).withColumn("__m", F.coalesce(F.last(start, ignorenulls=True).over(w), F.col("__before")))
    out = out.where("__bound = 0").select(*objects.columns, "__m.start_after", "__m.end_at")
    return out.where("start_after is not null and (end_at = '' or Key <= end_at)")


def slice_counts(objects: DataFrame, slices: DataFrame) -> DataFrame:
    return assign_slices(objects, slices).groupBy("Bucket", "start_after", "end_at").agg(F.count("*").alias("n"))


def rebalance(objects: DataFrame, max_pages: int, page: int = PAGE) -> DataFrame:
    """Slices from the whole of each bucket, cut where the trie's heavy nodes branch: none has over ``max_pages`` pages
    unless it holds one key."""
    return split_with(objects, lambda o: heavy_bounds(o, max_pages * page))


def split_with(objects: DataFrame, fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A user's function from objects to bounds (Bucket, bound), as slices."""
    w = Window.partitionBy("Bucket").orderBy("bound")
    bounds = fn(objects).where("bound <> ''").distinct()
    inner = bounds.select("Bucket", F.coalesce(F.lag("bound").over(w), F.lit("")).alias("start_after"), F.col("bound").alias("end_at"))
    last = objects.select("Bucket").distinct().join(bounds.groupBy("Bucket").agg(F.max("bound").alias("b")), "Bucket", "left")
    return inner.union(last.select("Bucket", F.coalesce("b", F.lit("")).alias("start_after"), F.lit("").alias("end_at")))


def even_bounds(objects: DataFrame, n: int) -> DataFrame:
    """Bounds that cut all keys into about ``n`` equal parts, by Spark's own range partitioning."""
    parts = objects.select("Bucket", "Key").repartitionByRange(n, "Bucket", "Key")
    return parts.groupBy("Bucket", F.spark_partition_id().alias("p")).agg(F.max("Key").alias("bound")).select("Bucket", "bound")


def sampled_bounds(objects: DataFrame, parts: int, per_part: int = 256) -> DataFrame:
    """Bounds (Bucket, bound) that cut the keys of each bucket into ``parts`` about equal parts: quantiles of a sample.

    The sample is a bucket's ``parts * per_part`` keys of least hash, so it doesn't depend on how keys are dealt over tasks. A filter by an
    estimate of their number comes first and lets about twice as many through, so that no task sorts more. With 256 keys a part,
    the size of a part is within 25 % of the even one, but for one part in 10,000.
    """
    k = parts * per_part
    digest = F.md5("Key")
    place = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    counts = objects.groupBy("Bucket").agg(F.approx_count_distinct("Key").alias("__n"))
    share = F.least(F.lit(1.0), (2.0 * k + 100) / F.col("__n")) * float(1 << 32)
    some = objects.join(counts, "Bucket").where(place < share).select("Bucket", "Key").distinct()
    least = Window.partitionBy("Bucket").orderBy(digest, "Key")
    some = some.withColumn("__r", F.row_number().over(least)).where(F.col("__r") <= k)
    r = F.row_number().over(Window.partitionBy("Bucket").orderBy("Key"))
    some = some.select("Bucket", "Key", r.alias("r"), F.count("*").over(Window.partitionBy("Bucket")).alias("m"))
    part = lambda x: F.floor(x * parts / F.col("m"))
    return some.where((part(F.col("r")) > part(F.col("r") - 1)) & (F.col("r") < F.col("m"))).select("Bucket", F.col("Key").alias("bound"))


def resume_points(slices: DataFrame, handled: DataFrame) -> DataFrame:
    """For each unfinished slice the greatest handled key; a handled prefix counts as all that is below it.

    ``handled`` (Bucket, start_after, end_at, key, is_prefix).
    """
    by = ["Bucket", "start_after", "end_at"]
    reached = handled.groupBy(*by).agg(F.max(F.when(F.col("is_prefix"), branch_end(F.col("key"))).otherwise(F.col("key"))).alias("resume_after"))
    return slices.select(*by).join(reached, by, "left").withColumn("resume_after", F.coalesce("resume_after", "start_after"))


def remaining(slices: DataFrame, completed: DataFrame) -> DataFrame:
    return slices.join(completed, ["Bucket", "start_after", "end_at"], "left_anti")


def failed_seeds(slices: DataFrame, completed: DataFrame, handled: DataFrame) -> DataFrame:
    """Seeds, as JSON lines, to go on with what isn't completed."""
    left = resume_points(remaining(slices, completed), handled)
    return left.select("Bucket", F.to_json(F.struct("Bucket", F.col("resume_after").alias("StartAfter"), F.col("end_at").alias("EndAt"))).alias("seed"))


def check_partition(slices: DataFrame) -> DataFrame:
    """Slices that don't begin where the one before ends, with the end they should begin at."""
    w = Window.partitionBy("Bucket").orderBy("start_after", "end_at")
    before = slices.withColumn("expected", F.coalesce(F.lag("end_at").over(w), F.lit("")))
    return before.where("start_after <> expected")


def listing_cost(objects: DataFrame, slices: DataFrame, page: int = PAGE) -> DataFrame:
    """One row: pages of a serial listing, calls of the sliced one (an empty slice takes one), and slices."""
    counted = slices.join(slice_counts(objects, slices), ["Bucket", "start_after", "end_at"], "left")
    calls = F.greatest(F.ceil(F.coalesce("n", F.lit(0)) / page), F.lit(1))
    serial = objects.groupBy("Bucket").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.ceil(F.col("n") / page)), F.lit(0)).alias("serial_pages"))
    sliced = counted.agg(F.coalesce(F.sum(calls), F.lit(0)).alias("sliced_calls"), F.count("*").alias("slices"))
    return serial.withColumn("__k", F.lit(1)).join(sliced.withColumn("__k", F.lit(1)), "__k").drop("__k")


def with_rank(df: DataFrame, *order: str, out: str = "rank") -> DataFrame:
    """``df`` with each row's number, from 1, in the order of all rows: tasks sort ranges, offsets follow from their sizes."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = cut(df.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id()))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row a task
    sizes = ranges.groupBy("__part").agg(F.count("*").alias("__n")).withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    number = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return ranges.join(F.broadcast(sizes), "__part").withColumn(out, F.col("__before") + number).drop("__part", "__before")


def merge_by_key(versions: DataFrame, markers: DataFrame) -> DataFrame:
    """Versions and delete markers in key order, versions first; ``rank`` is the place in that order."""
    both = versions.withColumn("__r", F.lit(0)).unionByName(markers.withColumn("__r", F.lit(1)), allowMissingColumns=True)
    return with_rank(both, "Key", "__r", "VersionId").orderBy("rank").drop("__r")


def current(versions: DataFrame) -> DataFrame:
    return versions.where("IsLatest")


def noncurrent(versions: DataFrame) -> DataFrame:
    return versions.where("not IsLatest")


def latest_faults(versions: DataFrame) -> DataFrame:
    """Keys without exactly one latest version."""
    return versions.groupBy("Bucket", "Key").agg(F.sum(F.when(F.col("IsLatest"), 1).otherwise(0)).alias("latest")).where("latest <> 1")


def scan_versions(versions: DataFrame, slices: DataFrame) -> DataFrame:
    """Versions and markers by slice; all versions of a key are in one."""
    return assign_slices(versions, slices)


def enrich_version_tags(versions: DataFrame, tags: DataFrame) -> DataFrame:
    """Tags on versions, an empty map where none is found, and null on delete markers."""
    one = tags.groupBy("Bucket", "Key", "VersionId").agg(F.max_by("tags", F.size("tags")).alias("tags"))
    out = versions.join(one, ["Bucket", "Key", "VersionId"], "left")
    return out.withColumn("tags", F.when(F.col("kind") != "delete-marker", F.coalesce("tags", F.create_map().cast("map<string,string>"))))


def shape_listing(pages: DataFrame) -> DataFrame:
    """Parsed listing pages (Bucket, page) as prefix and object records (kind, Bucket, Key, ...)."""
    prefixes = pages.select("Bucket", F.explode("page.CommonPrefixes").alias("Key")).select(F.lit("prefix").alias("kind"), "Bucket", "Key")
    objects = pages.select("Bucket", F.explode("page.Contents").alias("o")).select(F.lit("object").alias("kind"), "Bucket", "o.*")
    return objects.unionByName(prefixes, allowMissingColumns=True)


def shape_versions(pages: DataFrame) -> DataFrame:
    """Parsed version pages as prefix, version and delete-marker records."""
    made = [pages.select("Bucket", F.explode(f"page.{f}").alias("o")).select(F.lit(k).alias("kind"), "Bucket", "o.*") for k, f in (("object-version", "Version"), ("delete-marker", "DeleteMarker"))]
    prefixes = pages.select("Bucket", F.explode("page.CommonPrefixes").alias("Key")).select(F.lit("prefix").alias("kind"), "Bucket", "Key")
    return made[0].unionByName(made[1], allowMissingColumns=True).unionByName(prefixes, allowMissingColumns=True)


def to_seeds(lines: DataFrame, delimiters: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Seeds from lines, and the lines that give no bucket, as they were.

    A line's Bucket and Prefix count; only without a Bucket do both come from its Uri, or the uri of its ``meta``, which then
    has to be ``s3://bucket/...``. Its Delimiters come before the general ``delimiters``, and where there are none a single
    Delimiter is a schedule of one level; an EndAt clears them. Bucket, Prefix and Uri may be in lower case. Session fields are the line's or those of
    its stamp. Columns that aren't there count as null, and empty text as missing.
    """
    have = {f.name: f.dataType for f in lines.schema}
    meta = have.get("meta") if isinstance(have.get("meta"), T.StructType) else T.StructType()
    stamp = meta["stamp"].dataType if "stamp" in meta.names and isinstance(meta["stamp"].dataType, T.StructType) else T.StructType()
    text = lambda *names: F.coalesce(*(F.nullif(F.col(n).cast("string"), F.lit("")) for n in names if n in have or n.partition(".")[0] == "meta"), F.lit(None).cast("string"))
    uri = text("Uri", "uri", *(["meta.uri"] if "uri" in meta.names else []))
    named = text("Bucket", "bucket")
    usable = F.when(uri.rlike(r"(?s)\As3://[^/]"), uri)
    none = F.array().cast("array<string>")
    own = F.col("Delimiters") if isinstance(have.get("Delimiters"), T.ArrayType) else F.lit(None).cast("array<string>")
    own = F.when(F.size(own) > 0, own)
    general = F.lit(None).cast("array<string>") if not delimiters else F.array(*map(F.lit, delimiters))
    single = F.when(text("Delimiter").isNotNull(), F.array(text("Delimiter")))
    end = F.coalesce(text("EndAt"), F.lit(""))
    session = lambda c: text(c, *([f"meta.stamp.{c}"] if c in stamp.names else []))
    versions = F.coalesce(F.col("Versions").cast("boolean"), F.lit(False)) if "Versions" in have else F.lit(False)
    rows = lines.withColumn("__bucket", F.coalesce(named, F.regexp_extract(usable, r"\As3://([^/]+)", 1)))
    good = rows.where("__bucket is not null").select(
        F.col("__bucket").alias("Bucket"), F.coalesce(F.when(named.isNotNull(), F.coalesce(text("Prefix", "prefix"), F.lit(""))), key_of(uri)).alias("Prefix"),
        F.when(end != "", none).otherwise(F.coalesce(own, general, single, none)).alias("Delimiters"), F.coalesce(text("StartAfter"), F.lit("")).alias("StartAfter"), end.alias("EndAt"),
        session("profile").alias("profile"), session("region").alias("region"), versions.alias("Versions"), F.coalesce(text("VersionAfter"), F.lit("")).alias("VersionAfter"),
    )
    return good, rows.where("__bucket is null").drop("__bucket")
