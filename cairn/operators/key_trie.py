"""A keyspace's trie, as far down as it is heavy, and the slices that it gives.

The trie's nodes are the common prefixes of neighbours in key order; a node is heavy if more objects lie below it than a budget.
Every stretch of more than ``budget`` objects holds a key at a multiple of ``budget`` in that order, so all heavy nodes are
prefixes of those few keys, the marks, and each other key need only be compared with the mark before and the mark
after it. One range sort and joins by number: no rounds, and no group larger than the budget or a task's range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.functions.expr import branch_end
from cairn.session import cut

#: Characters that ``lcp`` compares at most; a key has 1,024 bytes at most.
LONGEST = 2047


def lcp_length(a: Column, b: Column) -> Column:
    """The length of the longest common prefix of two strings, by halving steps."""
    least = F.least(F.length(a), F.length(b))
    same = lambda n: (n <= least) & (F.substring(a, F.lit(1), n) == F.substring(b, F.lit(1), n))
    steps = F.array(*(F.lit(1 << i) for i in range(LONGEST.bit_length() - 1, -1, -1)))
    return F.aggregate(steps, F.lit(0), lambda n, s: F.when(same(n + s), n + s).otherwise(n))


def neighbours(objects: DataFrame) -> DataFrame:
    """Each different key of a bucket once, with what follows it: (Bucket, Key, w, first, after), ``w`` objects of the
    key, ``first`` the number of objects before it, ``after`` the next key, null at the end.

    Keys are sorted by ranges; a task's range takes up the count of those before it and the first key of the one after.
    """
    keys = objects.groupBy("Bucket", "Key").agg(F.count("*").alias("w"))
    ranges = cut(keys.repartitionByRange("Bucket", "Key").withColumn("__part", F.spark_partition_id()))
    parts = ranges.groupBy("Bucket", "__part").agg(F.sum("w").alias("__n"), F.min("Key").alias("__low"))
    order = Window.partitionBy("Bucket").orderBy("__part")  # a row a range
    carried = parts.select("Bucket", "__part", F.coalesce(F.sum("__n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"), F.lead("__low").over(order).alias("__next"))
    own = Window.partitionBy("Bucket", "__part").orderBy("Key")
    so_far = F.sum("w").over(own.rowsBetween(Window.unboundedPreceding, 0)) - F.col("w")
    rows = ranges.join(carried, ["Bucket", "__part"])
    return rows.select("Bucket", "Key", "w", (F.col("__before") + so_far).alias("first"), F.coalesce(F.lead("Key").over(own), F.col("__next")).alias("after"))


def heavy_cuts(objects: DataFrame, budget: int) -> DataFrame:
    """The places where heavy nodes branch: (Bucket, stem, Key, after), a row for each pair of neighbours whose common prefix
    ``stem`` has more than ``budget`` objects below it. A node with k children has k - 1 of them, and one more if it is
    a key itself."""
    last = F.col("first") + F.col("w") - 1
    rows = neighbours(objects).withColumn("m", F.floor(last / budget))
    low = F.floor((F.col("first") - 1) / budget) + 1  # the first mark in this key's stretch of objects
    rows = cut(rows.withColumn("marked", F.col("m") >= low).withColumn("low", low))
    marks = rows.where("marked")
    order = Window.partitionBy("Bucket").orderBy("m")
    marks = marks.select("Bucket", "low", "m", F.col("Key").alias("mark"), F.lag("Key").over(order).alias("__a"), F.lead("Key").over(order).alias("__b"))
    # two marks below a node make it heavy by themselves
    near = F.greatest(*(F.coalesce(lcp_length(F.col("mark"), F.col(c)), F.lit(-1)) for c in ("__a", "__b")))
    marks = cut(marks.select("Bucket", "low", "m", "mark", near.alias("near")))
    before = marks.select("Bucket", "m", F.col("mark").alias("p"))
    after = marks.select("Bucket", (F.col("low") - 1).alias("m"), F.col("mark").alias("q"))
    both = rows.join(before, ["Bucket", "m"]).join(after, ["Bucket", "m"], "left")
    both = both.withColumn("at_p", lcp_length(F.col("Key"), F.col("p"))).withColumn("at_q", lcp_length(F.col("Key"), F.col("q")))
    both = cut(both.select("Bucket", "Key", "w", "after", "p", "q", "at_p", "at_q"))
    # of each mark, the objects around it by the length that they share with it
    sides = F.inline(F.array(F.struct(F.col("p").alias("mark"), F.col("at_p").alias("at")), F.struct(F.col("q").alias("mark"), F.col("at_q").alias("at"))))
    shared = both.select("Bucket", "w", sides).where("mark is not null").groupBy("Bucket", "mark", "at").agg(F.sum("w").alias("n"))
    deeper = Window.partitionBy("Bucket", "mark").orderBy(F.desc("at"))  # as many rows as a key has characters
    deep = shared.withColumn("n", F.sum("n").over(deeper)).where(F.col("n") > budget).groupBy("Bucket", "mark").agg(F.max("at").alias("deep"))
    reach = marks.join(deep, ["Bucket", "mark"], "left").select("Bucket", "mark", F.greatest(F.coalesce("deep", F.lit(-1)), "near").alias("reach"))
    of = lambda c: reach.select("Bucket", F.col("mark").alias(c), F.col("reach").alias(f"{c}_reach"))
    pairs = both.where("after is not null").withColumn("h", lcp_length(F.col("Key"), F.col("after")))
    pairs = pairs.join(of("p"), ["Bucket", "p"]).join(of("q"), ["Bucket", "q"], "left")
    heavy = " or ".join(f"(h <= {c}_reach and at_{c} >= h)" for c in ("p", "q"))
    return pairs.where(heavy).select("Bucket", F.substring(F.col("Key"), F.lit(1), F.col("h")).alias("stem"), "Key", "after")


def trie(objects: DataFrame, budget: int) -> DataFrame:
    """The heavy nodes: (Bucket, stem, is_key, chars, n), the characters that follow the stem in order, and the objects
    at and below it, of which there are more than ``budget``."""
    cuts = cut(heavy_cuts(objects, budget))
    char = lambda c: F.substring(F.col(c), F.length("stem") + 1, F.lit(1))
    nodes = cuts.groupBy("Bucket", "stem").agg(F.max(F.col("Key") == F.col("stem")).alias("is_key"), F.sort_array(F.array_remove(F.array_distinct(F.flatten(F.collect_set(F.array(char("Key"), char("after"))))), "")).alias("chars"))
    return nodes.join(count_below(objects, nodes.select("Bucket", "stem")), ["Bucket", "stem"])


def count_below(objects: DataFrame, stems: DataFrame) -> DataFrame:
    """(Bucket, stem, n): the objects whose keys begin with each stem; stems may contain one another.

    A stem opens before the keys that begin with it and closes after them, so with stems and keys in one order it is the
    difference of two running counts; no key is copied for the stems that it is under.
    """
    keys = objects.groupBy("Bucket", "Key").agg(F.count("*").alias("w")).select("Bucket", F.col("Key").alias("s"), F.lit(1).alias("o"), "w", F.lit(None).cast("string").alias("stem"), F.lit(0).alias("sign"))
    edge = lambda at, o, sign: stems.select("Bucket", at.alias("s"), F.lit(o).alias("o"), F.lit(0).cast("long").alias("w"), "stem", F.lit(sign).alias("sign"))
    both = keys.union(edge(F.col("stem"), 0, -1)).union(edge(branch_end(F.col("stem")), 2, 1))
    ranges = cut(both.repartitionByRange("Bucket", "s", "o").withColumn("__part", F.spark_partition_id()))
    order = Window.partitionBy("Bucket").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ranges.groupBy("Bucket", "__part").agg(F.sum("w").alias("w")).select("Bucket", "__part", F.coalesce(F.sum("w").over(order), F.lit(0)).alias("__before"))
    own = Window.partitionBy("Bucket", "__part").orderBy("s", "o").rowsBetween(Window.unboundedPreceding, 0)
    rows = ranges.withColumn("__so_far", F.sum("w").over(own)).where("stem is not null").join(carried, ["Bucket", "__part"])
    return rows.groupBy("Bucket", "stem").agg(F.sum(F.col("sign") * (F.col("__before") + F.col("__so_far"))).alias("n"))


def bound(key: Column, after: Column) -> Column:
    """The shortest string that separates two neighbours: not below ``key``, below ``after``. Where the first characters
    that tell them apart are all of ``after``, that is ``key`` itself."""
    short = F.substring(after, F.lit(1), lcp_length(key, after) + 1)
    return F.when(short == after, key).otherwise(short)


def heavy_bounds(objects: DataFrame, budget: int) -> DataFrame:
    """(Bucket, bound): between any two of them lie ``budget`` objects at most, or those of one key."""
    return heavy_cuts(objects, budget).select("Bucket", bound(F.col("Key"), F.col("after")).alias("bound"))
