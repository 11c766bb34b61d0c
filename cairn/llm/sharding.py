"""Jump consistent hashing: keys to shards without a table of them, in Spark's own functions.

A key's path is the list of shards it lives in as shards are added one by one: of ``n`` shards it lives in the last one
on the path that is under ``n``. With one more shard it stays or goes to the new one, which it does with probability
``1 / (n + 1)``: no row moves between old shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.llm.common import stored

# fixed values: the generator of Lamping and Veach's jump consistent hash
FACTOR, TOP = 2862933555777941757, 1 << 64

_WIDE = "decimal(38,0)"


def _wide(x: int) -> Column:
    return F.lit(str(x)).cast(_WIDE)


def path(key: Column, shards: int) -> Column:
    """The shards, ascending, that ``key`` (whole numbers; null is as 0) lives in while their number grows to ``shards``.

    Other keys can be hashed first (``xxhash64``). A path has about ``ln(shards)`` entries, so a few dozen steps end
    nearly all; the rest take one step for each shard, which always is enough.
    """

    def step(s: Column, _: Column) -> Column:
        k = (s["key"] * _wide(FACTOR) + 1) % _wide(TOP)
        high = F.floor(k / _wide(1 << 33)).cast("double")
        at = F.floor((s["at"] + 1) * (F.lit(float(1 << 31)) / (high + 1)))
        more = F.struct(k.cast(_WIDE).alias("key"), at.alias("at"), F.concat(s["path"], F.array(at)).alias("path"))
        return F.when(s["at"] < shards, more).otherwise(s)

    def walked(steps: int) -> Column:
        wide = F.coalesce(key, F.lit(0)).cast("long").cast(_WIDE)
        start = F.struct(F.when(wide < 0, wide + _wide(TOP)).otherwise(wide).cast(_WIDE).alias("key"), F.lit(0).cast("long").alias("at"), F.array(F.lit(0).cast("long")).alias("path"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step)

    few = min(shards, 32)
    ends = walked(few)
    if few < shards:
        ends = F.when(ends["at"] < shards, walked(shards)).otherwise(ends)
    return F.filter(ends["path"], lambda x: x < shards)


def shard_of(path: Column, shards: int) -> Column:
    """Where a key with this path lives among ``shards`` shards, at most as many as the path was made for."""
    return F.element_at(F.filter(path, lambda x: x < shards), -1).cast("int")


def assign(docs: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``shard`` and ``grown_shard``, the shard with one more of them. A map: nothing is shuffled.

    Both follow from the key and the number of shards alone, so rows of one key are in one shard; null keys count as
    0. Columns of these names are replaced.
    """
    rows = docs.withColumn("__path", path(F.col(key), shards + 1))
    return rows.withColumn("shard", shard_of(F.col("__path"), shards)).withColumn("grown_shard", shard_of(F.col("__path"), shards + 1)).drop("__path")


def slots(docs: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's place: (key, size, text_crc32, law, shard, slot, grown_shard, text_md5).

    ``size``: bytes of the text in UTF-8, plus 1; a null text has none and the checksum of an empty one. ``slot``: the
    row's number in its shard, from 0, in the order of the text's digest and the key, so equal texts of a shard stand
    side by side whatever the files looked like; rows that are equal in both come in any order. Texts are
    read once and not shuffled. Ranges over (shard, digest, key, row) split shards, groups of equal texts and
    repeated keys alike; a range's first slot follows from the counts of the ranges before it.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = assign(docs.select(F.col(key).alias("__key"), body.alias("__text")), shards, "__key", "__text")
    rows = rows.select(
        "__key", (F.octet_length("__text") + 1).cast("long").alias("size"), F.crc32(F.encode("__text", "UTF-8")).alias("text_crc32"),
        "shard", "grown_shard", F.md5(F.encode("__text", "UTF-8")).alias("text_md5"), F.monotonically_increasing_id().alias("__row"),
    )
    order = ["shard", "text_md5", "__key", "__row"]
    sorted_ = stored(stored(rows).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id()))
    place = F.shiftright("__id", 33)  # the number of the range: one has under 2^33 rows
    ranges = sorted_.groupBy("shard", place.alias("__range")).agg(F.count("*").alias("n"), F.min("__id").alias("__first"))
    before = Window.partitionBy("shard").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    offsets = ranges.select("shard", "__range", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("__first")).alias("__shift"))
    # as many offsets as ranges and shards, whatever the rows: a few numbers for each task of the sort
    placed = sorted_.withColumn("__range", place).join(F.broadcast(offsets), ["shard", "__range"])
    return placed.select(
        F.col("__key").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("__id") + F.col("__shift")).alias("slot"), "grown_shard", "text_md5",
    )


def moves(docs: DataFrame, shards: int, grown: int, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that must be copied when ``shards`` shards become ``grown`` ones, with ``shard`` and
    ``new_shard``; all the others stay where they are."""
    rows = docs.withColumn("__path", path(F.col(key), max(shards, grown)))
    rows = rows.withColumn("shard", shard_of(F.col("__path"), shards)).withColumn("new_shard", shard_of(F.col("__path"), grown))
    return rows.where("shard <> new_shard").drop("__path")


def write(docs: DataFrame, folder: str, shards: int = 8, key: str = "doc_id", files: int = 1) -> None:
    """``docs`` as Parquet, one folder ``shard=n`` for each shard with ``files`` files each, or fewer."""
    rows = assign(docs, shards, key).drop("grown_shard")
    salt = F.pmod(F.xxhash64(*docs.columns), F.lit(files))
    rows.repartition(shards * files, "shard", salt).write.partitionBy("shard").parquet(folder)
