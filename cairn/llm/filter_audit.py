"""What five document filters remove in each order of them, kept up to date as files of documents arrive.

A stream reads the files in available-now micro-batches. A text's own failures are a mask of four bits; the fifth says
that a smaller id has the same text, which later files can change. Keyed state holds the smallest id of each text: when
a smaller one arrives, the counters get back what they had for the earlier one (minus its old mask, plus the new).
Counters (part, mask, good, toxic) answer every order of the filters, so no order is ever run.
"""

from __future__ import annotations

import hashlib
import itertools
import pickle
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cairn.llm.common import parts, shared_folder, tidy

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
#: Texts of a task that are compared with each other before they are sent on; texts of a state entry, on average, at
#: first; micro-batches of one run, at least, if there are as many files.
HELD, TOGETHER, BATCHES = 100_000, 128, 4
_UPPER, _SIGNS, _INNER = bytes(range(65, 91)), b"#$%&*|", bytes(range(128, 192))

COUNTERS = "part string, mask int, good boolean, toxic boolean, n long"
_FACTS = "bucket int, digest binary, id long, known boolean, part string, mask int, n long"
_CHANGES = "id long, known boolean, part string, mask int, n long"


def mask_of(raw: bytes) -> int:
    """The failures of a text in UTF-8, all but E: A under 200 words; B fewer than half of the words distinct; C over 2 %
    of the characters A to Z; D one of ``#$%&*|``. Words are runs of other bytes than space and 9 to 13."""
    words = raw.split()
    a, b = len(words) < 200, 100 * len(set(words)) < 50 * len(words)
    c = 100 * (len(raw) - len(raw.translate(None, _UPPER))) > 2 * len(raw.translate(None, _INNER))
    return a | b << 1 | c << 2 | (len(raw) != len(raw.translate(None, _SIGNS))) << 3


def _facts(buckets: int):
    """Rows (id, text, part) as facts. Copies in a task meet here: of each text only its smallest id goes to the state;
    the others fail E whatever comes, and null ids, which nothing is smaller than, pass it. Both are dealt over all
    buckets, so no text has more rows in its bucket than there are tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[bytes, list] = {}  # digest: id, mask, rows by part
        out, turn = [], 0

        def settled(id_: int | None, part: str, mask: int, n: int) -> None:
            nonlocal turn
            turn += 1
            out.append((turn % buckets, None, id_ or 0, id_ is not None, part, mask, n))

        def flush() -> None:
            for digest, (id_, mask, rows) in least.items():
                bucket = int.from_bytes(digest[:8], "little") % buckets
                out.extend((bucket, digest, id_, True, part, mask, n) for part, n in rows.items())
            least.clear()

        for b in parts(batches):
            for id_, raw, part in zip(b.column("id").to_pylist(), b.column("text").cast(pa.binary()).to_pylist(), b.column("part").to_pylist(), strict=True):
                digest, mask = hashlib.blake2b(raw, digest_size=16).digest(), mask_of(raw)
                if not turn:
                    turn = int.from_bytes(digest[:4], "little")  # tasks begin at different buckets
                have = least.get(digest)
                if id_ is None:
                    settled(id_, part, mask, 1)
                elif have is None:
                    least[digest] = [id_, mask, {part: 1}]
                elif id_ == have[0]:
                    have[2][part] = have[2].get(part, 0) + 1
                elif id_ > have[0]:
                    settled(id_, part, mask | COPY, 1)
                else:
                    for p, n in have[2].items():
                        settled(have[0], p, mask | COPY, n)
                    least[digest] = [id_, mask, {part: 1}]
            if len(least) >= HELD:
                flush()
            if len(out) >= 10_000:
                yield _batch(out)
                out.clear()
        flush()
        for at in range(0, len(out), 10_000):
            yield _batch(out[at : at + 10_000])

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (("bucket", pa.int32()), ("digest", pa.binary()), ("id", pa.int64()), ("known", pa.bool_()), ("part", pa.string()), ("mask", pa.int32()), ("n", pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*rows, strict=True), kinds, strict=True)], [n for n, _ in kinds])


def _fold(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """A bucket's state: of each text the smallest id so far, with its rows by part. Gives changes of the counters."""
    held: dict[bytes, tuple[int, dict[str, int]]] = pickle.loads(state.get[0]) if state.exists else {}
    for frame in frames:
        out: list[tuple] = []
        for digest, id_, known, part, mask, n in frame[["digest", "id", "known", "part", "mask", "n"]].itertuples(index=False, name=None):
            have = None if digest is None else held.get(digest)
            if digest is None:
                out.append((id_, known, part, mask, n))
            elif have and id_ > have[0]:
                out.append((id_, True, part, mask | COPY, n))
            else:
                if have and id_ < have[0]:  # take back what the earlier id was counted as
                    for p, k in have[1].items():
                        out += [(have[0], True, p, mask, -k), (have[0], True, p, mask | COPY, k)]
                    have = None
                rows = have[1] if have else {}
                rows[part] = rows.get(part, 0) + n
                held[digest] = (id_, rows)
                out.append((id_, True, part, mask, n))
        yield pd.DataFrame(out, columns=["id", "known", "part", "mask", "n"])
    state.update((pickle.dumps(held),))


def _path(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def update(spark: SparkSession, path: str, labels: DataFrame, folder: str, id_: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """Count the Parquet files at ``path`` that ``folder``, in the cluster's shared storage, hasn't counted yet; all counters so far, one row for each
    (part, mask, good, toxic) that has documents.

    ``folder`` holds the stream's progress, its state and the counters; a run that was stopped goes on where it was, and a
    batch that is run again replaces its counters. Labels (doc_id, quality, toxic) are read for each micro-batch as they are
    then; repeated ones count if any says 1. Null texts and parts are empty. The state is spread over
    ``spark.sql.shuffle.partitions`` stores, which the first run fixes, some 100 bytes for each different text; the
    session's ``spark.sql.streaming.stateStore.providerClass`` says where they live (memory, or RocksDB for large corpora).
    """
    docs = spark.read.parquet(path)
    fs, settings = _path(spark, f"{folder}/settings")
    if not fs.exists(settings):
        spark.range(1).select(F.lit(max(1, -(-docs.count() // TOGETHER))).alias("buckets")).write.json(f"{folder}/settings")
        spark.createDataFrame([], COUNTERS).write.parquet(f"{folder}/counters/batch=-1")
    buckets = spark.read.schema("buckets int").json(f"{folder}/settings").collect()[0].buckets
    fs, where = _path(spark, path)
    per_batch = max(1, -(-fs.getContentSummary(where).getFileCount() // BATCHES))
    # a stream's path must be a folder or a pattern
    source = f"{path[:-1]}[{path[-1]}]" if fs.getFileStatus(where).isFile() else path
    rows = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", per_batch).parquet(source)
    rows = rows.select(F.col(id_).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"))
    facts = rows.mapInArrow(tidy(_facts(buckets)), _FACTS)
    changes = facts.groupBy("bucket").applyInPandasWithState(_fold, _CHANGES, "held binary", "append", GroupStateTimeout.NoTimeout)
    flags = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")).where("good or toxic")

    def count(batch: DataFrame, number: int) -> None:
        # rows of one id are summed before they meet its label: at most 32 for each part
        few = batch.groupBy("id", "known", "part", "mask").agg(F.sum("n").alias("n")).where("n <> 0").withColumn("id", F.when(F.col("known"), F.col("id")))
        met = few.join(flags, "id", "left").groupBy("part", "mask", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
        met.agg(F.sum("n").alias("n")).write.mode("overwrite").parquet(f"{folder}/counters/batch={number}")

    stream = changes.writeStream.foreachBatch(count).option("checkpointLocation", f"{folder}/stream").trigger(availableNow=True)
    _started(spark, stream, settings.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme()).awaitTermination()
    found = spark.read.schema(COUNTERS).parquet(f"{folder}/counters").groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
    return found.where("n <> 0")


def _started(spark: SparkSession, stream: DataStreamWriter, scheme: str) -> StreamingQuery:
    """The stream, started. In local files its progress and state are written through Hadoop's older interface: the newer one
    starts several processes for each file there, and there are some for each store and micro-batch."""
    key, before = "spark.sql.streaming.checkpointFileManagerClass", spark.conf.get("spark.sql.streaming.checkpointFileManagerClass", None)
    if scheme != "file" or before:
        return stream.start()
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager")
    try:
        return stream.start()
    finally:
        spark.conf.unset(key)


def report(counters: DataFrame) -> DataFrame:
    """A row for each part, order of the filters (as a word) and step: documents kept after it, removed by it, redundant
    (fail its filter, but an earlier one too), unique_fails (fail no other filter), good_lost and toxic_lost (of the
    removed), and shapley: what its filter removes, over all orders. A part has some hundred counters, so an order is
    a few sums over them."""
    masks = range(1 << len(FILTERS))
    of = lambda test: F.array(*(F.coalesce(F.sum(F.when((F.col("mask") == m) & test, F.col("n"))), F.lit(0)) for m in masks))
    by_part = counters.groupBy("part").agg(of(F.lit(True)).alias("all"), of(F.col("good")).alias("good"), of(F.col("toxic")).alias("bad"))
    orders = ",".join("".join(o) for o in itertools.permutations(FILTERS))
    rows = by_part.withColumn("filter_order", F.explode(F.split(F.lit(orders), ","))).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    bits = lambda test: sum((F.when(test(F.instr("filter_order", f)), 1 << i).otherwise(0) for i, f in enumerate(FILTERS)), F.lit(0))
    rows = rows.withColumn("own", bits(lambda at: at == F.col("step"))).withColumn("earlier", bits(lambda at: at < F.col("step")))

    def total(column: str, test, times=lambda m: F.lit(1)) -> Column:
        step = lambda s, m: s + F.when(test(m), F.element_at(F.col(column), m + 1) * times(m)).otherwise(0)
        return F.aggregate(F.sequence(F.lit(0), F.lit(len(masks) - 1)), F.lit(0).cast("long"), step)

    own, earlier = F.col("own"), F.col("earlier")
    fails = lambda m: m.bitwiseAND(own) > 0
    removed = lambda m: fails(m) & (m.bitwiseAND(earlier) == 0)
    share = lambda m: F.floor(F.lit(120) / F.bit_count(m)).cast("long")  # noqa: E731  of the orders put this failure before the others
    return rows.select(
        "part", "filter_order", "step", total("all", lambda m: m.bitwiseAND(own.bitwiseOR(earlier)) == 0).alias("kept"), total("all", removed).alias("removed"),
        total("all", lambda m: fails(m) & (m.bitwiseAND(earlier) > 0)).alias("redundant"), F.element_at("all", own + 1).alias("unique_fails"),
        total("good", removed).alias("good_lost"), total("bad", removed).alias("toxic_lost"), total("all", fails, share).alias("shapley"),
    )


def audit(spark: SparkSession, path: str, labels: DataFrame, **columns: str) -> DataFrame:
    """``report`` of the documents at ``path``, by a stream whose progress is dropped when it has ended."""
    folder = f"{shared_folder(spark)}/audit-{uuid.uuid4().hex}"
    found = report(update(spark, path, labels, folder, **columns))
    fs, stream = _path(spark, f"{folder}/stream")
    fs.delete(stream, True)
    return found
