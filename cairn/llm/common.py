"""What several of the text operators share: lineage cuts, components, sorted runs, id filters."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cairn.session import cut, shared_folder

__all__ = ["cut", "shared_folder"]


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder as Parquet and read again: a cut for large tables, compressed."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, most: int = 100_000, rows: int | None = None) -> DataFrame:
    """``df``, a materialised table of short rows, for the side of a join: broadcast if it has at most ``most`` rows, else
    left to the planner, which shuffles and splits skewed keys at run time. ``rows``: as many at most, if that is known."""
    return F.broadcast(df) if (df.count() if rows is None else rows) <= most else df


#: Rows of a task, where a table of short rows is read again.
ROWS = 20_000


def tasks(rows: int) -> int:
    """Tasks for so many short rows. The driver keeps some KB for each task, of however few rows."""
    return max(1, -(-rows // ROWS))


def counted(df: DataFrame) -> tuple[DataFrame, int]:
    """``df``, a table of short rows, materialised by ``cut``, and its rows, counted by the job that writes them. Its tasks
    follow its rows from then on, also where Spark doesn't coalesce partitions."""
    seen = Observation()
    df = cut(df.observe(seen, F.count(F.lit(1)).alias("n")))
    n = int(seen.get["n"])
    return df.coalesce(tasks(n)), n


#: Rows that go to a Python worker at once, at most; a row holds a document's text or its shingles.
BATCH = 500


def short_batches(spark: SparkSession) -> None:
    """From now on at most BATCH rows of a task are in transit to its Python worker: with Spark's 10,000, some 40 MB of shingles lie in the
    JVM's direct memory, in Arrow's and as Python's objects, each. A smaller number that is set stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= BATCH:
        spark.conf.set(name, BATCH)


def tidy(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work`` for mapInArrow, after which the task's free memory goes back to the system: workers outlive their tasks,
    and an executor has several at once."""

    def worked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU C library has it
        if trim:
            trim(0)

    return worked


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Edges that a task of ``components`` holds at most, on average.
EDGES = 200_000
#: Tables of so many short rows are broadcast to joins.
FEW = 20_000


def components(edges: DataFrame, first: str = "a", second: str = "b") -> DataFrame:
    """Connected components of undirected ``edges``: rows ``(node, component)``, component = the smallest node.

    Nodes without an edge are absent. Each round maps every node to the least of its closed neighbourhood (by id
    at first, by a fresh hash later, so that paths shrink by a constant share) and contracts the edges; all rounds
    are joins and map-side combined aggregates, so a node with very many links is never gathered in one task. The
    number of tasks follows the number of edges that are left; hops of up to FEW nodes are broadcast.
    Loops, repeated and reversed edges and null ends are harmless.
    """
    # the round is a column, so that all rounds but the first run the same generated code
    e, left = counted(
        edges.select(F.col(first).cast("long").alias("a"), F.col(second).cast("long").alias("b"))
        .where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.lit(1).alias("turn"))
    )
    hops: list[tuple[DataFrame, int]] = []
    while left:
        most = -(-left // EDGES)
        rank = (lambda c: F.col(c)) if not hops else (lambda c: F.xxhash64("turn", c))
        ends = F.inline(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("other")), F.struct(F.col("b").alias("node"), F.col("a").alias("other"))))
        near = e.coalesce(most).select("turn", ends).select("node", "other", rank("node").alias("own"), rank("other").alias("rank"))
        near = near.groupBy("node").agg(F.min("own").alias("own"), F.min("rank").alias("rank"), F.min_by("other", "rank").alias("other"))
        hop, n = counted(near.coalesce(most).select("node", F.when(F.col("rank") < F.col("own"), F.col("other")).otherwise(F.col("node")).alias("to")))
        hops.append((hop, n))
        x, y = (small(hop.select(F.col("node").alias(c), F.col("to").alias(t)), FEW, n) for c, t in (("a", "x"), ("b", "y")))
        e = e.join(x, "a").coalesce(most).join(y, "b").coalesce(most).where("x <> y")
        e, left = counted(e.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), (F.col("turn") + 1).alias("turn")))
    if not hops:
        return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found, n = hops[-1]
    for hop, more in reversed(hops[:-1]):  # from the few nodes of the last round to all
        later = small(found.select(F.col("node").alias("to"), F.col("to").alias("next")), FEW, n)
        found, n = hop.join(later, "to", "left").select("node", F.coalesce("next", "to").alias("to")), more
    if len(hops) == 1:  # the first round's targets are the smallest nodes already
        return found.select("node", F.col("to").alias("component"))
    found, n = counted(found.coalesce(tasks(n)))
    least = found.groupBy("to").agg(F.min("node").alias("low")).coalesce(tasks(n))
    return found.join(small(least, FEW, n), "to").select("node", F.least("low", "to").alias("component"))


BITS = 1 << 22


def mark(df: DataFrame, column: str, ids: DataFrame, out: str = "__hit", bits: int = BITS) -> DataFrame:
    """``df`` with the boolean ``out``: true for every row whose ``column`` is in ``ids``, and for few others.

    To spare rows a shuffle before an exact join. ``ids`` (one column of integers) become a bit map of fixed size
    over hashed ids, at most ``bits / 32768`` rows of 4 KB (512 KB in all) whatever the input, which is broadcast;
    when it fills up at scale it lets more rows through and the join that follows decides alike.
    """
    spot = lambda c: F.pmod(F.xxhash64(c.cast("long")), F.lit(bits)) + 1
    own = spot(F.col(ids.columns[0]))
    maps = ids.select(own.alias("s")).groupBy(F.bitmap_bucket_number("s").alias("__bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("__map")).coalesce(8)
    at = F.bitmap_bit_position(spot(F.col(column)))
    byte = F.conv(F.hex(F.substring("__map", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("getbit", byte, (at % 8).cast("int")) == 1
    marked = df.withColumn("__bucket", F.bitmap_bucket_number(spot(F.col(column)))).join(F.broadcast(maps), "__bucket", "left")
    return marked.select(*df.columns, F.coalesce(bit, F.lit(False)).alias(out))


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Batches of a partition sorted by ``keys`` regrouped: a table ends only where the keys change."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if held and not _same(held[-1], batch, keys):
            yield pa.Table.from_batches(held)
            held = []
        ends = changes(batch, keys)
        if len(ends) > 1:
            last = int(ends[-1])
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = [batch.slice(last)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def changes(batch, keys: list[str]) -> np.ndarray:
    """Row numbers at which the keys change, 0 first."""
    new = np.zeros(batch.num_rows, bool)
    if batch.num_rows:
        new[0] = True
    for k in keys:
        v = batch.column(k).to_numpy(zero_copy_only=False) if isinstance(batch, pa.RecordBatch) else batch.column(k).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def _same(one: pa.RecordBatch, two: pa.RecordBatch, keys: list[str]) -> bool:
    return all(one.column(k)[one.num_rows - 1].as_py() == two.column(k)[0].as_py() for k in keys)


def mix(x: np.ndarray) -> np.ndarray:
    """The finishing steps of splitmix64 on unsigned 64-bit integers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_IN_WORD = np.array([i >= 128 or chr(i).isalnum() or i == 95 for i in range(256)])
_powers = np.ones(1, np.uint64)


def _power(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        with np.errstate(over="ignore"):
            _powers = np.cumprod(np.append(np.uint64(1), np.full(max(n, 2 * len(_powers)), 0xD1342543DE82EF95, np.uint64)), dtype=np.uint64)
    return _powers


def lower(text: str) -> str:
    return text.replace("\u0130", "i").lower()  # the one letter that gets longer


class Words:
    """The words of some texts side by side: 64-bit hashes, and where they stand.

    A word is a run of ASCII letters, digits, underscores and characters beyond ASCII, in lower case.
    """

    def __init__(self, texts: list[str | None]):
        self.n_texts = len(texts)
        raw = [lower(t).encode("utf-8", "surrogatepass") if t else b"" for t in texts]
        self.bytes = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
        ends = np.cumsum([len(r) + 1 for r in raw], dtype=np.int64)
        self.text_start = np.append(np.int64(0), ends[:-1]) if raw else ends
        word = _IN_WORD[self.bytes]
        edges = np.flatnonzero(np.diff(word, prepend=False))  # the last byte is a line feed: edges come in pairs
        self.start, self.end = edges[::2], edges[1::2]
        size = self.end - self.start
        at = np.flatnonzero(word)
        first = np.cumsum(size) - size
        place = np.arange(len(at)) - np.repeat(first, size)
        with np.errstate(over="ignore"):
            letters = _BYTE[self.bytes[at]] * _power(int(size.max(initial=0)) + 1)[place]
            self.hash = mix(np.add.reduceat(letters, first) + size.astype(np.uint64)) if len(first) else np.zeros(0, np.uint64)
        self.text = np.searchsorted(ends, self.start, "right")
        self.count = np.bincount(self.text, minlength=self.n_texts)
        self.first = np.cumsum(self.count) - self.count

    def lines(self) -> np.ndarray:
        """The number of the line of each word; texts are lines of their own."""
        return np.searchsorted(np.flatnonzero(self.bytes == 10), self.start)

    def points(self) -> np.ndarray:
        """Code points before each byte."""
        return np.cumsum((self.bytes & 0xC0) != 0x80) - 1

    def shingles(self, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the runs of ``size`` words of each text, and how many each has: one of all words if fewer."""
        n = len(self.hash)
        count = np.where(self.count >= size, self.count - size + 1, np.minimum(self.count, 1))
        if not n:
            return self.hash, count
        whole = run_hashes(self.hash, size)
        keep = np.repeat(self.first + count, self.count) > np.arange(n)
        short = (self.count > 0) & (self.count < size)
        for i in np.flatnonzero(short):
            whole[self.first[i]] = run_hashes(self.hash[self.first[i] : self.first[i] + self.count[i]], int(self.count[i]))[0]
        return whole[keep], count


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` words from each place on; at the end, of the words that are left and zeros."""
    with np.errstate(over="ignore"):
        h = np.zeros(len(words), np.uint64)
        for i in range(size):
            h = h * np.uint64(0x9E3779B97F4A7C15) + np.append(words[i:], np.zeros(min(i, len(words)), np.uint64))
    return mix(h)


def parts(batches: Iterator[pa.RecordBatch], size: int = 300, most: int = 1 << 18, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Batches of at most ``size`` rows and about ``most`` bytes of text: a longer text stands alone."""
    for b in batches:
        bytes_ = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy()
        lo = held = 0
        for hi, n in enumerate(bytes_.tolist()):
            if hi > lo and (hi - lo == size or held + n > most):
                yield b.slice(lo, hi - lo)
                lo, held = hi, 0
            held += n
        if b.num_rows > lo:
            yield b.slice(lo)
