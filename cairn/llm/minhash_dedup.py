"""Near-duplicate documents: consistent weighted samples of TF-IDF shingles, banded, verified by weighted Jaccard."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairn.llm.common import FEW, Words, components, counted, mark, mix, partitions, parts, short_batches, small, tasks, tidy

#: Width of the table of hashed document frequencies. A bucket's count is at most (shingles in all) / WIDTH over the
#: true one on average, 0.2 % of the documents at 500 shingles each, at every size of the corpus.
WIDTH = 1 << 18
#: Tasks' counts are added in so many groups first.
GROUPS = 256
#: This share of the documents is added to every document frequency, so that copies stay alike when thousands share
#: their shingles: what all documents hold weighs half of what one holds.
SMOOTH = 0.1


def plan_bands(threshold: float, recall: float, rows: int) -> int:
    """Bands of ``rows`` samples with which pairs at ``threshold`` meet with probability ``recall``."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)))


def idf(df: np.ndarray, n: int) -> np.ndarray:
    return np.log(math.e + max(n, 1) / (df + SMOOTH * max(n, 1)))


class Sampler:
    """Ioffe's improved consistent weighted sampling, its Gamma and uniform variates drawn from tables by hash bits."""

    def __init__(self, size: int, seed: int = 11):
        g = np.random.default_rng(seed)
        self.r = g.gamma(2.0, 1.0, 1 << 16).astype(np.float32)
        self.ln_c = np.log(g.gamma(2.0, 1.0, 1 << 16)).astype(np.float32)
        self.beta = g.random(1 << 16).astype(np.float32)
        self.seeds = mix(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[:, None]

    def __call__(self, keys: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """One hash for each sample, of the element chosen and its quantised weight."""
        ln_w = np.log(weights).astype(np.float32)
        best, chosen = np.full(len(self.seeds), np.inf, np.float32), np.zeros(len(self.seeds), np.uint64)
        row = np.arange(len(self.seeds))
        for lo in range(0, len(keys), 1024):
            k = keys[lo : lo + 1024]
            with np.errstate(over="ignore"):
                h = (k[None, :] ^ self.seeds) * np.uint64(0xD6E8FEB86659FD93)
                h ^= h >> np.uint64(32)
            lanes = h.view(np.uint16).reshape(*h.shape, 4)
            r, beta = self.r[lanes[..., 0]], self.beta[lanes[..., 1]]
            t = np.floor(ln_w[None, lo : lo + 1024] / r + beta)
            ln_a = self.ln_c[lanes[..., 2]] - r * (t - beta) - r
            at = ln_a.argmin(1)
            low = ln_a[row, at]
            better = low < best
            best = np.where(better, low, best)
            with np.errstate(over="ignore"):
                element = mix(k[at] + t[row, at].astype(np.int64).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
            chosen = np.where(better, element, chosen)
        return chosen


def document_frequencies(docs: DataFrame, size: int = 5, width: int = WIDTH) -> tuple[np.ndarray, int]:
    """Documents that hold a shingle of each hash bucket, and documents: each task counts all its texts, Spark adds
    the counts.

    The result has ``width`` numbers (1 MB), whatever the corpus.
    """
    piece = 1 << 12

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(width, np.int64), 0
        for b in parts(batches):
            n += b.num_rows
            hashes, count = Words(b.column("text").to_pylist()).shingles(size)
            own = np.repeat(np.arange(len(count)), count)
            total += np.bincount(np.unique(own * width + (hashes & np.uint64(width - 1)).astype(np.int64)) % width, minlength=width)
        if n:
            own = TaskContext.get().partitionId() % GROUPS
            rows = [*total.astype(np.int32).reshape(-1, piece), np.pad(np.array([n], np.int32), (0, piece - 1))]
            rows = [r.astype(np.int64).tobytes() for r in rows]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(rows), dtype=np.int32)), pa.array([own] * len(rows), pa.int32()), pa.array(rows, pa.binary())], ["k", "g", "counts"])

    def added(key: tuple, table: pa.Table) -> pa.Table:
        total = np.zeros(piece, np.int64)
        for x in table.column("counts"):
            total += np.frombuffer(x.as_buffer(), np.int64)
        return pa.table({"k": pa.array([key[0].as_py()], pa.int32()), "g": pa.array([key[1].as_py() if len(key) > 1 else 0], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros((width // piece + 1, piece), np.int64)
    kind = "k int, g int, counts binary"
    some = docs.select("text").mapInArrow(tidy(counted), kind).groupBy("k", "g").applyInArrow(added, kind)  # a GROUPS-th of the tasks
    for r in some.groupBy("k").applyInArrow(added, kind).coalesce(16).collect():
        out[r.k] = np.frombuffer(bytes(r.counts), np.int64)
    return out[:-1].ravel(), int(out[-1, 0])


def near_documents(docs: DataFrame, threshold: float = 0.8, recall: float = 0.99, rows: int = 3, size: int = 5, rounds: int = 1, chunk: int = 512) -> DataFrame:
    """Rows ``(doc_id, class_id, component_id, n_copies, kept)``, one for each distinct doc_id.

    Texts are lower-case words; equal word sequences are one class (``class_id`` = its smallest doc_id, ``n_copies``
    its documents). Classes are linked if the weighted Jaccard similarity of their shingles, term frequency times
    inverse document frequency, is at least ``threshold``; ``component_id`` is the smallest doc_id reachable by
    links and the one that is kept. Texts without a word (null, empty) are no copies of one another and are kept;
    texts of fewer than ``size`` words are one shingle. Rows without an id are left out; rows that repeat a doc_id
    count as one document; should their texts differ, the one of the smallest hash is sketched and a pair counts as
    similar if any of the texts is. Other columns are not read.
    """
    spark = docs.sparkSession
    short_batches(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).where("doc_id is not null")
    frequency, n_docs = document_frequencies(texts, size)
    weigh = spark.sparkContext.broadcast(idf(frequency, n_docs).astype(np.float32))
    bands = plan_bands(threshold, recall, rows)

    def bag(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = np.unique(s, return_counts=True)
        return keys, counts * weigh.value[(keys & np.uint64(WIDTH - 1)).astype(np.intp)]

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample, seen = Sampler(bands * rows), {}
        for b in parts(batches):
            w = Words(b.column("text").to_pylist())
            hashes, count = w.shingles(size)
            ends = np.cumsum(count)
            place = (np.arange(len(w.hash)) - np.repeat(w.first, w.count) + 1).astype(np.uint64)
            whole = np.flatnonzero(w.count)
            k1, k2 = np.zeros(w.n_texts, np.uint64), np.zeros(w.n_texts, np.uint64)
            with np.errstate(over="ignore"):
                for k, m in ((k1, 0x9E3779B97F4A7C15), (k2, 0xC2B2AE3D27D4EB4F)):
                    if len(whole):
                        k[whole] = np.add.reduceat(mix(w.hash ^ (place * np.uint64(m))), w.first[whole])
            keys = []
            for i, own in enumerate(zip(k1.tolist(), k2.tolist(), strict=True)):
                if len(seen) > 20_000:
                    seen.clear()
                if not count[i]:
                    keys.append([])
                    continue
                if own not in seen:
                    chosen = sample(*bag(hashes[ends[i] - count[i] : ends[i]])).reshape(bands, rows)
                    with np.errstate(over="ignore"):
                        folded = mix((chosen * (2 * np.arange(1, rows + 1, dtype=np.uint64) + np.uint64(1))).sum(1, dtype=np.uint64) + np.arange(1, bands + 1, dtype=np.uint64))
                    seen[own] = folded.astype(np.int64).tolist()
                keys.append(seen[own])
            as_long = lambda x: pa.array(x.astype(np.int64))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), as_long(k1), as_long(k2), pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "k1", "k2", "keys"])

    sketch = texts.mapInArrow(tidy(sketched), "doc_id long, k1 long, k2 long, keys array<long>")
    sketch, n_docs = counted(sketch.groupBy("doc_id").agg(F.min(F.struct("k1", "k2", "keys")).alias("m")).select("doc_id", "m.*").coalesce(tasks(n_docs)))
    blank = F.size("keys") == 0
    classes, n_classes = counted(sketch.where(~blank).groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n"), F.min("keys").alias("keys")).coalesce(tasks(n_docs)))
    bucketed = classes.select("rep", F.explode("keys").alias("key"))
    shared = bucketed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    places, n_places = counted(bucketed.join(shared, "key").select("key", "rep", F.col("rep").alias("component")).coalesce(tasks(n_classes * bands)))

    def bags_of(ids: DataFrame, most: int) -> DataFrame:
        """(doc_id, bag) of the given ids, at most ``most``: sorted shingle hashes, made anew from the texts."""
        ids, n = counted(ids.select("doc_id").distinct().coalesce(tasks(most)))

        def bagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in parts(batches):
                hashes, count = Words(b.column("text").to_pylist()).shingles(size)
                bags = [np.sort(s).tobytes() for s in np.split(hashes, np.cumsum(count)[:-1])]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(bags, pa.binary())], ["doc_id", "bag"])

        some = mark(texts, "doc_id", ids).where("__hit").select("doc_id", "text")
        return some.join(small(ids, FEW, n), "doc_id", "left_semi").mapInArrow(tidy(bagged), "doc_id long, bag binary")

    def alike(one: tuple, two: tuple) -> bool:
        (k, w, total), (k2, w2, total2) = one, two
        if min(total, total2) < threshold * max(total, total2):
            return False
        _, i, j = np.intersect1d(k, k2, assume_unique=True, return_indices=True)
        both = np.minimum(w[i], w2[j]).sum(dtype=np.float64)
        return bool(both >= threshold * (total + total2 - both) - 1e-9)

    def weighed(raw: bytes) -> tuple:
        k, w = bag(np.frombuffer(raw, np.uint64))
        return k, w, w.sum(dtype=np.float64)

    def with_head(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are similar. The many partners of one ``a`` are dealt to parts of 256."""
        salted = pairs.select("a", "b").distinct().coalesce(tasks(n_places)).withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(16)).cast("int"))
        part = F.floor(F.row_number().over(Window.partitionBy("a", "salt").orderBy("b")) / 256)
        dealt, n = counted(salted.withColumn("part", part).coalesce(tasks(n_places)))
        keys = ["a", "salt", "part"]
        ends = dealt.select(F.col("b").alias("doc_id"), *keys, F.lit(1).alias("side")).union(dealt.select(F.col("a").alias("doc_id"), *keys, F.lit(0).alias("side")).distinct())
        ends, n = counted(ends.coalesce(tasks(2 * n)))
        sides = small(ends, FEW, n).join(bags_of(ends, n), "doc_id").repartition(partitions(spark), *keys).sortWithinPartitions(*keys, "side", "doc_id")

        def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            head, key = None, None
            for batch in batches:
                a_s, b_s = [], []
                for *k, side, doc, raw in zip(*(batch.column(c).to_pylist() for c in (*keys, "side", "doc_id", "bag")), strict=True):
                    if side == 0:
                        head, key = weighed(raw), k
                    elif key == k and alike(head, weighed(raw)):
                        a_s.append(k[0])
                        b_s.append(doc)
                yield pa.RecordBatch.from_arrays([pa.array(a_s, pa.int64()), pa.array(b_s, pa.int64())], ["a", "b"])

        return sides.mapInArrow(tidy(compared), "a long, b long")

    def in_full(places: DataFrame) -> DataFrame:
        """All similar pairs across components of each bucket, in groups of bounded size, a task for each.

        The members of a bucket's largest component are dealt to chunks, one copy of each; the other members meet
        every such chunk, and one another by pairs of chunks of their own.
        """
        of = places.groupBy("key", "component").agg(F.count("*").alias("n"))
        main = of.groupBy("key").agg(F.max(F.struct("n", "component")).alias("m"), F.sum("n").alias("all")).select("key", F.col("m.component").alias("main"), F.ceil(F.col("m.n") / chunk).cast("int").alias("pm"), F.ceil((F.col("all") - F.col("m.n")) / chunk).cast("int").alias("po"))
        rows, _ = counted(places.join(main, "key").withColumn("h", F.xxhash64("rep")).coalesce(tasks(n_places)))
        inner = rows.where("component = main").select("key", F.lit(-1).alias("lo"), F.pmod("h", "pm").cast("int").alias("hi"), F.lit(-1).alias("mine"), F.col("rep").alias("doc_id"), "component")
        others = rows.where("component <> main")
        outer = others.select("key", F.lit(-1).alias("lo"), F.explode(F.sequence(F.lit(0), F.col("pm") - 1)).alias("hi"), F.lit(0).alias("mine"), F.col("rep").alias("doc_id"), "component")
        own = F.pmod("h", "po").cast("int")
        apart = others.select("key", own.alias("mine"), F.explode(F.sequence(F.lit(0), F.col("po") - 1)).alias("other"), "rep", "component").select("key", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"), "mine", F.col("rep").alias("doc_id"), "component")
        dealt, n = counted(inner.union(outer).union(apart))
        keys = ["key", "lo", "hi"]
        sides = small(dealt, FEW, n).join(bags_of(dealt, n), "doc_id").repartition(partitions(spark), *keys).sortWithinPartitions(*keys, "mine")

        def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, key, root = [], None, {}

            def top(c: int) -> int:
                while root.get(c, c) != c:
                    c = root[c]
                return c

            for b in batches:
                a_s, b_s = [], []
                for *k, mine, doc, component, raw in zip(*(b.column(c).to_pylist() for c in (*keys, "mine", "doc_id", "component", "bag")), strict=True):
                    if k != key:
                        held, key, root = [], k, {}
                    new = weighed(raw)
                    for mine2, doc2, component2, old in held if mine >= 0 else ():
                        # one link joins two components in this group; more of them say nothing new
                        if top(component) != top(component2) and (k[1] == k[2] or mine != mine2) and alike(old, new):
                            root[top(component)] = top(component2)
                            a_s.append(doc2)
                            b_s.append(doc)
                    if k[1] >= 0 or mine < 0:  # of the pairs of two others those in chunks of their own count
                        held.append((mine, doc, component, new))
                yield pa.RecordBatch.from_arrays([pa.array(a_s, pa.int64()), pa.array(b_s, pa.int64())], ["a", "b"])

        return sides.mapInArrow(tidy(compared), "a long, b long")

    # Each round compares the members of a bucket with one of them, and then drops that one; members that are in
    # one component already need no comparison. What is left after the rounds is compared in full, by chunks.
    links, group = None, None
    for n in range(rounds + 1):
        if n == rounds:
            new = in_full(places)
        else:
            heads = places.groupBy("key").agg(F.min(F.struct((F.col("rep") if n == 0 else F.xxhash64(F.lit(n), "rep")).alias("r"), F.struct("*").alias("head"))).alias("m"))
            heads, n_heads = counted(heads.select("key", F.col("m.head.rep").alias("a"), F.col("m.head.component").alias("ca")).coalesce(tasks(n_places)))
            heads = small(heads, FEW, n_heads)
            pairs = places.join(heads, "key").where("component <> ca")
            new = with_head(pairs.select(F.least("a", "rep").alias("a"), F.greatest("a", "rep").alias("b")))
        links, n_links = counted(new if links is None else links.union(new))
        group, n_group = counted(components(links).coalesce(tasks(2 * n_links)))
        group = small(group, FEW, n_group)
        if n == rounds:
            break
        places, n_places = _open(places.join(heads.select("key", F.col("a").alias("rep")), ["key", "rep"], "left_anti"), group, n_places)
        if not n_places:
            break
    judged = classes.select("k1", "k2", "rep", F.col("n").alias("n_copies")).join(group.withColumnRenamed("node", "rep"), "rep", "left")
    judged = judged.select("k1", "k2", F.col("rep").alias("class_id"), F.coalesce("component", "rep").alias("component_id"), "n_copies")
    out = sketch.where(~blank).join(judged, ["k1", "k2"]).select("doc_id", "class_id", "component_id", "n_copies").coalesce(tasks(n_docs))
    alone = sketch.where(blank).select("doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("component_id"), F.lit(1).cast("long").alias("n_copies"))
    return out.union(alone).withColumn("kept", F.col("doc_id") == F.col("component_id"))


def _open(places: DataFrame, group: DataFrame, most: int) -> tuple[DataFrame, int]:
    """The buckets that still hold members of more than one component, each member (of at most ``most``) with its component;
    and their rows."""
    places = places.drop("component").join(group.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    mixed = places.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("key")
    return counted(places.join(mixed, "key").select("key", "rep", "component").coalesce(tasks(most)))
