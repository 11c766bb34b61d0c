"""Product codes of vectors by Lloyd's rounds over whole numbers, each with a dual-tree search.

Vectors are cut into parts, each part position has a codebook, and a code names the nearest entry of each. Tasks keep
their vectors as blocks, each part of a block as a tree; another tree stands over the codebook's entries. A pair of
nodes is dropped when the bounds of its distance say that no part of the one has its nearest entry in the other; a
node left with one entry is assigned whole, by sums kept with it; what stays uncertain at the leaves is compared in full.
All bounds and distances are whole numbers, so the result is that of comparing every part with every entry.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.llm.common import small, stored, tidy

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Parts in a leaf of a tree, at least; uncertain parts of a block that are compared with entries at once.
LEAF, ONCE = 16, 1 << 16
#: Entries that leaves have left, on average, from which one product with all entries costs less.
MANY = 24


def whole(embedding: Column, dimension: int | None = None) -> Column:
    """The components x as floor(1024 x). Beyond a bound far outside the usual, 2^30 over the root of the dimension,
    numbers count as the bound, so that every squared distance fits a long."""
    size = F.lit(dimension) if dimension else F.size(embedding)
    most = F.floor(F.lit(float(1 << 30)) / F.sqrt(F.greatest(size, F.lit(1)).cast("double"))).cast("double")
    return F.transform(embedding, lambda x: F.greatest(-most, F.least(most, F.floor(x.cast("double") * SCALE).cast("double"))).cast("int"))


def usable(embedding: Column) -> Column:
    """Neither null nor with null or non-finite components."""
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return embedding.isNotNull() & F.coalesce(F.forall(embedding, good), F.lit(False))


def spans(dimension: int) -> list[tuple[int, int]]:
    """Where the parts begin and end: equal ones if the dimension allows."""
    return [(dimension * p // PARTS, dimension * (p + 1) // PARTS) for p in range(PARTS)]


@dataclass
class Tree:
    """A balanced tree over points: nodes are stretches of ``points``, those of a level side by side in heap order."""

    order: np.ndarray
    points: np.ndarray
    low: np.ndarray
    high: np.ndarray
    sums: np.ndarray

    @property
    def depth(self) -> int:
        return len(self.low).bit_length() - 1

    def bounds(self, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first point of nodes and the one after their last."""
        level = np.floor(np.log2(node + 1)).astype(np.int64)
        place = node + 1 - (1 << level)
        return len(self.points) * place >> level, len(self.points) * (place + 1) >> level


def grow(points: np.ndarray, leaf: int) -> Tree:
    """Nodes are halved at the median of their widest component until a half would have fewer than ``leaf`` points."""
    n, order = len(points), np.arange(len(points))
    depth = max(0, (n // leaf).bit_length() - 1)
    for level in range(depth):
        starts = n * np.arange(1 << level) >> level
        size = np.diff(starts, append=n)
        now = points[order]
        wide = (np.maximum.reduceat(now, starts) - np.minimum.reduceat(now, starts)).argmax(1) if points.shape[1] else np.zeros(1 << level, int)
        key = now[np.arange(n), np.repeat(wide, size)] if points.shape[1] else np.zeros(n)
        order = order[np.lexsort((key, np.repeat(np.arange(1 << level), size)))]
    now, starts = points[order], n * np.arange(1 << depth) >> depth
    low, high, sums = [np.minimum.reduceat(now, starts)], [np.maximum.reduceat(now, starts)], [np.add.reduceat(now, starts)]
    for _ in range(depth):
        low.insert(0, np.minimum(low[0][::2], low[0][1::2]))
        high.insert(0, np.maximum(high[0][::2], high[0][1::2]))
        sums.insert(0, sums[0][::2] + sums[0][1::2])
    return Tree(order, now, np.concatenate(low), np.concatenate(high), np.concatenate(sums))


def _starts(sorted_: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.diff(sorted_, prepend=-1))


def _square(x: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)


def _product(points: np.ndarray, count: np.ndarray, codebook: np.ndarray, entry: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """By a matrix product with the whole codebook, whole numbers that doubles hold exactly; a dropped entry never wins."""
    c = codebook.astype(np.float64)
    return (_square(c) - 2 * (points.astype(np.float64) @ c.T)).argmin(1)


def _gathered(points: np.ndarray, count: np.ndarray, codebook: np.ndarray, entry: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """With the entries that each leaf has left."""
    many = np.repeat(ends - starts, count)
    begins = np.cumsum(many) - many
    which = np.repeat(np.arange(len(points)), many)
    e = entry[np.repeat(starts, count)[which] + np.arange(len(which)) - begins[which]]
    far = _square(points[which] - codebook[e])
    return np.minimum.reduceat(np.where(far == np.repeat(np.minimum.reduceat(far, begins), many), e, len(codebook)), begins)


def search(tree: Tree, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The nearest entry of every point, ties to the lower: nodes with the one entry of all their points, then points
    (by their place in the tree) with theirs. Each point is in one node or comes by itself."""
    first = np.sort(np.unique(codebook, axis=0, return_index=True)[1])  # an equal entry further on never wins
    entries = grow(codebook[first], 1)
    index = first[entries.order]
    done: list[tuple[np.ndarray, np.ndarray]] = []
    node, other = np.zeros(1, np.int64), np.zeros(1, np.int64)  # pairs, sorted by node
    level = e_level = 0
    while e_level < entries.depth:  # both trees are gone down together
        if level < tree.depth:
            node, other = np.concatenate([2 * node + 1, 2 * node + 2]), np.tile(other, 2)
            level += 1
        node, other = np.tile(node, 2), np.concatenate([2 * other + 1, 2 * other + 2])
        e_level += 1
        by = np.lexsort((other, node))
        node, other = node[by], other[by]
        a, b, c, d = tree.low[node], tree.high[node], entries.low[other], entries.high[other]
        near, far = _square(np.maximum(0, np.maximum(a - d, c - b))), _square(np.maximum(b - c, d - a))
        starts = _starts(node)
        keep = near <= np.repeat(np.minimum.reduceat(far, starts), np.diff(starts, append=len(node)))
        node, other = node[keep], other[keep]
    lo, hi = entries.bounds(other)  # a leaf has one entry or two
    node, entry = np.concatenate([node, node[hi - lo == 2]]), index[np.concatenate([lo, lo[hi - lo == 2] + 1])]
    while len(node):
        by = np.lexsort((entry, node))
        node, entry = node[by], entry[by]
        starts = _starts(node)
        size = np.diff(starts, append=len(node))
        a, b, e = tree.low[node], tree.high[node], codebook[entry]
        off = _square(a + b - 2 * e)  # the entry nearest to the middle of the box beats others over all of it
        group = np.repeat(np.arange(len(starts)), size)
        at = np.lexsort((entry, off, group))[starts]
        best = np.repeat(entry[at], size)
        c = codebook[best]
        worst = (2 * np.where(e > c, b, a) * (e - c) + c * c - e * e).sum(1)
        keep = (worst > 0) | ((worst == 0) & (entry <= best))
        node, entry, group = node[keep], entry[keep], group[keep]
        alone = np.bincount(group, minlength=len(starts))[group] == 1
        done.append((node[alone], entry[alone]))
        node, entry = node[~alone], entry[~alone]
        if level == tree.depth:
            break
        node, entry = np.concatenate([2 * node + 1, 2 * node + 2]), np.tile(entry, 2)
        level += 1
    nodes, owners = (np.concatenate(x) for x in zip(*done, strict=True)) if done else (node, entry)
    starts = _starts(node)
    ends = np.append(starts[1:], len(node))
    lo, hi = tree.bounds(node[starts])
    top = int(max(np.abs(tree.points).max(initial=0), np.abs(codebook).max(initial=0)))
    compare = _product if 3 * top * top * codebook.shape[1] < 1 << 53 and len(node) > MANY * len(starts) else _gathered
    places, own = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    work = np.cumsum((hi - lo) * (ends - starts))
    for k in range(int(work[-1]) // ONCE + 1 if len(work) else 0):  # leaves in portions of bounded work
        some = np.flatnonzero(work // ONCE == k)
        if len(some):
            point = np.repeat(lo[some] - np.cumsum(hi[some] - lo[some]) + (hi - lo)[some], (hi - lo)[some]) + np.arange(int((hi - lo)[some].sum()))
            places.append(point)
            own.append(compare(tree.points[point], (hi - lo)[some], codebook, entry, starts[some], ends[some]))
    return nodes, owners, np.concatenate(places), np.concatenate(own)


_BLOCK = "ids array<long>, labels array<{}>, orders array<binary>, points array<binary>, low array<binary>, high array<binary>, sums array<binary>"


def _blocks(dimension: int):
    """Batches of (id, label, q) as blocks: a row with a tree for each part."""
    rows = min(4096, max(256, (1 << 18) // max(1, dimension)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for at in range(0, whole_batch.num_rows, rows):
                b = whole_batch.slice(at, rows)
                q = b.column("q").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, dimension).astype(np.int64)
                trees = [grow(q[:, lo:hi], LEAF) for lo, hi in spans(dimension)]
                ends = pa.array([0, b.num_rows], pa.int32())
                cols = [pa.ListArray.from_arrays(ends, b.column(0)), pa.ListArray.from_arrays(ends, b.column(1))]
                for f, kind in (("order", np.int32), ("points", np.int32), ("low", np.int32), ("high", np.int32), ("sums", np.int64)):
                    cols.append(pa.array([[getattr(t, f).astype(kind).tobytes() for t in trees]], pa.list_(pa.binary())))
                yield pa.RecordBatch.from_arrays(cols, ["ids", "labels", "orders", "points", "low", "high", "sums"])

    return run


def _trees(b: pa.RecordBatch, i: int, dimension: int) -> Iterator[Tree]:
    for p, (lo, hi) in enumerate(spans(dimension)):
        read = lambda name, kind: np.frombuffer(b.column(name)[i][p].as_py(), kind).astype(np.int64)  # noqa: E731, B023
        order = read("orders", np.int32) if "orders" in b.schema.names else np.zeros(0, np.int64)
        nodes = [read(f, np.int64 if f == "sums" else np.int32) for f in ("low", "high", "sums")]
        points = read("points", np.int32).reshape(-1, hi - lo) if hi > lo else np.zeros((len(b.column("ids")[i]), 0), np.int64)
        yield Tree(order, points, *(x.reshape(-1, hi - lo) if hi > lo else np.zeros((1, 0), np.int64) for x in nodes))


def _totals(codebooks: list[np.ndarray], dimension: int):
    """A task's sums by entry: rows (slot, place, total), the count at place -1; as many as the codebooks hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros((len(c), c.shape[1] + 1), np.int64) for c in codebooks]
        for b in batches:
            for i in range(b.num_rows):
                for t, c, out in zip(_trees(b, i, dimension), codebooks, total, strict=True):
                    node, owner, point, own = search(t, c)
                    lo, hi = t.bounds(node)
                    np.add.at(out, owner, np.column_stack([hi - lo, t.sums[node]]))
                    np.add.at(out, own, np.column_stack([np.ones(len(own), np.int64), t.points[point]]))
        for p, out in enumerate(total):
            entry, place = np.nonzero(np.repeat(out[:, :1] > 0, out.shape[1], 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(p * ENTRIES + entry, pa.int32()), pa.array(place - 1, pa.int32()), pa.array(out[entry, place], pa.int64())], ["slot", "place", "total"]
            )

    return run


def _codes(codebooks: list[np.ndarray], dimension: int, id_: str, label: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                n = len(b.column("ids")[i])
                code, error = np.zeros((n, PARTS), np.uint8), np.zeros(n, np.int64)
                for p, (t, c) in enumerate(zip(_trees(b, i, dimension), codebooks, strict=True)):
                    node, owner, point, own = search(t, c)
                    lo, hi = t.bounds(node)
                    entry = np.zeros(n, np.int64)
                    entry[np.repeat(lo, hi - lo) + np.arange(int((hi - lo).sum())) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo)] = np.repeat(owner, hi - lo)
                    entry[point] = own
                    code[t.order, p], error[t.order] = entry, error[t.order] + _square(t.points - c[entry])
                hexes = pa.array([r.tobytes().hex() for r in code], pa.string())
                yield pa.RecordBatch.from_arrays([b.column("ids")[i].values, b.column("labels")[i].values, hexes, pa.array(error)], [id_, label, "code", "error"])

    return run


@dataclass
class Codebooks:
    """For each part its entries, whole numbers; ``dimension`` is that of the vectors."""

    entries: list[np.ndarray]
    dimension: int

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(x) for c in self.entries for x in c.ravel().tolist()).encode()).hexdigest()


def fit(vectors: DataFrame, id_: str = "vec_id", embedding: str = "embedding", label: str = "label") -> tuple[Codebooks, DataFrame]:
    """Codebooks after ROUNDS rounds, and the blocks of the vectors that are kept, in the shared folder.

    A codebook starts as the part of the vectors with the 256 smallest ids (null ids come last, equal ids in the order of their
    components); fewer vectors make smaller codebooks. The first of them sets the dimension; vectors of another length are
    left out, as are null ones and those with null or non-finite components. The driver holds the codebooks only:
    at most 256 numbers for each component of a vector.
    """
    kept = vectors.where(usable(F.col(embedding))).select(F.col(id_).alias("id"), F.col(label).alias("label"), F.col(embedding).alias("v"))
    smallest = lambda df: [r.q for r in df.withColumn("q", whole(F.col("v"))).orderBy(F.col("id").asc_nulls_last(), "q").limit(ENTRIES).select("q").collect()]
    first = smallest(kept)
    dimension = len(first[0]) if first else 0
    if any(len(q) != dimension for q in first):
        first = smallest(kept.where(F.size("v") == dimension))
    start = np.array(first, np.int64).reshape(len(first), dimension)
    books = [start[:, lo:hi] for lo, hi in spans(dimension)]
    kept = kept.where(F.size("v") == dimension).select("id", "label", whole(F.col("v"), dimension).alias("q"))
    blocks = stored(kept.mapInArrow(tidy(_blocks(dimension)), _BLOCK.format(kept.schema["label"].dataType.simpleString())))
    for _ in range(ROUNDS if len(start) else 0):
        read = blocks.select("points", "low", "high", "sums", *(["ids"] if dimension < PARTS else []))
        rows = read.mapInArrow(tidy(_totals(books, dimension)), "slot int, place int, total long").groupBy("slot", "place").agg(F.sum("total").alias("total"))
        total = [np.zeros((len(c), c.shape[1] + 1), np.int64) for c in books]
        for r in rows.collect():  # the size of the codebooks
            total[r.slot // ENTRIES][r.slot % ENTRIES, r.place + 1] = r.total
        books = [np.where(t[:, :1] > 0, t[:, 1:] // np.maximum(t[:, :1], 1), c) for t, c in zip(total, books, strict=True)]
    return Codebooks(books, dimension), blocks


def encode(blocks: DataFrame, books: Codebooks, id_: str = "vec_id", label: str = "label") -> DataFrame:
    """(id, label, code, error) for each vector of ``blocks``: two hex digits a part, and the squared distance."""
    kind = blocks.schema["labels"].dataType.elementType.simpleString()
    return blocks.mapInArrow(tidy(_codes(books.entries, books.dimension, id_, label)), f"`{id_}` long, `{label}` {kind}, code string, error long")


def compress(vectors: DataFrame, id_: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256, label) for each vector that is kept, see ``fit``.

    ``label_error`` sums the error over equal labels, nulls together (null if it doesn't fit a long). Rows with the same id each have theirs; an
    empty table gives no rows; other columns are left out.
    """
    books, blocks = fit(vectors, id_, embedding, label)
    coded = stored(encode(blocks, books, id_, label))
    by = stored(coded.groupBy(F.col(label).alias("__label")).agg(F.expr("try_sum(error)").alias("label_error")))  # the count decides on a broadcast
    joined = coded.join(small(by), F.col(label).eqNullSafe(F.col("__label")))
    return joined.select(id_, "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"), label)
