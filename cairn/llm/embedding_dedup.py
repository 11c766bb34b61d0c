"""Near-duplicate vectors: sign hashes of random hyperplanes in several tables, exact cosine, components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.common import changes, components, cut, partitions, runs


def plan_tables(n: int, threshold: float, recall: float, per_bucket: int) -> tuple[int, int]:
    """Bits of a hash and number of tables: buckets of about ``per_bucket`` of ``n`` spread vectors, and pairs at
    ``threshold`` meet in one table at least with probability ``recall``."""
    bits = min(40, max(2, round(math.log2(max(n, 1) / per_bucket)) if n > per_bucket else 2))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - meet)))


def planes(dim: int, bits: int, tables: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, tables * bits))


def unit(v: np.ndarray) -> np.ndarray:
    """Rows as doubles of length 1."""
    v = v.astype(np.float64)
    v = v / np.abs(v).max(1)[:, None]
    return v / np.linalg.norm(v, axis=1)[:, None]


def codes(unit: np.ndarray, normals: np.ndarray, bits: int) -> np.ndarray:
    """Hash of each vector in each table, the bits of a table packed in one integer."""
    signs = (unit @ normals >= 0).reshape(len(unit), -1, bits)
    return signs @ (np.int64(1) << np.arange(bits, dtype=np.int64))


def near_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9, recall: float = 0.998, per_bucket: int = 256, chunk: int = 1024, seed: int = 7) -> DataFrame:
    """Rows ``(vec_id, n_links, component_id, kept)``, one for each distinct id.

    Two vectors are linked if their cosine, in double precision, is at least ``threshold``. A vector that is null,
    empty, zero, or that has a null or non-finite component links with nothing and is its own component, as are
    vectors of different lengths towards each other. Ids that are null are left out; of rows that repeat an id
    the least vector counts. Equal vectors are one class that is compared once and counts as many links as it has
    members. Each link is counted in the first table in which its ends meet, so no list of pairs is made; buckets
    over ``chunk`` classes are compared by pairs of chunks, each in a task of its own.
    """
    spark = df.sparkSession
    kind = df.schema[vector_col].dataType.simpleString()  # floats stay floats while they are moved
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(kind if kind == "array<float>" else "array<double>").alias("v")).where("vec_id is not null")
    rows = rows.groupBy("vec_id").agg(F.min("v").alias("v"))
    fit = F.coalesce(F.size("v") > 0, F.lit(False)) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.withColumn("v", F.when(F.coalesce(fit, F.lit(False)), F.col("v"))).withColumns({"k1": F.xxhash64("v"), "k2": F.xxhash64(F.lit(seed), F.col("v"))})
    member = cut(rows.select("vec_id", F.col("v").isNull().alias("odd"), "k1", "k2"))
    classes = rows.where("v is not null").groupBy("k1", "k2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.min(F.struct("vec_id", "v")).alias("m")).select("k1", "k2", "rep", "n", F.col("m.v").alias("v"))
    classes = cut(classes)
    bits, tables = plan_tables(classes.count(), threshold, recall, per_bucket)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rep, n = b.column("rep").to_numpy(), b.column("n").to_numpy()
            sizes = np.diff(b.column("v").offsets.to_numpy())
            flat, starts = b.column("v").flatten().to_numpy(), b.column("v").offsets.to_numpy()
            starts = starts - starts[0]
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                c = codes(unit(flat[starts[at][:, None] + np.arange(dim)]), planes(dim, bits, tables, seed), bits)
                for t in range(tables):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), t, np.int32)), pa.array(np.full(len(at), dim, np.int32)), pa.array(c[:, t]), pa.array(rep[at]), pa.array(n[at])], ["t", "dim", "code", "rep", "n"])

    hashes = classes.select("rep", "n", "v").mapInArrow(hashed, "t int, dim int, code long, rep long, n long")
    sizes = hashes.groupBy("t", "dim", "code").agg(F.count("*").alias("size")).where("size > 1")
    pieces = F.ceil(F.col("size") / chunk).cast("int")
    dealt = (
        hashes.join(sizes, ["t", "dim", "code"]).withColumn("p", pieces)
        .withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("p")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("p") - 1)))
        .withColumns({"lo": F.least("mine", "other"), "hi": F.greatest("mine", "other")})
    )
    keys = ["t", "dim", "code", "lo", "hi"]
    # vectors come to the rows that are left, and then move once
    dealt = dealt.select(*keys, "mine", "rep", "n").join(classes.select("rep", "v"), "rep").repartition(partitions(spark), *keys).sortWithinPartitions(*keys)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, keys):
            table = table.combine_chunks()
            ends = [*changes(table, keys), table.num_rows]
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            col = {k: table.column(k).to_numpy() for k in (*keys, "mine", "rep", "n")}
            lists = table.column("v").combine_chunks()
            flat, starts = lists.values.to_numpy(), lists.offsets.to_numpy()
            for x, y in zip(ends[:-1], ends[1:], strict=True):
                if y - x < 2:
                    continue
                t, dim = int(col["t"][x]), int(col["dim"][x])
                v = unit(flat[starts[x] : starts[y]].reshape(-1, dim))
                rep, n, mine = col["rep"][x:y], col["n"][x:y], col["mine"][x:y]
                linked = v @ v.T >= threshold
                np.fill_diagonal(linked, False)
                if col["lo"][x] != col["hi"][x]:
                    linked &= mine[:, None] != mine[None, :]
                i, j = np.nonzero(linked)
                if t and len(i):  # a pair that met in an earlier table was counted there
                    c = codes(v, planes(dim, bits, tables, seed)[:, : t * bits], bits)
                    for part in range(0, len(i), 200_000):
                        a, b = i[part : part + 200_000], j[part : part + 200_000]
                        met = (c[a] == c[b]).any(1)
                        linked[a[met], b[met]] = False
                if len(i) and linked.any():
                    links = linked @ n
                    some = np.flatnonzero(links)
                    out.append((rep[some], rep[some][_roots(linked[np.ix_(some, some)])], links[some]))
            if out:
                a, b, links = (np.concatenate(x) for x in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(links)], ["a", "b", "links"])

    found = cut(dealt.mapInArrow(compared, "a long, b long, links long").groupBy("a", "b").agg(F.sum("links").alias("links")))
    group = components(found)
    links = found.groupBy("a").agg(F.sum("links").alias("links"))
    judged = (
        classes.select("k1", "k2", "rep", "n").join(links, F.col("rep") == F.col("a"), "left").join(group, F.col("rep") == F.col("node"), "left")
        .select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    )
    even = member.where("not odd").join(judged, ["k1", "k2"]).select("vec_id", "n_links", "component_id")
    odd = member.where("odd").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return even.union(odd).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def _roots(linked: np.ndarray) -> np.ndarray:
    """The first row of each row's component in a symmetric matrix of links."""
    low = np.arange(len(linked))
    done = np.zeros(len(linked), bool)
    for i in range(len(linked)):
        if done[i]:
            continue
        todo = np.zeros(len(linked), bool)
        todo[i] = True
        seen = todo.copy()
        while todo.any():
            todo = linked[todo].any(0) & ~seen
            seen |= todo
        low[seen], done[seen] = i, True
    return low
