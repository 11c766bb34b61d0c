"""Byte-level BPE: ranked merges folded over the byte arrays of distinct words, and decoding."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.llm.common import parts

NONE = np.int64(-1)


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file on the driver with lines ``<base64 of the bytes> <rank>``."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


class Merger:
    """The rank map as a hash table in arrays: a pair of neighbours' ids is looked up for all words at once."""

    def __init__(self, ranks: dict[bytes, int], longest: int = 96):
        self.ranks, self.longest = ranks, longest
        self.bytes = np.array([ranks.get(bytes([i]), -1) for i in range(256)], np.int64)
        pairs = {(ranks[t[:i]] << 20) | ranks[t[i:]]: r for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks}
        self.size = 1 << max(4, (len(pairs) * 4).bit_length())
        self.keys, self.values = np.full(self.size, NONE), np.zeros(self.size, np.int64)
        keys, values = np.fromiter(pairs, np.int64, len(pairs)), np.fromiter(pairs.values(), np.int64, len(pairs))
        at, self.probes = self._slot(keys), 0
        while len(keys):
            free = np.flatnonzero(self.keys[at] == NONE)
            first = free[np.unique(at[free], return_index=True)[1]]
            self.keys[at[first]], self.values[at[first]] = keys[first], values[first]
            rest = np.setdiff1d(np.arange(len(keys)), first)
            keys, values, at = keys[rest], values[rest], (at[rest] + 1) % self.size
            self.probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.int64) % self.size

    def rank_of(self, left: np.ndarray, right: np.ndarray, none: int = 1 << 40) -> np.ndarray:
        """Ranks of the merged pairs; ``none`` where the two don't merge."""
        keys = (left << 20) | right
        at = self._slot(keys)
        out = np.full(keys.shape, none, np.int64)
        open_ = np.ones(keys.shape, bool)
        for _ in range(self.probes):
            seen = self.keys[at]
            hit = open_ & (seen == keys)
            out[hit] = self.values[at[hit]]
            open_ &= ~hit & (seen != NONE)
            if not open_.any():
                break
            at = (at + 1) % self.size
        return out

    def encode(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word: words of equal length are folded together, a round merging each word's lowest pair."""
        out: list[np.ndarray] = [None] * len(words)  # type: ignore[list-item]
        by: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            if (r := self.ranks.get(w)) is not None:
                out[i] = np.array([r], np.int32)
            elif len(w) > self.longest:
                out[i] = self._long(w)
            else:
                by.setdefault(len(w), []).append(i)
        for n, at in by.items():
            ids = self.bytes[np.frombuffer(b"".join(words[i] for i in at), np.uint8).reshape(-1, n)]
            self._fold(ids, np.array(at), out)
        return out

    def _fold(self, ids: np.ndarray, at: np.ndarray, out: list[np.ndarray]) -> None:
        while len(at):
            if ids.shape[1] == 1:
                pairs = np.full((len(at), 1), 1 << 40)
            else:
                pairs = self.rank_of(ids[:, :-1], ids[:, 1:])
            spot = pairs.argmin(1)
            rows = np.arange(len(at))
            low = pairs[rows, spot]
            done = low >= 1 << 40
            for i, x in zip(at[done], ids[done].astype(np.int32), strict=True):
                out[i] = x
            ids, at, spot, low = ids[~done], at[~done], spot[~done], low[~done]
            if not len(at):
                break
            ids[np.arange(len(at)), spot] = low
            keep = np.arange(ids.shape[1])[None, :] != spot[:, None] + 1
            ids = ids[keep].reshape(len(at), -1)

    def _long(self, word: bytes) -> np.ndarray:
        """One long word with a heap of pairs, in time n log n."""
        ids = self.bytes[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        first = self.rank_of(np.array(ids[:-1]), np.array(ids[1:]))
        heap = [(int(r), i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r < 1 << 40]
        heapq.heapify(heap)
        known: dict[tuple[int, int], int] = {}

        def push(i: int) -> None:
            j = right[i]
            if j < 0:
                return
            if (p := (ids[i], ids[j])) not in known:
                known[p] = int(self.rank_of(np.array([p[0]]), np.array([p[1]]))[0])
            if known[p] < 1 << 40:
                heapq.heappush(heap, (known[p], i, *p))

        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = right[i] if ids[i] == a else -1
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = r, -1
            right[i] = right[j]
            if right[j] >= 0:
                left[right[j]] = i
            push(i)
            if left[i] >= 0:
                push(left[i])
        return np.array([x for x in ids if x >= 0], np.int32)


def encode(df: DataFrame, text_col: str, ranks: dict[bytes, int], pattern: str, out: str = "ids", known_words: int = 300_000) -> DataFrame:
    """``df`` with the array column ``out``: ids of the whole text, each match of ``pattern`` encoded separately.

    A null text counts as empty; its ids are an empty array. Repeated and clashing rows are rows like others; a
    column named ``out`` is replaced. The map of ranks (as large as the vocabulary, some 50,000 entries) goes to
    the tasks as a broadcast; a task keeps the ids of at most ``known_words`` distinct words.
    """
    shared = df.sparkSession.sparkContext.broadcast(ranks)
    df = df.drop(out)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        m = Merger(shared.value)
        find = regex.compile(pattern).findall
        known: dict[str, np.ndarray] = {}
        for part in parts(batches, 500, column=text_col):
            texts = [find(t) if t else [] for t in part.column(text_col).to_pylist()]
            if len(known) > known_words:
                known.clear()
            fresh = list(set().union(*texts).difference(known))
            known.update(zip(fresh, m.encode([w.encode("utf-8", "surrogatepass") for w in fresh]), strict=True))
            rows = [np.concatenate([known[w] for w in words]) if words else np.zeros(0, np.int32) for words in texts]
            starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(starts), pa.array(np.concatenate(rows).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*part.columns, ids], [*part.schema.names, out])

    return df.mapInArrow(coded, T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))]))


def decode(df: DataFrame, ids_col: str, ranks: dict[bytes, int], out: str = "bytes") -> DataFrame:
    """``df`` with the binary column ``out``: the ids' pieces put together. Null ids or an unknown id give null."""
    shared = df.sparkSession.sparkContext.broadcast(ranks)
    df = df.drop(out)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = {r: b for b, r in shared.value.items()}
        for batch in batches:
            lo, held, made = 0, 0, []
            for hi, ids in enumerate(batch.column(ids_col), 1):
                found = None if not ids.is_valid else [piece.get(i) for i in ids.values.to_numpy(zero_copy_only=False).tolist()]
                made.append(None if found is None or None in found else b"".join(found))
                held += len(made[-1] or b"")
                if hi == batch.num_rows or hi - lo == 500 or held > 1 << 20:  # a longer text stands alone
                    yield pa.RecordBatch.from_arrays([*batch.slice(lo, hi - lo).columns, pa.array(made, pa.binary())], [*batch.schema.names, out])
                    lo, held, made = hi, 0, []

    return df.mapInArrow(joined, T.StructType([*df.schema.fields, T.StructField(out, T.BinaryType())]))


def fold_words(words: DataFrame, word_col: str, ranks: dict[bytes, int], buckets: int = 4096) -> DataFrame:
    """``words`` with ``ids``: the same fold with Spark's higher-order functions and a literal rank map.

    For small vocabularies and tests; see README for why ``encode`` doesn't use it on whole corpora.
    """
    import json
    import zlib

    table: list[dict[str, int]] = [{} for _ in range(buckets)]
    for k, v in ranks.items():
        table[zlib.crc32(k) % buckets][k.hex()] = v
    literal = F.from_json(F.lit(json.dumps(table)), "array<map<string,int>>")
    none = F.lit(1 << 30)

    def rank(piece: Column) -> Column:
        return F.coalesce(F.try_element_at(F.get(literal, (F.crc32(piece) % buckets).cast("int")), F.lower(F.hex(piece))), none)

    def merge(s: Column) -> Column:
        p, n = s["p"], F.size(s["p"])
        pairs = F.transform(F.slice(p, 1, F.greatest(n - 1, F.lit(0))), lambda x, i: F.struct(rank(F.concat(x, F.get(p, i + 1))).alias("r"), i.alias("i")))
        best = F.transform(F.array(F.array_min(pairs)), lambda b: F.when(b.isNull() | (b.r >= none), F.struct(p.alias("p"), F.lit(False).alias("more"))).otherwise(
            F.struct(F.concat(F.slice(p, 1, b.i), F.array(F.concat(F.get(p, b.i), F.get(p, b.i + 1))), F.slice(p, b.i + 3, n)).alias("p"), F.lit(True).alias("more"))))
        return F.when(s["more"], F.get(best, 0)).otherwise(s)  # once nothing merges, nothing is looked up any more

    raw = F.encode(F.col(word_col), "utf-8")
    start = F.when(F.octet_length(raw) > 0, F.transform(F.sequence(F.lit(1), F.greatest(F.octet_length(raw), F.lit(1))), lambda i: F.substring(raw, i, F.lit(1)))).otherwise(F.array().cast("array<binary>"))
    first = F.struct(start.alias("p"), F.lit(True).alias("more"))
    pieces = F.aggregate(F.sequence(F.lit(1), F.greatest(F.octet_length(raw), F.lit(1))), first, lambda s, _: merge(s), lambda s: s["p"])
    whole = rank(raw)
    return words.withColumn("ids", F.when(whole < none, F.array(whole)).otherwise(F.transform(pieces, rank)))
