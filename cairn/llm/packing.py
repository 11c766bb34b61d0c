"""Best-fit-decreasing packing of token pieces into sequences, by a segment tree over remaining capacities."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairn.llm.common import cut, parts, tidy

#: Pieces of one length that a task ranks, about; a common length is dealt to as many tasks as it needs.
RANKED = 100_000
#: Words that the tokenizer gets as one text.
TOGETHER = 10_000
# Letters whose normal form and lower case are the same alone as in context, and white space that all agree on.
PLAIN = re.compile("[\\x00-\\x1b\\x20-\\u012f\\u0131-\\u01c3\\u01cd-\\u01f0\\u01f4-\\u024f]*")
# fixed values: the tokenizer file's own splitting of normalised text, said for plain text: contractions, runs of
# letters, single numbers, and runs of what is neither
SPLIT = re.compile("'(?:[stmd]|re|ve|ll)|[^\\W\\d_\u00b2\u00b3\u00b9\u00bc-\u00be]+|[\\d\u00b2\u00b3\u00b9\u00bc-\u00be]|(?:[^\\s\\w]|_)+")


class Encoder:
    """Ids of whole texts, as little-endian unsigned 32-bit bytes.

    Words of plain text are encoded once and kept (``known_words`` at most); texts that hold special tokens or
    letters whose normal form may depend on their neighbours go to the tokenizer whole.
    """

    def __init__(self, json_text: str, known_words: int = 300_000):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer, self.words = Tokenizer.from_str(json_text), Tokenizer.from_str(json_text)
        # many normalised words as one text: a line each
        self.words.normalizer = normalizers.Sequence([])
        self.words.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split("\n", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.known_words = known_words

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        words = [SPLIT.findall(t.lower()) if t and self.plain(t) else None for t in texts]
        if len(self.known) > self.known_words:
            self.known.clear()
        self.learn(list(set().union(*(w for w in words if w)).difference(self.known)))
        get = self.known.__getitem__
        return [b"".join(map(get, w)) if w is not None else self.whole(t) for t, w in zip(texts, words, strict=True)]

    def learn(self, words: list[str]) -> None:
        """Ids of words; a token that ends a word tells where the next one begins."""
        if not words:
            return
        if len(words) > TOGETHER:
            for lo in range(0, len(words), TOGETHER):
                self.learn(words[lo : lo + TOGETHER])
            return
        ids = np.array(self.words.encode_batch_fast(["\n".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = (np.flatnonzero(self.last[ids]) + 1) * 4
        if len(ends) == len(words):
            raw = ids.tobytes()
            self.known.update(zip(words, (raw[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)), strict=True))
        else:
            self.known.update((w, self.whole(w)) for w in words)

    def plain(self, text: str) -> bool:
        return PLAIN.fullmatch(text) is not None and not any(s in text for s in self.special)

    def whole(self, text: str | None) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes() if text else b""


_encoders: dict[str, Encoder] = {}


def encoder(json_text: str) -> Encoder:
    """The worker's encoder of a tokenizer, with the words it knows from earlier tasks."""
    if json_text not in _encoders:
        _encoders.clear()
        _encoders[json_text] = Encoder(json_text)
    return _encoders[json_text]


def pieces(docs: DataFrame, tokenizer_json: str, size: int = 4096, end_id: int = 1) -> DataFrame:
    """Rows ``(doc_id, piece, start, length, ids_crc32)``: each document's ids and ``end_id``, cut only if longer
    than ``size``. A null or empty text is ``end_id`` alone; rows that repeat a doc_id are documents of their own."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)
    end, step = np.array([end_id], "<u4").tobytes(), 4 * size

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(shared.value)
        for b in parts(batches, 500):
            rows = []
            for d, ids in zip(b.column("doc_id").to_pylist(), encode(b.column("text").to_pylist()), strict=True):
                ids += end
                rows += [(d, i, at // 4, len(p) // 4, zlib.crc32(p)) for i, at in enumerate(range(0, len(ids), step)) for p in (ids[at : at + step],)]
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(tidy(coded), "doc_id long, piece int, start long, length long, ids_crc32 long")


@dataclass
class Bins:
    """Open bins by remaining capacity: a segment tree tells the least capacity that is enough and has a bin."""

    size: int
    runs: dict[int, list[list[int]]] = field(default_factory=dict)  # capacity: runs of (first bin, number of bins)

    def __post_init__(self) -> None:
        self.leaves = 1 << self.size.bit_length()
        self.any = np.zeros(2 * self.leaves, bool)

    def _set(self, capacity: int, on: bool) -> None:
        i = capacity + self.leaves
        self.any[i] = on
        while i := i // 2:
            self.any[i] = self.any[2 * i] or self.any[2 * i + 1]

    def put(self, capacity: int, first: int, n: int) -> None:
        if n and capacity:
            self.runs.setdefault(capacity, []).append([first, n])
            self._set(capacity, True)

    def tightest(self, least: int) -> int:
        """The smallest capacity of at least ``least`` that an open bin has; -1 if none. Time log(size)."""
        i = least + self.leaves
        while not self.any[i]:
            while i & 1:  # a right child: go up
                i //= 2
            if i == 0:
                return -1
            i += 1
            if i & (i - 1) == 0:
                return -1
        while i < self.leaves:
            i = 2 * i if self.any[2 * i] else 2 * i + 1
        return i - self.leaves

    def take(self, capacity: int, most: int) -> tuple[int, int]:
        """Up to ``most`` bins of a capacity: (first bin, number of bins)."""
        run = self.runs[capacity][-1]
        first, n = run[0], min(run[1], most)
        run[0] += n
        run[1] -= n
        if not run[1]:
            self.runs[capacity].pop()
            if not self.runs[capacity]:
                self._set(capacity, False)
        return first, n


def best_fit_decreasing(lengths: dict[int, int], size: int) -> list[tuple[int, int, int, int, int, int]]:
    """Place pieces given as {length: number}, longest first, each in the tightest open bin that has room.

    Pieces of one length that meet bins of one capacity are placed together, as one after the other they would be:
    a bin takes such pieces until it has no room. Returns (length, first rank, number, first bin, pieces a bin,
    offset). The work and the result depend on the distinct lengths (at most ``size``), not on the pieces.
    """
    bins, plan, opened = Bins(size), [], 0
    for length in sorted(lengths, reverse=True):
        rank, left = 0, lengths[length]
        while left:
            room = bins.tightest(length)
            fresh = room < 0
            if fresh:
                room = size
            each = room // length
            wanted = left // each
            if not wanted:
                each, wanted = left, 1
            if fresh:
                first, n = opened, wanted
                opened += wanted
            else:
                first, n = bins.take(room, wanted)
            plan.append((length, rank, n * each, first, each, size - room))
            bins.put(room - each * length, first, n)
            rank, left = rank + n * each, left - n * each
    return plan


def pack(cut_pieces: DataFrame, size: int = 4096) -> DataFrame:
    """``cut_pieces`` with ``sequence_id`` and ``offset`` (gapless from 0 in each sequence).

    Only the number of pieces of each length, ``size`` numbers at most, comes to the driver; the plan made of them
    goes back to the tasks. Pieces are ranked within their length chunk by chunk, by id. Pieces longer than ``size``
    or not longer than 0 are an error of the caller and get nulls.
    """
    spark = cut_pieces.sparkSession
    rows = cut(cut_pieces)
    lengths = {r.length: r.n for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    chunks = -(-max(lengths.values(), default=1) // RANKED)
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(chunks)).cast("int"))
    per_chunk = rows.groupBy("length", "chunk").agg(F.count("*").alias("n"))
    plan = np.array(best_fit_decreasing({k: n for k, n in lengths.items() if 0 < k <= size}, size), np.int64).reshape(-1, 6)
    shared = spark.sparkContext.broadcast(plan)
    before = per_chunk.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("chunk")) - F.col("n")).select("length", "chunk", "before")
    rank = F.row_number().over(Window.partitionBy("length", "chunk").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = rows.withColumn("rank", rank).join(before, ["length", "chunk"]).withColumn("rank", F.col("rank") + F.col("before")).drop("chunk", "before")

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        # plan rows in order of (length, rank): one number for both, as ranks stay under 2 ** 50
        order = np.lexsort((p[:, 1], p[:, 0]))
        p = p[order]
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            at = np.full(len(length), -1, np.int64)
            for n in np.unique(length):
                own = np.flatnonzero(length == n)
                lo, hi = np.searchsorted(p[:, 0], [n, n + 1])
                if hi > lo:
                    at[own] = lo + np.searchsorted(p[lo:hi, 1], rank[own], "right") - 1
            found = at >= 0
            use = p[at] if len(p) else np.zeros((len(at), 6), np.int64)
            k = rank - use[:, 1]
            each = np.maximum(1, use[:, 4])
            keep = [c for c in b.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(use[:, 3] + k // each, mask=~found), pa.array(use[:, 5] + k % each * length, mask=~found)], [*keep, "sequence_id", "offset"])

    keep = [c for c in ranked.columns if c != "rank"]
    schema = ", ".join(f"`{c}` {ranked.schema[c].dataType.simpleString()}" for c in keep)
    return ranked.select(*keep, F.col("rank").cast("long").alias("rank")).mapInArrow(placed, f"{schema}, sequence_id long, offset long")
