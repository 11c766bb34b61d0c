"""Repeated passages: lines, stretches of lines and fragments with content-defined edges, MinHash bands, exact Jaccard,
components, removal."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.llm.common import Words, components, counted, mark, mix, partitions, parts, run_hashes, small, stored, tidy

#: A fragment ends at a line end, and before a pair of words whose hash is the least of REACH pairs on either side.
#: So a passage is cut alike wherever it stands in a line, but for some REACH words at its ends.
REACH = 4
SHINGLE = 5
#: Bits of the maps of keys that spare rows a shuffle (4 MB). Where one fills up, more rows go to the exact join.
MAP_BITS = 1 << 25
TOP = np.uint64(0xFFFFFFFFFFFFFFFF)
SALTS = mix(np.arange(1, 17, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
PLACE = "exact long, doc_id long, seq int, pieces int, start int, end int, first int, words int, keys array<long>"


def tune_bands(threshold: float, recall: float, rows: int) -> int:
    """The fewest bands of ``rows`` minima in which pairs at ``threshold`` meet with probability ``recall``."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)))


@dataclass
class Paragraphs:
    """Of some texts side by side: first the fragments, then the lines of several fragments, then the stretches of
    several lines between blank ones. Number of the text, number in the text of its first fragment, number of
    fragments, first word, words, exact hash."""

    of: Words
    text: np.ndarray
    seq: np.ndarray
    pieces: np.ndarray
    first: np.ndarray
    words: np.ndarray
    exact: np.ndarray
    hashes: np.ndarray
    #: The rows of the whole lines and stretches, which are compared by their shingles.
    whole: np.ndarray
    #: Of lines and stretches: first words of all, which places begin a shingle inside, and which of them are in ``whole``.
    kinds: list[tuple[np.ndarray, np.ndarray, np.ndarray]]

    def minima(self, which: int) -> np.ndarray:
        """MinHash number ``which`` of the shingles of each paragraph in ``whole``."""
        h = mix(self.hashes ^ SALTS[which])
        low = np.concatenate([np.minimum.reduceat(np.where(inside, h, TOP), first)[kept] if len(first) else h for first, inside, kept in self.kinds])
        return np.where(low == TOP, mix(self.exact[self.whole] ^ SALTS[which]), low)

    def shingles(self, i: int) -> np.ndarray:
        """The shingles of paragraph ``i``; a short one is a single shingle."""
        a, n = self.first[i], self.words[i]
        return np.unique(self.hashes[a : a + n - SHINGLE + 1]) if n >= SHINGLE else self.exact[i : i + 1]


def paragraphs(texts: list[str | None]) -> Paragraphs:
    of = Words(texts)
    words, line = of.hash, of.lines()
    n = len(words)
    if not n:
        none = np.zeros(0, np.int64)
        return Paragraphs(of, none, none, none, none, none, words, words, none, [(none, np.zeros(0, bool), none)])
    new_text = np.append(True, of.text[1:] != of.text[:-1])
    new_line = np.append(True, line[1:] != line[:-1])
    new_stretch = new_text | np.append(True, line[1:] > line[:-1] + 1)
    pair = run_hashes(words, 2)
    pair[np.append(new_line[1:], True)] = TOP
    place = np.arange(n) + REACH * np.cumsum(new_line)
    padded = np.full(place[-1] + REACH + 1, TOP, np.uint64)
    padded[place] = pair
    low = sliding_window_view(padded, 2 * REACH + 1).min(1)[place - REACH]
    fragments = np.flatnonzero(new_line | ((pair == low) & (pair != TOP)))
    own = of.text[fragments]
    seq = np.arange(len(fragments)) - np.searchsorted(own, own)
    kinds, rows, whole, total = [], [], [], 0
    for kind, first in enumerate((fragments, np.flatnonzero(new_line), np.flatnonzero(new_stretch))):
        size = np.diff(np.append(first, n))
        spot = np.arange(n) - np.repeat(first, size)
        with np.errstate(over="ignore"):
            exact = mix(np.add.reduceat(mix(words + (spot + 1).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)), first) + size.astype(np.uint64))
        at = np.searchsorted(fragments, first)
        pieces = np.diff(np.append(at, len(fragments)))
        kept = np.arange(len(first))
        if kind == 1:  # a line of one fragment is that fragment's row
            kept = np.flatnonzero(pieces > 1)
            row = at.copy()
            row[kept] = total + np.arange(len(kept))
            kinds.append((first, spot + SHINGLE <= np.repeat(size, size), np.arange(len(first))))
            whole.append(row)
        elif kind == 2:  # in a text without a blank line, the lines are the paragraphs
            kept = np.flatnonzero((np.add.reduceat(new_line.astype(np.int64), first) > 1) & (np.bincount(of.text[first])[of.text[first]] > 1))
            kinds.append((first, spot + SHINGLE <= np.repeat(size, size), kept))
            whole.append(total + np.arange(len(kept)))
        rows.append((of.text[first][kept], seq[at[kept]], pieces[kept], first[kept], size[kept], exact[kept]))
        total += len(kept)
    return Paragraphs(of, *map(np.concatenate, zip(*rows, strict=True)), run_hashes(words, SHINGLE), np.concatenate(whole), kinds)


def key_map(df: DataFrame, column: str) -> np.ndarray:
    """A map of MAP_BITS bits, by their low bits, of the hashes in ``column``; at most 1,024 rows of 4 KB are collected."""
    spot = df.select((F.col(column).bitwiseAND(F.lit(MAP_BITS - 1)) + 1).alias("s"))
    bits = np.zeros(MAP_BITS // 8, np.uint8)
    for r in spot.groupBy(F.bitmap_bucket_number("s").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("m")).collect():
        bits[(r.k - 1) * 4096 : r.k * 4096] |= np.frombuffer(bytes(r.m), np.uint8)
    return bits


def in_map(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = (keys & np.uint64(MAP_BITS - 1)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def packed(doc_id: str, seq: str) -> Column:
    """A document and a place in it as one number in the same order, which hash aggregation can take the least of."""
    return F.col(doc_id).cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(11,0)") + F.col(seq)


def unpacked(place: Column) -> tuple[Column, Column]:
    """The (doc_id, seq) of a packed place."""
    step = F.lit(1 << 32).cast("decimal(11,0)")
    seq = F.pmod(place, step)
    return ((place - seq) / step).cast("long"), seq.cast("int")


def linked_pairs(places: DataFrame, threshold: float, chunk: int) -> DataFrame:
    """(a, b): links that join all ``places`` (key, exact, shingles) of one key whose sets are similar, also over others.

    The members of a key are dealt to parts of about ``chunk``, a task for each, and compared with the key's head and
    with one another. Of keys of several parts, those with members of more than one component then are compared in
    full across components, by pairs of chunks; two members of the largest component need no comparison.
    """
    spark = places.sparkSession

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, root = None, [], {}

        def top(c: int) -> int:
            while root.get(c, c) != c:
                c = root[c] = root.get(root[c], root[c])
            return c

        for b in batches:
            a_s, b_s = [], []
            ks, los, his, mines, ids, groups = (b.column(c).to_pylist() for c in ("key", "lo", "hi", "mine", "exact", "component"))
            for i, own in enumerate(zip(ks, los, his, strict=True)):
                if own != key:
                    key, held, root = own, [], {}
                # within a first chunk all meet; of two chunks only members of different ones, and the main ones never
                mine, group, new = mines[i], groups[i], set(b.column("shingles")[i].as_py())
                for mine2, id2, group2, old in held:
                    if (own[1] == own[2] or mine != mine2) and min(len(old), len(new)) >= threshold * max(len(old), len(new)) and top(group) != top(group2):
                        both = len(old & new)
                        if both >= threshold * (len(old) + len(new) - both):
                            root[top(group)] = top(group2)  # one link joins two components in this group
                            a_s.append(id2)
                            b_s.append(ids[i])
                held.append((mine, ids[i], group, new))
            yield pa.RecordBatch.from_arrays([pa.array(a_s, pa.int64()), pa.array(b_s, pa.int64())], ["a", "b"])

    def in_groups(dealt: DataFrame) -> DataFrame:
        keys = ["key", "lo", "hi"]
        dealt = dealt.select(*keys, "mine", "exact", "component", "shingles").repartition(partitions(spark), *keys)
        return dealt.sortWithinPartitions(*keys, "mine", "exact").mapInArrow(tidy(compared), "a long, b long")

    number = lambda n: F.pmod(F.xxhash64("exact"), F.col(n)).cast("int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    # keys of several parts: at most a row for every ``chunk`` places
    size = places.groupBy("key").agg(F.count("*").alias("n"), F.min("exact").alias("head")).where(F.col("n") > chunk)
    hot, n_hot = counted(size.select("key", F.ceil(F.col("n") / chunk).cast("int").alias("parts"), "head"))
    one, zero = F.lit(1), F.lit(0)
    dealt = places.join(small(hot, rows=n_hot), "key", "left").withColumn("parts", F.coalesce("parts", one)).withColumn("own", number("parts"))
    heads = F.when(F.col("exact") == F.col("head"), F.sequence(zero, F.col("parts") - 1)).otherwise(F.array("own"))
    dealt = dealt.select("key", "exact", "shingles", F.explode(heads).alias("lo"))
    links, _ = counted(in_groups(dealt.select("*", F.col("lo").alias("hi"), zero.alias("mine"), F.col("exact").alias("component"))))
    if not n_hot:
        return links
    group, _ = counted(components(links))
    left = places.join(small(hot.select("key"), rows=n_hot), "key", "left_semi").join(group.withColumnRenamed("node", "exact"), "exact", "left")
    left = stored(left.withColumn("component", F.coalesce("component", "exact")))
    of = left.groupBy("key", "component").agg(F.count("*").alias("n"))
    of = of.groupBy("key").agg(F.max(F.struct("n", "component")).alias("m"), F.sum("n").alias("all")).where(F.col("all") > F.col("m.n"))
    main, n_main = counted(of.select("key", F.col("m.component").alias("main"), F.ceil(F.col("m.n") / chunk).cast("int").alias("pm"), F.ceil((F.col("all") - F.col("m.n")) / chunk).cast("int").alias("po")))
    rows = left.join(small(main, rows=n_main), "key")
    inner, others = rows.where("component = main"), rows.where("component <> main").withColumn("mine", number("po"))
    kept = ["key", "exact", "component", "shingles"]
    # a chunk of the main component has the number -1 - i
    met = inner.withColumn("mine", -1 - number("pm")).select(*kept, F.col("mine").alias("lo"), "mine", upto("po").alias("hi"))
    meet = others.select(*kept, F.col("mine").alias("hi"), "mine", upto("pm").alias("i")).withColumn("lo", -1 - F.col("i"))
    apart = others.select(*kept, "mine", upto("po").alias("other")).withColumn("lo", F.least("mine", "other")).withColumn("hi", F.greatest("mine", "other"))
    every = [x.select(*kept, "lo", "hi", "mine") for x in (met, meet, apart)]
    return links.union(in_groups(every[0].union(every[1]).union(every[2])))


def repeated_passages(docs: DataFrame, threshold: float = 0.8, recall: float = 0.99, least_words: int = 20, from_one: float = 0.75, chunk: int = 512) -> DataFrame:
    """Rows ``(doc_id, text_hash, start, end, words, source)``: the passages to remove, code points, end exclusive.

    Paragraphs are lines and stretches of lines between blank ones. They are linked if the Jaccard similarity of
    their five-word shingles is at least ``threshold`` (a paragraph of fewer words is one shingle), with probability
    ``recall`` at the threshold; linked ones are one component. Passages inside lines are found by fragments of
    lines, which are compared exactly: nine words hold too few shingles for an edit to leave ``threshold`` of them.
    Of a component, or of equal fragments, the first place, by doc_id and place in the text, stays; what overlaps it
    is no copy of it. A passage is a stretch of fragments that all are in later copies, of ``least_words`` words
    together, of which ``from_one`` of ``least_words`` stay in one document, so that common short phrases in a row
    are none; ``source`` is that document. Case and punctuation don't count.
    Null and empty texts have no passage; rows without an id are left out, of rows that repeat a doc_id the greatest
    text counts once, and ``text_hash`` tells to which text the passage belongs (null if the id doesn't repeat).
    Only doc_id and text are read. Texts are cut once, and again are those that hold a paragraph to be compared; no
    text is shuffled but those of repeated ids.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null and text <> ''")
    again, n_again = counted(texts.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"))
    repeats = n_again > 0
    if repeats:
        marked = mark(texts, "doc_id", again)
        greatest = stored(marked.where("__hit").groupBy("doc_id").agg(F.max("text").alias("text")))
        texts = marked.where("not __hit").select("doc_id", "text").unionByName(greatest)
    rows = 2
    bands = tune_bands(threshold, recall, rows)
    # sets of fewer shingles are as similar as asked for only if they are equal
    least = math.ceil(threshold / (1 - threshold) - 1e-9)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small_int = lambda x: pa.array(x.astype(np.int32))
        for b in parts(batches):
            p = paragraphs(b.column("text").to_pylist())
            low = [p.minima(i) for i in range(bands * rows)]
            with np.errstate(over="ignore"):
                keys = np.array([mix(low[rows * i] * np.uint64(3) + low[rows * i + 1] * np.uint64(5) + np.uint64(i)) for i in range(bands)], np.uint64).reshape(bands, -1)
            able = np.flatnonzero(p.words[p.whole] - SHINGLE + 1 >= least)
            at = p.whole[able]
            size = np.zeros(len(p.text), np.int64)
            size[at] = bands
            order = np.argsort(at, kind="stable")  # the list column holds the keys in the order of the rows
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)).astype(np.int32)), pa.array(keys.T[able[order]].ravel().astype(np.int64)))
            point = p.of.points()
            base = point[p.of.text_start[p.text]]
            start, end = point[p.of.start[p.first]] - base, point[p.of.end[p.first + p.words - 1]] - base
            exact, ids = pa.array(p.exact.astype(np.int64)), pa.array(b.column("doc_id").to_numpy()[p.text])
            yield pa.RecordBatch.from_arrays([exact, ids, *map(small_int, (p.seq, p.pieces, start, end, p.first - p.of.first[p.text], p.words)), lists], ["exact", "doc_id", "seq", "pieces", "start", "end", "first", "words", "keys"])

    places = stored(texts.mapInArrow(tidy(placed), PLACE))
    group = _groups(texts, places, threshold, chunk)
    # one row for each paragraph or fragment that stands in two places or is like another one: where the first one is
    equal = places.groupBy("exact").agg(F.count("*").alias("n"), F.min(packed("doc_id", "seq")).alias("place"))
    doubtful = stored(mark(equal, "exact", group.select("node"), bits=MAP_BITS).where("n > 1 or __hit").select("exact", "n", "place"))
    linked = doubtful.join(group.withColumnRenamed("node", "exact"), "exact", "left").select("exact", "n", "place", "component")
    near = linked.where("component is not null")
    source = near.join(near.groupBy("component").agg(F.min("place").alias("source")), "component").select("exact", "source")
    source = source.unionByName(linked.where("component is null and n > 1").select("exact", F.col("place").alias("source")))
    source_id, source_seq = unpacked(F.col("source"))
    source, _ = counted(source.select("exact", source_id.alias("source"), source_seq.alias("source_seq")))
    found = mark(places.drop("keys"), "exact", source.select("exact"), bits=MAP_BITS).where("__hit").drop("__hit")
    later = found.join(source, "exact").where("doc_id > source or doc_id = source and seq >= source_seq + pieces")
    later = later.select("doc_id", "seq", "pieces", "start", "end", "first", "words", "source").repartition(partitions(spark), "doc_id")  # all that follows stays within these partitions
    in_order = Window.partitionBy("doc_id").orderBy("seq", F.desc("pieces"), "source")
    reach = F.max(F.col("seq") + F.col("pieces")).over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    stretch = later.withColumn("island", F.sum(F.when(F.col("seq") <= reach, 0).otherwise(1)).over(in_order))
    # what one source gives: its fragments together, or its longest paragraph
    given = F.greatest(F.coalesce(F.sum(F.when(F.col("pieces") == 1, F.col("words"))), F.lit(0)), F.max("words"))
    edges = [F.min("start").alias("start"), F.max("end").alias("end"), F.min("first").alias("first")]
    by_source = stretch.groupBy("doc_id", "island", "source").agg(*edges, F.max(F.col("first") + F.col("words")).alias("last"), given.alias("given"))
    most = F.max(F.struct("given", (-F.col("source")).alias("low"))).alias("most")
    whole = by_source.groupBy("doc_id", "island").agg(*edges[:2], (F.max("last") - F.min("first")).cast("long").alias("words"), most)
    whole = whole.where((F.col("words") >= least_words) & (F.col("most.given") >= from_one * least_words))
    if repeats:
        whole = whole.join(greatest.join(again, "doc_id").select("doc_id", F.xxhash64("text").alias("text_hash")), "doc_id", "left")
    else:
        whole = whole.withColumn("text_hash", F.lit(None).cast("long"))
    return whole.select("doc_id", "text_hash", "start", "end", "words", (-F.col("most.low")).alias("source"))


def _groups(texts: DataFrame, places: DataFrame, threshold: float, chunk: int) -> DataFrame:
    """(node, component) of the exact hashes of the paragraphs that are like another one."""
    able = places.where(F.size("keys") > 0)
    banded = able.select(F.explode("keys").alias("key"), "exact")
    # bands in which different paragraphs collide, their members, and one text that holds each member
    collide, _ = counted(banded.groupBy("key").agg(F.min("exact").alias("low"), F.max("exact").alias("high")).where("low < high").select("key"))
    members, _ = counted(mark(banded, "key", collide, bits=MAP_BITS).where("__hit").join(collide, "key").select("key", "exact").distinct())
    wanted = texts.sparkSession.sparkContext.broadcast(key_map(members, "exact"))
    holders = mark(able, "exact", members.select("exact"), bits=MAP_BITS).where("__hit").groupBy("exact").agg(F.min("doc_id").alias("doc_id")).select("doc_id").distinct()
    holders, _ = counted(holders)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches):
            p = paragraphs(b.column("text").to_pylist())
            hit = p.whole[in_map(wanted.value, p.exact[p.whole])]
            yield pa.RecordBatch.from_arrays([pa.array(p.exact[hit].astype(np.int64)), pa.array([p.shingles(i).astype(np.int64) for i in hit.tolist()], pa.list_(pa.int64()))], ["exact", "shingles"])

    some = mark(texts, "doc_id", holders).where("__hit").select("doc_id", "text").join(holders, "doc_id", "left_semi")
    shingled = some.select("text").mapInArrow(tidy(sets), "exact long, shingles array<long>").groupBy("exact").agg(F.min("shingles").alias("shingles"))
    group, _ = counted(components(linked_pairs(stored(members.join(shingled, "exact").select("key", "exact", "shingles")), threshold, chunk)))
    wanted.destroy()
    return group


def judge(docs: DataFrame, **options) -> DataFrame:
    """Rows ``(doc_id, n_passages, n_removed_words, spans, sources)``, one for each row with an id.

    ``spans``: start:end of the passages to remove, in order, comma-joined; ``sources``: sorted doc_ids that keep
    them. Of rows that repeat an id those of its greatest text have its passages. Documents without such a passage have 0, 0, an empty string and an empty array.
    """
    found, _ = counted(repeated_passages(docs, **options))
    per = found.groupBy("doc_id").agg(
        F.max("text_hash").alias("__text_hash"), F.count("*").alias("n_passages"), F.sum("words").alias("n_removed_words"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "end"))), lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias("spans"),
        F.array_sort(F.collect_set("source")).alias("sources"),
    )
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("__hash")).where("doc_id is not null")
    per = per.withColumnRenamed("doc_id", "__doc_id")
    own = (F.col("doc_id") == F.col("__doc_id")) & (F.col("__text_hash").isNull() | (F.col("__text_hash") == F.col("__hash")))
    zero = F.lit(0).cast("long")
    return ids.join(per, own, "left").select("doc_id", F.coalesce("n_passages", zero).alias("n_passages"), F.coalesce("n_removed_words", zero).alias("n_removed_words"), F.coalesce("spans", F.lit("")).alias("spans"), F.coalesce("sources", F.array().cast("array<long>")).alias("sources"))


def remove(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """``docs`` with the passages cut out of the ``text`` they belong to; rows stay, also those of which nothing is left.

    Only documents that the passages' ids may hit are joined; the others pass by a fixed-size filter.
    """
    passages, _ = counted(passages)
    spans = passages.groupBy("doc_id").agg(F.max("text_hash").alias("__text_hash"), F.array_sort(F.collect_list(F.struct("start", "end"))).alias("__spans")).withColumnRenamed("doc_id", "__doc_id")
    marked = mark(docs, "doc_id", passages.select("doc_id"))
    text, empty = F.col("text"), F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))
    step = lambda acc, s: F.struct(F.concat(acc["done"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"])).alias("done"), s["end"].alias("at"))
    cleaned = F.aggregate("__spans", empty, step, lambda acc: F.concat(acc["done"], F.substring(text, acc["at"] + 1, F.length(text))))
    own = (F.col("doc_id") == F.col("__doc_id")) & (F.col("__text_hash").isNull() | (F.col("__text_hash") == F.xxhash64(text.cast("string"))))
    some = marked.where("__hit").join(spans, own, "left").withColumn("text", F.coalesce(cleaned, text)).select(*docs.columns)
    return marked.where("not __hit").select(*docs.columns).unionByName(some)
