"""Stored listing pages as a source of its own: partitions are seeds, key filters skip pages, and a stream's offsets are resume points.

A page store is a folder of Parquet files with a row for each page: Bucket, first and last (its least and greatest key) and body (the
page's XML). A seed is a stretch of a bucket's keys, as for a scan; each is read in key order by one task. A scanner that still writes adds
pages of greater keys to a seed, and a stream goes on behind the last key of each that it has handled. The store is opened by
the tasks themselves, so its path must be one that they can open through Arrow: a shared folder, or a store that Arrow knows.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote
from xml.etree import ElementTree

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    StringStartsWith,
)

SCHEMA = "Bucket string, Key string, LastModified string, ETag string, Size long, StorageClass string"
PAGES = "Bucket string, first string, last string, body string"
HIGHEST = "\U0010ffff"
#: Pages whose bodies a task holds at once. A page lists 1,000 objects at most, as the stores' interfaces do.
RUN = 64


@dataclass
class Seed(InputPartition):
    """Keys of a bucket after ``start`` and up to ``end``; an empty end is no bound. Pages beyond ``tests`` are passed over."""

    bucket: str
    start: str = ""
    end: str = ""
    tests: tuple[tuple[str, str], ...] = ()

    def __post_init__(self):
        self.value = None  # what the base class holds


def opened(path: str) -> ds.Dataset:
    if "://" in path or path.startswith("file:"):
        where, inside = fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
        return ds.dataset(inside, filesystem=where, format="parquet")
    return ds.dataset(path, format="parquet")


def wanted(seed: Seed) -> pc.Expression:
    """Which pages can hold keys of the seed that pass its tests; Arrow applies it to row groups before it reads them."""
    first, last = ds.field("first"), ds.field("last")
    test = (ds.field("Bucket") == seed.bucket) & (last > seed.start)
    if seed.end:
        test &= first <= seed.end
    for op, v in seed.tests:
        match op:
            case ">" | ">=":
                test &= last > v if op == ">" else last >= v
            case "<" | "<=":
                test &= first < v if op == "<" else first <= v
            case "=":
                test &= (first <= v) & (last >= v)
            case "^":
                test &= (last >= v) & (first <= v + HIGHEST)
    return test


def _read(store: ds.Dataset, columns: list[str], test: pc.Expression | None = None) -> Iterator[pa.RecordBatch]:
    """The rows of one file after the other, a few at a time: nothing is read ahead and no row group is held whole."""
    options = ds.ParquetFragmentScanOptions(use_buffered_stream=True, buffer_size=1 << 16, pre_buffer=False)
    rows = RUN if "body" in columns else 1 << 12
    yield from store.to_batches(columns=columns, filter=test, batch_size=rows, batch_readahead=0, fragment_readahead=0, fragment_scan_options=options, use_threads=False)


def pages_of(path: str, seed: Seed) -> Iterator[str]:
    """The bodies of the seed's pages in key order. The order is found from the keys alone, two a page; bodies are read RUN pages
    after one another."""
    store, test = opened(path), wanted(seed)
    found = sorted({(r["first"], r["last"]) for b in _read(store, ["first", "last"], test) for r in b.to_pylist()})
    for lo in range(0, len(found), RUN):
        some = set(found[lo : lo + RUN])
        own = test & (ds.field("first") >= found[lo][0]) & (ds.field("first") <= found[min(lo + RUN, len(found)) - 1][0])
        bodies = [x for b in _read(store, ["first", "last", "body"], own) for r in b.to_pylist() if (x := (r["first"], r["last"], r["body"]))[:2] in some]
        yield from (x[2] for x in sorted(bodies))


def contents(body: str) -> Iterator[tuple]:
    """(Key, LastModified, ETag, Size, StorageClass) of a page's objects; keys are percent-decoded, absent fields null."""
    for node in ElementTree.fromstring(body):
        if node.tag.rpartition("}")[2] == "Contents":
            v = {x.tag.rpartition("}")[2]: x.text or "" for x in node}
            yield unquote(v["Key"]), v.get("LastModified"), v.get("ETag"), int(v["Size"]) if v.get("Size") else None, v.get("StorageClass")


def objects_of(path: str, seed: Seed) -> Iterator[tuple]:
    for body in pages_of(path, seed):
        for o in contents(body):
            if o[0] > seed.start and (not seed.end or o[0] <= seed.end):
                yield (seed.bucket, *o)


def seeds_of(options: dict) -> list[Seed]:
    """The seeds that the option names, a JSON list of (Bucket, StartAfter, EndAt) objects; else the whole of each bucket in the store."""
    if "seeds" in options:
        return [Seed(s["Bucket"], s.get("StartAfter") or "", s.get("EndAt") or "") for s in json.loads(options["seeds"])]
    buckets = {x for b in _read(opened(options["path"]), ["Bucket"]) for x in pc.unique(b.column("Bucket")).to_pylist()}
    return [Seed(b) for b in sorted(buckets)]


class ListingReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options, self.tests, self.bucket = options, [], None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        ops = {GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<=", EqualTo: "=", StringStartsWith: "^"}
        for f in filters:
            if type(f) in ops and f.attribute == ("Key",):
                self.tests.append((ops[type(f)], f.value))
            elif isinstance(f, EqualTo) and f.attribute == ("Bucket",):
                self.bucket = f.value
            yield f  # pages are passed over; Spark looks at each key

    def partitions(self) -> list[Seed]:
        seeds = [s for s in seeds_of(self.options) if self.bucket in (None, s.bucket)]
        return [Seed(s.bucket, s.start, s.end, tuple(self.tests)) for s in seeds]

    def read(self, partition: Seed) -> Iterator[tuple]:
        return objects_of(self.options["path"], partition)


class ListingStreamReader(DataSourceStreamReader):
    """An offset has, for each seed, the key up to which it is handled: that is its resume point."""

    def __init__(self, options: dict):
        self.options = options

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        out = {}
        for s in seeds_of(self.options):
            reached = max((x for b in _read(opened(self.options["path"]), ["last"], wanted(s)) for x in b.column("last").to_pylist()), default=s.start)
            out[json.dumps([s.bucket, s.start, s.end])] = min(reached, s.end) if s.end else reached
        return out

    def partitions(self, start: dict, end: dict) -> list[Seed]:
        out = []
        for name, reached in end.items():
            bucket, begin, _ = json.loads(name)
            since = max(begin, start.get(name, begin))
            if reached > since:
                out.append(Seed(bucket, since, reached))
        return out

    def read(self, partition: Seed) -> Iterator[tuple]:
        return objects_of(self.options["path"], partition)


class ListingSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "listing_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ListingReader:
        return ListingReader(dict(self.options))

    def streamReader(self, schema) -> ListingStreamReader:
        return ListingStreamReader(dict(self.options))


def _registered(spark: SparkSession) -> None:
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the source goes to the tasks as it is, not as a name
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ListingSource)


def read_listing(spark: SparkSession, path: str, seeds: DataFrame | None = None) -> DataFrame:
    """The objects of a page store. ``seeds`` (Bucket, StartAfter, EndAt), if given, don't overlap; one is a task."""
    _registered(spark)
    reader = spark.read.format("listing_pages").option("path", path)
    return (reader.option("seeds", _json(seeds)) if seeds is not None else reader).load()


def read_listing_stream(spark: SparkSession, path: str, seeds: DataFrame | None = None) -> DataFrame:
    _registered(spark)
    reader = spark.readStream.format("listing_pages").option("path", path)
    return (reader.option("seeds", _json(seeds)) if seeds is not None else reader).load()


def _json(seeds: DataFrame) -> str:
    """Seeds are the partitions of a read, which the driver holds anyway."""
    return json.dumps([r.asDict() for r in seeds.select("Bucket", "StartAfter", "EndAt").collect()])
