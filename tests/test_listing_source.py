"""Stored listing pages as a source: seeds, filters that pass pages over, and streams that go on."""

import random

import pytest
from pyspark.sql.datasource import EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual, StringContains, StringStartsWith

from cairn.operators import enrich
from cairn.plans import transfers
from cairn.sources import listing_source
from cairn.streaming import flows


def page(bucket, keys):
    body = "".join(f"<Contents><Key>{k.replace('/', '%2F').replace(' ', '%20')}</Key>{f'<Size>{len(k)}</Size>' if len(k) % 2 else ''}<ETag>e</ETag></Contents>" for k in keys)
    return (bucket, keys[0], keys[-1], f'<r xmlns="http://x/"><Name>{bucket}</Name>{body}<CommonPrefixes><Prefix>p</Prefix></CommonPrefixes></r>')


def keyspace(seed, n=400):
    g = random.Random(seed)
    return sorted({f"{g.choice('abc')}/{g.choice(['x y', 'é', 'z+1'])}/{g.getrandbits(20):x}" for _ in range(n)})


def store(spark, path, spaces, size=20):
    rows = [page(b, keys[i : i + size]) for b, keys in spaces.items() for i in range(0, len(keys), size)]
    random.Random(1).shuffle(rows)
    spark.createDataFrame(rows, listing_source.PAGES).repartition(3).write.mode("append").parquet(path)


@pytest.fixture(scope="module")
def spaces():
    return {"b0": keyspace(1), "b1": keyspace(2, 50), "b2": ["only"]}


def test_whole_store_and_seeds(spark, tmp_path, spaces):
    path = str(tmp_path / "pages")
    store(spark, path, spaces)
    rows = listing_source.read_listing(spark, path).collect()
    assert sorted((r.Bucket, r.Key) for r in rows) == sorted((b, k) for b, keys in spaces.items() for k in keys)
    assert all((r.Size, r.ETag, r.StorageClass) == (len(r.Key) if len(r.Key) % 2 else None, "e", None) for r in rows)
    k = spaces["b0"]
    cuts = [("b0", "", k[30]), ("b0", k[30], k[31] + "!"), ("b0", k[31] + "!", ""), ("b1", "zzz", None), ("none", "", "")]
    seeds = spark.createDataFrame(cuts, "Bucket string, StartAfter string, EndAt string")
    df = listing_source.read_listing(spark, path, seeds)
    assert df.rdd.getNumPartitions() == 5 and sorted(r.Key for r in df.collect()) == k
    assert sorted(r.Key for r in df.where(f"Key > '{k[25]}' and Key <= '{k[90]}'").collect()) == k[26:91]
    assert sorted(r.Key for r in listing_source.read_listing(spark, path).where("Key like 'b/x%' and Bucket = 'b1'").collect()) == [x for x in spaces["b1"] if x.startswith("b/x")]


def test_filters_pass_pages_over(spark, tmp_path, spaces):
    path = str(tmp_path / "pages")
    store(spark, path, spaces)
    k = spaces["b0"]
    pages = [k[i : i + 20] for i in range(0, len(k), 20)]
    key = ("Key",)
    for filters, test in (
        ([GreaterThan(key, k[39])], lambda x: x > k[39]), ([GreaterThanOrEqual(key, k[39])], lambda x: x >= k[39]), ([LessThan(key, k[40])], lambda x: x < k[40]), ([LessThanOrEqual(key, k[40])], lambda x: x <= k[40]),
        ([EqualTo(key, k[55])], lambda x: x == k[55]), ([StringStartsWith(key, "b/")], lambda x: x.startswith("b/")), ([GreaterThan(key, k[50]), LessThan(key, k[70])], lambda x: k[50] < x < k[70]),
    ):
        reader = listing_source.ListingReader({"path": path})
        kept = [*filters, EqualTo(("Bucket",), "b0"), StringContains(key, "x"), EqualTo(("ETag",), "e")]
        assert list(reader.pushFilters(kept)) == kept  # Spark looks again
        (seed,) = reader.partitions()
        bodies = list(listing_source.pages_of(path, seed))
        assert len(bodies) == sum(any(test(x) for x in p) for p in pages) < len(pages)
        got = [o[1] for o in reader.read(seed) if test(o[1])]
        assert got == [x for x in k if test(x)]  # in key order


def test_a_stopped_stream_goes_on(spark, tmp_path, spaces):
    path, expected = str(tmp_path / "pages"), []
    for lo, hi in ((0, 60), (60, 61), (61, 61), (61, 10_000)):  # pages that end where a run ended, and a run with nothing new
        step = {b: keys[lo:hi] for b, keys in spaces.items() if keys[lo:hi]}
        if step:
            store(spark, path, step)
        expected += [(b, k) for b, keys in step.items() for k in keys]
        stream = listing_source.read_listing_stream(spark, path)
        flows.write_stream(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
        out = spark.read.schema("Bucket string, Key string").json(str(tmp_path / "out")).selectExpr("concat(Bucket, ':', Key) AS key")
        want = spark.createDataFrame([(f"{b}:{k}",) for b, k in expected], "key string")
        assert enrich.exactly_once(out, want, "key").count() == 0


def test_pages_and_what_a_task_holds_of_them_are_bounded(spark, tmp_path, spaces, monkeypatch):
    objects = spark.range(2500).selectExpr("'b' AS Bucket", "concat('2024/01/01/', lpad(id, 6, '0')) AS Key", "id AS Size")  # one bucket and day
    transfers._write_pages(objects, str(tmp_path / "large"))
    pages = spark.read.parquet(str(tmp_path / "large")).selectExpr("first", "last", "size(split(body, '<Contents>')) - 1 AS n").orderBy("first").collect()
    assert sum(r.n for r in pages) == 2500 and max(r.n for r in pages) <= transfers.PAGE and all(a.last < b.first for a, b in zip(pages, pages[1:]))
    assert [r.Key for r in listing_source.read_listing(spark, str(tmp_path / "large")).orderBy("Size").collect()] == [f"2024/01/01/{i:06}" for i in range(2500)]
    path, read = str(tmp_path / "pages"), listing_source._read
    store(spark, path, spaces)
    held = []
    monkeypatch.setattr(listing_source, "RUN", 3)
    monkeypatch.setattr(listing_source, "_read", lambda s, columns, test=None: (held.append((b.num_rows, columns)) or b for b in read(s, columns, test)))
    assert [o[1] for o in listing_source.objects_of(path, listing_source.Seed("b0"))] == spaces["b0"]
    assert max(n for n, columns in held if "body" in columns) <= 3 and len(held) > 3
