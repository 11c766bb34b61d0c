"""Slices cover every key exactly once, without gaps, on random keyspaces."""

import random

import pytest
from pyspark.sql import functions as F

from cairn.operators import checks, keyspace


def keys(seed):
    r = random.Random(seed)
    out = {"".join(r.choice("ab/") for _ in range(r.randint(1, 6))) for _ in range(150)} | {f"logs/2024/{r.randint(0, 4095):03x}/{i}" for i in range(200)}
    return sorted(out | {"stem", "stem0", "stem00"})


@pytest.fixture(scope="module", params=[1, 2])
def objects(spark, request):
    return spark.createDataFrame([("b", k) for k in keys(request.param)], "Bucket string, Key string").cache()


def exactly_once(objects, slices):
    assert keyspace.check_partition(slices).count() == 0
    got = keyspace.assign_slices(objects, slices).select("Key")
    assert got.count() == objects.count() and got.exceptAll(objects.select("Key")).count() == 0


def test_radix_split(spark, objects):
    whole = spark.createDataFrame([("b", "", "")], "Bucket string, start_after string, end_at string")
    exactly_once(objects, keyspace.radix_split(keyspace.assign_slices(objects, whole), whole))


def test_rebalance(objects):
    slices = keyspace.rebalance(objects, max_pages=1, page=20).cache()
    exactly_once(objects, slices)
    assert keyspace.slice_counts(objects, slices).agg(F.max("n")).first()[0] <= 20


@pytest.mark.parametrize("scheme", ["hex2", "alnum2", "b64-2", "none"])
def test_fixed_split(spark, objects, scheme):
    exactly_once(objects, keyspace.fixed_split(spark, "b", scheme, "logs/2024/"))


def test_bounds_are_exclusive_and_inclusive(spark):
    o = spark.createDataFrame([("b", k) for k in ("a", "b", "c")], "Bucket string, Key string")
    s = spark.createDataFrame([("b", "a", "b"), ("b", "b", "")], "Bucket string, start_after string, end_at string")
    for few in (0, 100):
        assert sorted((r.Key, r.start_after) for r in keyspace.assign_slices(o, s, few=few).collect()) == [("b", "a"), ("c", "b")]


def test_fixed_alphabets():
    assert len(keyspace.alphabet("hex3")) == 4096 and keyspace.alphabet("b64-2") == sorted(keyspace.alphabet("b64-2")) and keyspace.alphabet("none") == []


def test_schedule_emits_each_key_once(objects):
    out = keyspace.list_schedule(objects, ["/", "/"]).where("kind = 'object'").select("key")
    assert out.count() == objects.count() == out.distinct().count()


def test_fan_verdicts(spark):
    rows = [("b", f"one/{i}") for i in range(3)] + [("b", f"fan/{i % 4}/{i}") for i in range(30)] + [("b", f"over/{i}/x") for i in range(30)] + [("b", f"under/{i}") for i in range(120)] + [("b", f"leaf/{i}") for i in range(30)]
    o = spark.createDataFrame(rows, "Bucket string, Key string")
    got = {r.prefix: r.verdict for r in keyspace.fan_profile(o, 1, page=10, max_fan=20).collect()}
    assert got == {"one/": "one-page", "fan/": "fan", "over/": "over-shatter", "under/": "under-shatter", "leaf/": "hot leaf"}


def test_not_in_has_sql_null_semantics(spark):
    groups = spark.createDataFrame([(1, [([("0.0.0.0/0",)],)]), (2, [([("10.0.0.0/8",)],)]), (3, None)], "group int, Perms array<struct<Ranges:array<struct<Cidr:string>>>>")
    used = spark.createDataFrame([(5,)], "group int")
    assert [r.group for r in checks.check_unattached_open(groups, [used]).collect()] == [1]
    assert checks.check_unattached_open(groups, [used, spark.createDataFrame([(None,)], "group int")]).count() == 0


def test_seeds(spark):
    kind = "Bucket string, Prefix string, Uri string, Delimiter string, Delimiters array<string>, StartAfter string, EndAt string, bucket string, meta struct<uri:string,stamp:struct<profile:string,region:string>>, region string"
    rows = [
        (None, None, "s3://b/p/q", "/", None, None, None, None, None, None), ("c", "", None, "/", None, "k", "z", None, None, None),
        ("b", "", "s3://b/x/", None, None, None, None, None, None, None), (None, "p/", "s3://c/y/", None, ["/", "/"], None, None, None, None, None),
        ("", None, None, None, [], None, None, "low", ("s3://no/no", ("ops", "eu")), "us"), (None, None, None, None, None, None, None, None, ("s3://m/k", None), None),
        (None, "p", None, None, None, None, None, None, None, None), (None, None, "http://x/y", None, None, None, None, None, None, None), (None, None, "s3:///y", None, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, kind)
    good, bad = keyspace.to_seeds(df)
    plain = [("b", "p/q", ["/"], "", "", None, None, False, ""), ("c", "", [], "k", "z", None, None, False, ""), ("b", "", [], "", "", None, None, False, ""), ("c", "y/", ["/", "/"], "", "", None, None, False, ""), ("low", "", [], "", "", "ops", "us", False, ""), ("m", "k", [], "", "", None, None, False, "")]
    assert [tuple(r) for r in good.collect()] == plain
    assert [r.Uri for r in bad.collect()] == [None, "http://x/y", "s3:///y"] and bad.columns == df.columns
    assert [r.Delimiters for r in keyspace.to_seeds(df, ("|",))[0].collect()] == [["|"], [], ["|"], ["/", "/"], ["|"], ["|"]]
    more = spark.createDataFrame([("b", "true", "v")], "Bucket string, Versions string, VersionAfter string")
    assert tuple(keyspace.to_seeds(more)[0].first())[-2:] == (True, "v")


def test_fixed_splits_of_all_buckets(spark):
    buckets = spark.createDataFrame([("a",), ("b",)], "Bucket string")
    for scheme, n in (("hex2", 257), ("hex3", 4097), ("none", 1)):
        every = keyspace.fixed_split_all(buckets, scheme, "p/", "p/1", "")
        for name in ("a", "b"):
            assert sorted(map(tuple, every.where(f"Bucket = '{name}'").collect())) == sorted(map(tuple, keyspace.fixed_split(spark, name, scheme, "p/", "p/1").collect()))
        assert scheme != "none" or every.count() == 2 * n
