"""Tries, rebalanced slices and nested seeds against walks over the sorted keys."""

import random

import pytest
from pyspark.sql import functions as F

from cairn.operators import key_trie, keyspace

CHAIN = ["a/", "a/b/", "a/b/c/", "a/b/c/d1", "a/b/c/e2", "a/b/c/f3"]


def walked(keys):
    """Stem and next characters as a lister finds them: the shared prefix, then along single branches."""
    keys = sorted(set(keys))
    stem = keys[0]
    while not all(k.startswith(stem) for k in keys):
        stem = stem[:-1]
    while True:
        chars = sorted({k[len(stem)] for k in keys if k.startswith(stem) and len(k) > len(stem)})
        if len(chars) != 1:
            return stem, chars
        stem += chars[0]


def keyspaces():
    g = random.Random(7)
    yield CHAIN
    yield ["x"]
    yield ["p/", "p/q"]  # a marker and one key
    yield [*CHAIN, "a/b/c/d1/", "a/b/c/d1/x"]
    yield [f"h/{g.getrandbits(64):016x}" for _ in range(300)]
    yield ["a" * i for i in range(1, 40)]
    yield ["".join(g.choices("ab/é\U0001f600", k=g.randint(1, 9))) for _ in range(400)]
    yield [f"log/{y}/{m:02}/{i}" for y in (2023, 2024) for m in range(1, 13) for i in range(y - 2020)] + ["log/", "log/2023/", "log/2024/"]


def frame(spark, spaces):
    return spark.createDataFrame([(f"b{i}", k) for i, keys in enumerate(spaces) for k in keys], "Bucket string, Key string").repartition(5)


def test_branches(spark):
    spaces = list(keyspaces())
    got = {r.Bucket: (r.stem, list(r.chars)) for r in keyspace.branches(frame(spark, spaces), ["Bucket"]).collect()}
    want = {f"b{i}": walked(keys) for i, keys in enumerate(spaces)}
    assert got == {b: w for b, w in want.items() if w[1]}


def test_radix_split_keeps_what_does_not_part(spark):
    df = frame(spark, [CHAIN, ["a/", "a/b/", "a/b/c"]])
    whole = df.select("Bucket").distinct().selectExpr("Bucket", "'' AS start_after", "'' AS end_at")
    got = sorted((r.Bucket, r.start_after, r.end_at) for r in keyspace.radix_split(keyspace.assign_slices(df, whole), whole).collect())
    assert ("b1", "", "") in got and sum(b == "b1" for b, *_ in got) == 1
    chain = [r[1:] for r in got if r[0] == "b0"]
    counts = sorted(sum(a < k and (not e or k <= e) for k in CHAIN) for a, e in chain)
    assert sum(counts) == 6 and max(counts) == 4 and chain[0][1] == "a/b/c/dd"  # three markers and d1 end at the first bound


@pytest.mark.parametrize("budget", [1, 2, 7, 50])
def test_trie_and_rebalance(spark, budget):
    spaces = list(keyspaces())
    df = frame(spark, spaces)
    nodes = {(r.Bucket, r.stem): (r.is_key, list(r.chars), r.n) for r in key_trie.trie(df, budget).collect()}
    want, bounds = {}, {}
    for i, keys in enumerate(spaces):
        order = sorted(set(keys))
        for a, b in zip(order, order[1:]):
            h = next((j for j, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            below = [k for k in keys if k.startswith(a[:h])]
            if len(below) > budget:
                want[f"b{i}", a[:h]] = (a[:h] in order, sorted({k[h] for k in below if len(k) > h}), len(below))
                bounds.setdefault(f"b{i}", []).append(a if b[: h + 1] == b else b[: h + 1])
    assert nodes == want
    slices = keyspace.rebalance(df, budget, 1).collect()
    for i, keys in enumerate(spaces):
        mine = sorted((s.start_after, s.end_at) for s in slices if s.Bucket == f"b{i}")
        assert [s for s, _ in mine] == sorted({"", *bounds.get(f"b{i}", [])})
        assert [e for _, e in mine] == [*[s for s, _ in mine[1:]], ""]
        for a, e in mine:
            inside = [k for k in keys if k > a and (not e or k <= e)]
            assert len(inside) <= budget or len(set(inside)) == 1


def test_count_below(spark):
    df = frame(spark, [CHAIN, ["a", "a", "b"]])
    stems = spark.createDataFrame([("b0", s) for s in ("", "a/", "a/b/c/", "zz")] + [("b1", "a"), ("b1", ""), ("b2", "a")], "Bucket string, stem string")
    got = {(r.Bucket, r.stem): r.n for r in key_trie.count_below(df, stems).collect()}
    assert got == {("b0", ""): 6, ("b0", "a/"): 6, ("b0", "a/b/c/"): 4, ("b0", "zz"): 0, ("b1", "a"): 2, ("b1", ""): 3, ("b2", "a"): 0}


def test_nested_seeds(spark):
    g = random.Random(5)
    keys = ["".join(g.choices("ab", k=g.randint(1, 60))) for _ in range(300)] + ["a" * i for i in range(1, 60)]
    seeds = {"a" * i for i in range(50)} | {k[: g.randint(0, 50)] for k in keys[:80]} | {"b", "zz", ""}
    objects = frame(spark, [keys, keys[:5]]).withColumn("n", F.length("Key"))
    table = spark.createDataFrame([("b0", s) for s in seeds] + [("b0", "a"), ("b1", "a"), ("b1", None), ("b9", "a")], "Bucket string, prefix string")
    got = sorted((r.Bucket, r.Key, r.n, r.prefix) for r in keyspace.list_from_seeds(objects, table).collect())
    want = [("b0", k, len(k), s) for k in keys for s in seeds if k.startswith(s)] + [("b1", k, len(k), "a") for k in keys[:5] if k.startswith("a")]
    assert got == sorted(want)
    assert keyspace.list_from_seeds(objects, table.limit(0)).count() == 0
