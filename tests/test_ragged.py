"""Ragged pages against a walk over plain Python values, and inventories against their files."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.operators import ragged
from cairn.operators.shape import Shape
from cairn.sources import lines


def reached(node, path):
    if not path:
        return [node]
    value = node.get(path[0]) if isinstance(node, dict) else None
    if value is None:
        return []
    return [x for item in (value if isinstance(value, list) else [value]) for x in reached(item, path[1:])]


def random_node(g, depth):
    kind = g.choice(["dict"] * 4 + ["list"] * 3 + ["null", "text", "number"]) if depth else g.choice(["null", "text", "number", "empty"])
    if kind == "dict":
        return {k: random_node(g, depth - 1) for k in g.sample(["A", "a", "B b", "C"], g.randint(0, 4))}
    if kind == "list":
        return [random_node(g, depth - 1) for _ in range(g.randint(0, 3))]
    return {"null": None, "text": "x", "number": 7, "empty": []}[kind]


def pages(spark, nodes):
    return spark.createDataFrame([(i, json.dumps(n)) for i, n in enumerate(nodes)], "i int, text string").select("i", F.try_parse_json("text").alias("page"))


@pytest.mark.parametrize("path", [(), ("A",), ("A", "B b"), ("a", "A", "C")])
def test_walk(spark, path):
    g = random.Random(1)
    nodes = [random_node(g, 5) for _ in range(300)] + [{"A": {"B b": [1, None, {"x": []}]}}]
    got = sorted((r.i, r.t) for r in ragged.walk(pages(spark, nodes), "page", path).select("i", F.to_json("item").alias("t")).collect())
    want = sorted((i, json.dumps(x, separators=(",", ":"), sort_keys=True)) for i, n in enumerate(nodes) for x in reached(n, path))
    assert [(i, json.loads(t)) for i, t in got] == [(i, json.loads(t)) for i, t in want]


TAGS = [
    [{"Key": "a", "Value": "1"}, {"Key": "a", "Value": "2"}, {"Key": None, "TagKey": "k", "Value": "x"}, {"TagKey": "b", "TagValue": None, "value": "no"}, {"key": "c", "value": 3}, {"Value": "lost"}, "junk", None, ["list"]],
    {"m": "1", "n": None, "o": 2}, [], {}, None, "text", 5,
]
MAPS = [{"a": "2", "b": None, "c": "3"}, {"m": "1", "n": None, "o": "2"}, {}, {}, {}, {}, {}]


def test_tags(spark):
    got = pages(spark, TAGS).orderBy("i").select(ragged.tag_map(F.col("page")).alias("m")).collect()
    assert [r.m for r in got] == MAPS


def test_records(spark):
    items = [{"Id": "i", "Name": "n", "Tags": TAGS[0], "Owner": "me"}, {"Id": None, "Owner": ["no"], "Tags": {"Name": "tagged"}, "z": None}, {"Id": 5, "Tags": "kept"}, "word", None, [1], {}]
    df = pages(spark, [{"Items": items, "Region": "eu", "More": {"x": 1}}]).withColumn("keep", F.lit(1))
    shape = Shape("t", ("Items",), id="Id", name="Name", arn="a:b:c:d:{account}:x/{Id}", uri="u://{root_Region}/{Owner}")
    made = ragged.records(df, "page", shape, {"account": F.lit("9"), "Owner": F.lit("ctx")})
    assert made.columns == ["i", "keep", "item", "meta"]
    got = [(r.item.toPython(), r.meta.id, r.meta.name, r.meta.arn, r.meta.tags, r.meta.uri) for r in made.collect()]
    assert got == [
        ({"Id": "i", "Name": "n", "Owner": "me"}, "i", "n", "a:b:c:d:9:x/i", MAPS[0], "u://eu/me"), ({"Id": None, "Owner": ["no"], "z": None}, "", "tagged", "", {"Name": "tagged"}, None),
        ({"Id": 5, "Tags": "kept"}, "5", "", "a:b:c:d:9:x/5", {}, "u://eu/ctx"), ({"Value": "word"}, "", "", "", {}, "u://eu/ctx"), ({"Value": None}, "", "", "", {}, "u://eu/ctx"), ({"Value": [1]}, "", "", "", {}, "u://eu/ctx"), ({}, "", "", "", {}, "u://eu/ctx"),
    ]
    assert ragged.records(df.limit(0), "page", shape, {"account": F.lit("9")}).count() == 0
    many = ragged.normalize(pages(spark, [{"A": {"Id": 1}, "B": [{"Id": 2}, {"Id": 3}]}]), "page", [Shape("a", ("A",), id="Id"), Shape("b", ("B",), id="Id")])
    assert sorted((r.meta.type, r.meta.id) for r in many.collect()) == [("a", "1"), ("b", "2"), ("b", "3")]


def test_schema_of_json():
    found = "OBJECT<A: DECIMAL(2,1), `a b`: BIGINT, n: OBJECT<y: ARRAY<VARIANT>, e: OBJECT<>>, `q```: BOOLEAN, v: VOID, z: ARRAY<VOID>, d: DOUBLE>"
    want = T.StructType().add("A", "double").add("a b", "long").add("n", T.StructType().add("y", T.ArrayType(T.StringType())).add("e", T.StructType())).add("q`", "boolean").add("v", "string").add("z", T.ArrayType(T.StringType())).add("d", "double")
    assert lines.schema_of_json(found) == want
    for bad in ("BIGINT", "ARRAY<BIGINT>"):
        with pytest.raises(ValueError):
            lines.schema_of_json(bad)


def test_inventory_of_many_files(spark, tmp_path):
    folder = tmp_path / "in ventory+1"
    folder.mkdir()
    for i in range(120):
        (folder / f"t-{i:03}.jsonl").write_text("".join(json.dumps({"id": j, f"f{i}": {"x": [j / 2]}, "Mixed": "t" if j % 2 else 1}) + "\n" for j in range(i % 7)))
    (folder / "odd.jsonl").write_text('[1]\n"x"\n{bad\n\n')
    (folder / "_hidden.jsonl").write_text('{"a":1}\n')
    (folder / "deep.jsonl").mkdir()
    (folder / "deep.jsonl" / "part-0").write_text('{"a":"1","A":2}\n{bad\n')
    (folder / "deep.jsonl" / "part-1").write_text('{"b":1.5}\n')
    tracker, group = spark.sparkContext.statusTracker(), "inventory"
    spark.sparkContext.setJobGroup(group, group)
    views, report = lines.load_inventory(spark, str(folder))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(tracker.getJobIdsForGroup(group)) < 8  # however many files there are
    got = {r.table: (r.status, r.rows, r.skipped) for r in report.collect()}
    assert got == {f"t_{i:03}": ("loaded" if i % 7 else "empty", i % 7, 0) for i in range(120)} | {"odd": ("failed", 0, 3), "deep": ("loaded", 2, 1)}
    assert views["t_006"].count() == 6 and [tuple(r) for r in views["t_002"].orderBy("id").select("id", "f2.x", "Mixed").collect()] == [(0, [0.0], "1"), (1, [0.5], "t")]
    assert sorted(views["deep"].columns) == ["A", "a", "b"] and views["deep"].count() == 2
