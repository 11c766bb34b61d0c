from pyspark.sql import functions as F

from cairn.functions import expr
from cairn.operators import enrich, filters, shape
from cairn.operators.shape import Registry, Shape


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_id_from_arn(spark):
    cases = {"arn:aws:ec2:eu:1:instance/i-1": "i-1", "arn:aws:sns:eu:1:topic": "topic", "arn:aws:logs:eu:1:log-group:a:b": "b", "plain": "", "": ""}
    assert {k: one(spark, expr.id_from_arn(F.lit(k))) for k in cases} == cases


def test_durations_and_ages(spark):
    assert [one(spark, expr.seconds(F.lit(x))) for x in ("90", "15m", "2h", "7d", "1.5h", "2H", " .5 m ", "1e2", "-3s", "x", "", "h", "1.5.2")] == [90, 900, 7200, 604800, 5400, 7200, 30, 100, -3, None, None, None, None]
    ages = (0, 2.5, 3.5, 89, 89.5, 90, 150, 5399, 5400, 5580, 5940, 6300, 6660, 129599, 129600, 1e9 + 4321)
    human = lambda s: f"{s:.0f}s" if s < 90 else f"{s / 60:.0f}m" if s < 5400 else f"{s / 3600:.1f}h" if s < 129600 else f"{s / 86400:.1f}d"
    assert [one(spark, expr.age_text(F.lit(x))) for x in ages] == [human(x) for x in ages]
    tenths = [i * 0.05 for i in range(400)] + [i / 3 for i in range(100)]
    got = spark.createDataFrame([(x,) for x in tenths], "x double").select(expr.one_decimal(F.col("x")).alias("t")).collect()
    assert [r.t for r in got] == [f"{x:.1f}" for x in tenths]


def test_signature_cuts_the_first_line(spark):
    assert one(spark, expr.signature(F.lit(None).cast("string"), F.lit("x" * 80 + "\nmore"))) == "x" * 60
    assert one(spark, expr.signature(F.lit(""), F.lit("a\nb"))) == "a"


def test_tag_spellings_null_keys_and_maps(spark):
    df = spark.sql("""SELECT array(named_struct('TagKey','a','TagValue','1'), named_struct('TagKey','a','TagValue','2'), named_struct('TagKey',cast(null as string),'TagValue','3')) AS t,
        array(named_struct('key','k','value','v')) AS u, map('x','y') AS m, cast(null as map<string,string>) AS n""")
    got = df.select(*(expr.tags_to_map(F.col(c), df.schema[c].dataType).alias(c) for c in df.columns)).first()
    assert (got.t, got.u, got.m, got.n) == ({"a": "2"}, {"k": "v"}, {"x": "y"}, {})


def test_case_variants_stay_apart(spark):
    df = spark.createDataFrame([("n", "arn:x:y:z:1:thing/9")], "Name string, ARN string")
    m = shape.with_envelope(df, Shape("thing", id="", arn="{ARN}", uri="u://{ARN}/{zone}")).first()
    assert (m.Name, m.ARN, m.meta.id, m.meta.arn, m.meta.uri, m.meta.name) == ("n", "arn:x:y:z:1:thing/9", "9", "arn:x:y:z:1:thing/9", None, "")


def test_registry_prefers_programs_then_shapes(spark):
    page = spark.createDataFrame([([("i1",)], "t")], "Items array<struct<Id:string>>, Next string")
    r = Registry(shapes={"List": [Shape("item", ("Items",), id="Id")]})
    assert r.shape("List", page).first().meta.id == "i1"
    assert r.shape("Other", page).columns == ["Id"]
    r.programs["List"] = lambda p: p.select("Next")
    assert r.shape("List", page).columns == ["Next"]
    assert shape.unwrap_default(page.withColumn("More", F.array(F.lit(1)))).columns == ["Items", "Next", "More"]


def test_missing_path_gives_no_rows(spark):
    page = spark.createDataFrame([([("i1",)],)], "Items array<struct<Id:string>>")
    assert shape.explode_path(page, ("Items", "Nothing")).count() == 0


def test_stamp_creates_and_keeps(spark):
    df = spark.createDataFrame([("a",)], "Id string")
    out = shape.stamp_session(df, F.lit("p"), F.lit("r"), F.lit("1")).first().meta
    assert (out.id, out.stamp.profile, out.stamp.region, out.stamp.account) == (None, "p", "r", "1")
    assert shape.stamp_session(df, F.lit("p"), F.lit("r"), F.lit("1"), on=False).columns == ["Id"]


def test_post_explodes_and_drops(spark):
    df = spark.createDataFrame([(1, [1, 2], (1, 2)), (2, [], (3, 4))], "id int, xs array<int>, s struct<a:int,b:int>")
    out = filters.post(df, where="id < 3", explode="xs", drop=["s.b"])
    assert [(r.id, r.xs, r.s.asDict()) for r in out.collect()] == [(1, 1, {"a": 1}), (1, 2, {"a": 1})]


def test_coerce(spark):
    df = spark.createDataFrame([("1.5", "x", "YES")], "d string, l string, b string")
    r = filters.coerce(df, {"d": "double", "l": "long", "b": "boolean"}).first()
    assert (r.d, r.l, r.b) == (1.5, None, True)
    texts = ["a", '["a","b"]', "[1, 2.5, null]", "[bad", "5", "{\"a\": 1}", "", None]
    df = spark.createDataFrame([(t, t, t, ["1", t]) for t in texts], "l string, s string, u string, many array<string>")
    rows = filters.coerce(df, {"l": "list", "s": "structure", "u": "", "many": "list"}).collect()
    value = lambda v: None if v is None else v.toPython()
    assert [None if r.l is None else [value(x) for x in r.l] for r in rows] == [["a"], ["a", "b"], [1, 2.5, None], ["[bad"], [5], [{"a": 1}], [""], None]
    assert [value(r.s) for r in rows] == ["a", ["a", "b"], [1, 2.5, None], "[bad", 5, {"a": 1}, "", None]
    assert [value(r.u) for r in rows] == ["a", ["a", "b"], [1, 2.5, None], "[bad", "5", {"a": 1}, "", None]
    assert [[value(x) for x in r.many] for r in rows][2:4] == [[1, [1, 2.5, None]], [1, "[bad"]]


def test_route_session(spark):
    flat = spark.createDataFrame([(1, "p", "")], "id int, profile string, region string")
    assert [tuple(r) for r in shape.route_session(flat).collect()] == [(1, "p", None)]
    assert [tuple(r) for r in shape.route_session(flat.select("id")).collect()] == [(1, None, None)]
    stamped = spark.createDataFrame([(1, None, (("s", "r"),)), (2, "own", (None,)), (3, "", None)], "id int, profile string, meta struct<stamp:struct<profile:string,region:string>>")
    assert [(r.id, r.profile, r.region) for r in shape.route_session(stamped).collect()] == [(1, "s", "r"), (2, "own", None), (3, None, None)]
    assert shape.route_session(flat.withColumn("meta", F.lit("text"))).columns == ["id", "profile", "region"]


def test_describe_fills_missing_identifiers(spark):
    listed = spark.createDataFrame([("arn:a:b:c:1:x/7", "eu"), ("8", "us")], "Id string, region string")
    detail = spark.createDataFrame([(None, "7", "eu", 1), ("8", "8", "us", 2), ("8", "8", "eu", 3)], "Id string, __key string, region string, v int")
    assert sorted((r.Id, r.v) for r in enrich.describe(listed, detail, "Id", ("region",)).collect()) == [("7", 1), ("8", 2)]


def test_accounts_keep_listed_order_and_report_dead_ones(spark):
    df = spark.createDataFrame([("b", 0, "1"), ("a", 1, "1"), ("c", 2, ""), ("d", 3, None)], "profile string, pos int, account string")
    first, dead = enrich.dedupe_accounts(df)
    assert [r.profile for r in first.collect()] == ["b"] and sorted(r.profile for r in dead.collect()) == ["c", "d"]
    assert enrich.dedupe_accounts(df, explicit=True)[0].count() == 2


def test_empty_tables(spark):
    tags = spark.createDataFrame([], "profile string, region string, arn string, tags map<string,string>")
    df = spark.createDataFrame([("p", "r", "arn:1", "", {})], "profile string, region string, arn string, name string, tags map<string,string>")
    assert enrich.enrich_tags(df, tags).first().tags == {}
    assert enrich.enrich_tags(df.limit(0), tags).count() == 0
