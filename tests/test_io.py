import json
import random

import pytest
from pyspark.sql import functions as F

from cairn.operators import enrich, keyspace, logs, seal, snapshots
from cairn.plans.tables import Tables
from cairn.sources import lines, pages, sinks, store
from cairn.streaming import flows


def test_inventory_directory(spark, tmp_path):
    (tmp_path / "s3-buckets.jsonl").write_text('{"Arn":"a","ARN":"b"}\n{bad\n{"Other":1}\n')
    (tmp_path / "empty.jsonl").write_text("")
    views, report = lines.load_inventory(spark, str(tmp_path))
    assert sorted(map(tuple, report.collect())) == [("empty", "empty", 0, 0), ("s3_buckets", "loaded", 2, 1)]
    assert views["s3_buckets"].where("Arn = 'a' or Other = 1").count() == 2 and sorted(spark.table("s3_buckets").columns) == ["ARN", "Arn", "Other"]


def test_missing_log_is_empty(spark, tmp_path):
    with pytest.warns(UserWarning):
        assert lines.read_call_log(spark, str(tmp_path / "none.jsonl")).count() == 0


def test_jsonl_round_trip_and_sinks(spark, sf_dir, tmp_path):
    nation = Tables(spark, sf_dir)("nation")
    sinks.write_jsonl(nation, f"{tmp_path}/n", compression="gzip")
    assert lines.read_jsonl(spark, f"{tmp_path}/n", "n_nationkey int, n_name string, n_regionkey int").exceptAll(nation).count() == 0
    sinks.write_values(nation, "n_name", f"{tmp_path}/v")
    assert lines.read_names(spark, f"{tmp_path}/v").count() == nation.count()
    sinks.write_partitioned(nation, "n_regionkey", f"{tmp_path}/p")
    assert spark.read.json(f"{tmp_path}/p").where("n_regionkey = 1").count() == nation.where("n_regionkey = 1").count()
    sinks.save_snapshot(nation, f"{tmp_path}/s")
    assert sinks.save_snapshot(nation, f"{tmp_path}/s").lines == nation.count()
    assert store.read(spark, f"{tmp_path}/s").count() == nation.count()
    sinks.tee(nation, {"a": lambda d: sinks.write_jsonl(d, f"{tmp_path}/a"), "b": lambda d: sinks.write_values(d, "n_name", f"{tmp_path}/b")})
    assert spark.read.json(f"{tmp_path}/a").count() == spark.read.text(f"{tmp_path}/b").count() == nation.count()


def test_only_clean_runs_are_stored(spark, tmp_path):
    log = spark.createDataFrame([("error",)], "Outcome string")
    assert not snapshots.commit_if_clean(log, logs.is_clean(log), f"{tmp_path}/x") and not (tmp_path / "x").exists()
    assert snapshots.commit_if_clean(log, logs.is_clean(log.limit(0)), f"{tmp_path}/x") and (tmp_path / "x").exists()


def test_models(spark, tmp_path):
    model = {"service": "acm", "operations": {"List": {"input": "In", "output": "Out"}}, "shapes": {"In": {"type": "structure", "required": ["Max"], "members": {"Max": {"shape": "Int"}}}, "Out": {"type": "structure", "members": {"Items": {"shape": "L"}}}, "Int": {"type": "integer"}, "L": {"type": "list"}}}
    (tmp_path / "acm.json").write_text(json.dumps(model, indent=1))
    ops, members = lines_of(pages.read_models(spark, str(tmp_path)))
    assert ops == [("acm", "List")] and members == [("acm", "List", "input", "Max", "integer", True), ("acm", "List", "output", "Items", "list", False)]


def lines_of(frames):
    return [sorted(map(tuple, f.collect())) for f in frames]


def test_sparse_and_bad_pages(spark):
    good = '<ListBucketResult xmlns="x"><Name>b</Name><IsTruncated>true</IsTruncated><NextContinuationToken>t</NextContinuationToken><Contents><Key>a%2Bb+c</Key></Contents></ListBucketResult>'
    rows = pages.parse_listing_pages(spark.createDataFrame([(good,), ('<ListBucketResult xmlns="x"><Name>b</Name></ListBucketResult>',), ("<broken",), (None,)], "body string"), "body").collect()
    assert rows[0].page.Contents[0].Key == "a+b+c" and rows[0].page.Contents[0].Size is None and rows[0].page.IsTruncated and rows[0].page.NextContinuationToken == "t"
    assert rows[1].page.Contents == [] and rows[1].page.CommonPrefixes == [] and rows[2].page is None and rows[3].page is None


def test_sealing(spark):
    key, other = "0123456789abcdef", "fedcba9876543210"
    df = spark.createDataFrame([("x",), ("",), (None,), ("ü" * 200,)], "v string")
    sealed = seal.seal(df, "v", key)
    assert sealed.where(~F.col("v").startswith(seal.PREFIX)).count() == 0 and sealed.where("v like '%\n%'").count() == 0
    good, bad = seal.unseal(sealed, "v", key)
    assert bad.count() == 0 and good.exceptAll(df).count() == 0
    assert seal.unseal(sealed, "v", other)[1].count() == 3
    with pytest.raises(ValueError):
        seal.seal(df, "v", "short")


def test_a_failing_write_keeps_what_is_stored(spark, tmp_path):
    path = f"{tmp_path}/s"
    with pytest.raises(FileNotFoundError):
        store.read(spark, path)
    assert store.read(spark, path, "x long").count() == 0
    old = spark.range(100).selectExpr("id AS x")
    first = store.replace(old, path)
    assert first.lines == 100 and first.bytes > 0
    reader = store.read(spark, path)
    bad = spark.range(0, 1000, 1, 4).selectExpr("CASE WHEN id = 900 THEN raise_error('half-way') ELSE id END AS x")
    for _ in range(2):
        with pytest.raises(Exception, match="half-way"):
            snapshots.commit_if_clean(bad, True, path)
    assert sorted(r.x for r in store.read(spark, path).collect()) == list(range(100))
    assert sorted(p.name for p in tmp_path.joinpath("s").iterdir() if not p.name.startswith(".")) == sorted(["_current", first.run.rsplit("/", 1)[-1]])
    store.replace(spark.range(5).selectExpr("id AS x"), path)
    assert reader.count() == 100 and store.read(spark, path).count() == 5  # who began with the run before can end
    assert store.replace(store.read(spark, path).where("x > 1"), path).lines == 3  # a table may be made of itself
    assert store.replace(old.where("x < 0"), path).lines == 0 and store.read(spark, path).count() == 0


def test_recorded_runs(spark, tmp_path):
    df = spark.range(7)
    entries = snapshots.record_run(df, True, f"{tmp_path}/a", "a", ["x", "--y"], 1000.0, 500, 1.23456).union(snapshots.record_run(df, False, f"{tmp_path}/b", "b", [], 1000.0, 500))
    r = snapshots.list_snapshots(entries, 1100.0, "tool").first()
    assert entries.count() == 1 and (r.key, r.command, r.age, r.expires_in, r.lines, r.duration, r.encrypted) == ("a", "tool x --y", "2m", "7m", 7, 1.235, False)
    assert r.bytes == sum(p.stat().st_size for p in (tmp_path / "a").rglob("*") if p.is_file() and p.parent.name.startswith("run-") and not p.name.endswith(".crc"))
    late = snapshots.list_snapshots(entries.select("key", "expires"), 5000.0).first()
    assert (late.age, late.expires_in, late.command, late.bytes, late.lines) == ("0s", "0s", "cairn", 0, None)
    assert snapshots.sweep(entries, 1400.0).count() == 1 and snapshots.sweep(entries, 1500.0).count() == 0 and snapshots.sweep(entries, 0.0, everything=True).count() == 0


def replayed(lines, current, mode, force, overwrite):
    """One write after the other."""
    table, out = {n: [v, t, k] for n, v, t, k in current}, []
    for name, value, kind, over in lines:
        have = table.get(name)
        over = overwrite if over is None else over
        if not name or value is None or (mode == "update" and have is None):
            out.append((name, None if not name or value is None else None, "error", None))
        elif mode == "update" and have[0] == value and not force:
            out.append((name, value, "unchanged", have[2]))
        elif mode == "put" and have and not over:
            out.append((name, have[0], "conflict", have[2]))
        else:
            action = "update" if have else "create"
            table[name] = [value, have[1] if mode == "update" else kind or "String", (have[2] if have else 0) + 1]
            out.append((name, value, action, table[name][2]))
    return out, sorted((n, *v) for n, v in table.items())


@pytest.mark.parametrize("mode, force, overwrite", [("update", False, False), ("update", True, False), ("put", False, False), ("put", False, True)])
def test_writes_replay_in_order(spark, mode, force, overwrite):
    g = random.Random(4)
    current = [(f"n{i}", g.choice("ab"), g.choice(["String", "SecureString"]), i) for i in range(6)]
    lines = [(g.choice([*(f"n{i}" for i in range(10)), "", None]), g.choice(["a", "b", "c", None]), g.choice(["StringList", None]), g.choice([None, True, False])) for _ in range(200)]
    have = spark.createDataFrame(current, "Name string, Value string, Type string, Version int")
    df = spark.createDataFrame([(*x, i) for i, x in enumerate(lines)], "Name string, Value string, Type string, Overwrite boolean, seq int").repartition(3)
    sealed = seal.seal(df, "Value", "0123456789abcdef", F.col("seq") % 2 == 0)
    plan = snapshots.plan_writes(sealed, have, mode, force, overwrite, order="seq", key="0123456789abcdef")
    want, table = replayed(lines, current, mode, force, overwrite)
    assert [(r.Name, r.Value, r.action, r.Version) for r in plan.orderBy("seq").collect()] == want
    assert sorted((r.Name, r.Value, r.Type, r.Version) for r in snapshots.apply_writes(have, plan).collect()) == table
    lost = snapshots.plan_writes(seal.seal(df, "Value", "another key here"), have, mode, order="seq", key="0123456789abcdef")
    assert {r.action for r in lost.collect()} == {"error"}


def test_puts(spark):
    have = spark.createDataFrame([("a", "1", "String", 4)], "Name string, Value string, Type string, Version int")
    new = spark.createDataFrame([("a", "2", "String"), ("b", "3", "String")], "Name string, Value string, Type string")
    plan = snapshots.plan_writes(new, have)
    assert {r.Name: (r.action, r.Version) for r in plan.collect()} == {"a": ("conflict", 4), "b": ("create", 1)}
    over = snapshots.plan_writes(new, have, overwrite=True)
    assert {r.Name: (r.Value, r.Version) for r in snapshots.apply_writes(have, over).collect()} == {"a": ("2", 5), "b": ("3", 1)}
    assert snapshots.plan_writes(new, have, "update", force=True).where("Name = 'b'").first().action == "error"


@pytest.fixture
def log_path(spark, sf_dir, tmp_path):
    sinks.write_jsonl(Tables(spark, sf_dir)("LOG").drop("event_id"), f"{tmp_path}/log")
    return f"{tmp_path}/log"


def test_stream_equals_batch(spark, log_path, tmp_path):
    q = flows.tail_call_log(spark, log_path).writeStream.outputMode("complete").format("memory").queryName("calls").trigger(availableNow=True).start()
    q.awaitTermination()
    batch = logs.call_summary(lines.read_call_log(spark, log_path))
    assert spark.table("calls").exceptAll(batch).count() == 0 and spark.table("calls").count() == batch.count() > 0
    stream = flows.read_json_stream(spark, log_path, lines.CALL_LOG)
    shaped = flows.shape_stream(stream, lambda d: d.where("Outcome = 'error'"), lambda d: d.select("Service", "Operation"))
    flows.write_stream(shaped, f"{tmp_path}/out", f"{tmp_path}/c1").awaitTermination()
    assert spark.read.json(f"{tmp_path}/out").count() == lines.read_call_log(spark, log_path).where("Outcome = 'error'").count()
    flows.tee_stream(stream, {"ok": lambda d: d.where("Outcome = 'success'"), "bad": lambda d: d.where("Outcome = 'error'")}, f"{tmp_path}/tee", f"{tmp_path}/c2").awaitTermination()
    assert spark.read.json(f"{tmp_path}/tee/ok").count() + spark.read.json(f"{tmp_path}/tee/bad").count() == lines.read_call_log(spark, log_path).count()
    q = flows.running_counts(stream, "Outcome").writeStream.outputMode("complete").format("memory").queryName("kinds").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {r.Outcome for r in spark.table("kinds").collect()} == {"error", "success"}


def test_stream_enrichment_and_containment(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"arn":"1"}\n[1]\nnot json\n{"arn":"2"}\n')
    flows.contain(spark.readStream.text(f"{tmp_path}/in"), lambda d: d.select(F.variant_get("params", "$.arn", "string").alias("arn")), f"{tmp_path}/out", f"{tmp_path}/c").awaitTermination()
    assert sorted(r.arn for r in spark.read.json(f"{tmp_path}/out/good").collect()) == ["1", "2"] and spark.read.text(f"{tmp_path}/out/bad").count() == 2
    tags = spark.createDataFrame([("1", {"a": "b"})], "arn string, tags map<string,string>")
    stream = spark.readStream.schema("arn string, tags map<string,string>").json(f"{tmp_path}/in")
    q = flows.enrich_stream(stream, tags, ["arn"]).where("arn is not null").writeStream.format("memory").queryName("tagged").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {r.arn: r.tags for r in spark.table("tagged").collect()} == {"1": {"a": "b"}, "2": {}}


def test_latest_values_expire_in_the_stream(spark, tmp_path):
    g = random.Random(9)
    times = list(range(0, 400))
    steps = [times[:100], times[200:300], times[100:200], times[300:400]]  # the third comes late, partly too late
    log, runs = [], []
    for i, step in enumerate(steps):
        rows = [(g.choice(["a", "b", "c", "d", ""]) if t < 150 else g.choice(["a", "b", ""]), g.choice(["x", "y", "", None]), float(t)) for t in step]
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{i}.json").write_text("".join(json.dumps({"key": k, "value": v, "ts": t}) + "\n" for k, v, t in rows))
        log += rows
        stream = spark.readStream.schema("key string, value string, ts double").json(f"{tmp_path}/in")
        flows.keep_changes(flows.latest_values_stream(stream, 250), f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
        good = [r for r in log if r[0] and r[1]]
        now = max(t for _, _, t in good)
        want = sorted({k: (k, v, t) for k, v, t in sorted(good, key=lambda r: (r[2], r[1])) if now - t <= 250}.values())
        assert sorted((r.key, r.value, r.ts) for r in flows.kept_values(spark, f"{tmp_path}/out", 250).collect()) == want
        batch = snapshots.latest_values(spark.createDataFrame(log, "key string, value string, ts double"), 250, now)
        assert sorted((r.key, r.value, r.ts) for r in batch.collect()) == want
        runs.append(spark.read.parquet(f"{tmp_path}/out").where("gone").count())
    assert runs[-1] > 0  # state of keys that no longer come is given up


def test_a_late_value_as_old_as_the_ttl_counts(spark, tmp_path):
    steps = ([("a", "new", 1000.0)], [("b", "edge", 750.0), ("c", "old", 749.999), ("a", "late", 750.0)], [("d", "next", 1000.002)])
    for i, step in enumerate(steps):
        spark.createDataFrame(step, "key string, value string, ts double").coalesce(1).write.mode("append").json(f"{tmp_path}/in")
        stream = spark.readStream.schema("key string, value string, ts double").json(f"{tmp_path}/in")
        flows.keep_changes(flows.latest_values_stream(stream, 250), f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
        kept = {r.key: r.value for r in flows.kept_values(spark, f"{tmp_path}/out", 250).collect()}
        assert kept == ({"a": "new"}, {"a": "new", "b": "edge"}, {"a": "new", "d": "next"})[i]
    assert spark.read.parquet(f"{tmp_path}/out").where("gone").select("key").first().key == "b"


def test_sampled_bounds_and_digests(spark):
    g = random.Random(3)
    keys = [f"{g.choice('abcd')}/{g.getrandbits(40):x}" for _ in range(6000)]
    df = spark.createDataFrame([("b", k) for k in keys] + [("b", keys[0])] * 500 + [("s", k) for k in keys[:5]], "Bucket string, Key string").repartition(7)
    bounds = keyspace.sampled_bounds(df, 6).collect()
    cuts = sorted(r.bound for r in bounds if r.Bucket == "b")
    order = sorted(set(keys))
    sizes = [sum(a < k <= e for k in order) for a, e in zip(["", *cuts], [*cuts, "~"], strict=True)]
    assert len(cuts) == 5 and sum(sizes) == len(order) and all(abs(n - 1000) < 250 for n in sizes)
    assert {r.bound for r in keyspace.sampled_bounds(df.repartition(2), 6).collect() if r.Bucket == "b"} == set(cuts)
    assert 0 < sum(r.Bucket == "s" for r in bounds) < 6
    old, new = spark.range(5000).selectExpr("id AS k", "id % 7 AS v"), spark.range(10, 5003).selectExpr("id AS k", "id % 7 AS v")
    twice = new.union(new.limit(3))
    assert enrich.differing_groups(old, new, ["k", "v"], 1000).count() <= 13
    for a, b in ((old, new), (old, twice), (old, old), (old.limit(0), new), (old, new.limit(0))):
        got = sorted(map(tuple, enrich.findings_diff_by_digest(a, b, ["k", "v"], 1000).collect()))
        assert got == sorted(map(tuple, enrich.findings_diff(a, b, ["k", "v"]).collect()))
