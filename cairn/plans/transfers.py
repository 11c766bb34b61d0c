"""Queries of the readers, writers and streams: what is written to the shared folder and read back equals the table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.operators import keyspace, logs, shape, snapshots
from cairn.operators.shape import Registry, Shape
from cairn.plans.tables import Tables, query
from cairn.session import shared_folder
from cairn.sources import lines, listing_source, pages, sinks, store
from cairn.streaming import flows


def _folder(t: Tables) -> str:
    return f"{shared_folder(t.spark)}/transfer-{uuid.uuid4().hex}"


def _log(t: Tables) -> str:
    """The call log as JSON lines; their folder."""
    path = _folder(t)
    sinks.write_jsonl(t("LOG").drop("event_id"), path)
    return path


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def s1_read_jsonl(t: Tables) -> DataFrame:
    path, rows = _folder(t), t("customer").select("c_custkey", "c_name", "c_acctbal")
    sinks.write_jsonl(rows, path)
    sinks.write_values(rows.where("c_custkey % 10 = 0").select(F.concat(F.lit('{"c_custkey":'), "c_name").alias("bad")), "bad", path, mode="append")
    return lines.read_jsonl(t.spark, path, "c_custkey long, c_name string, c_acctbal double")


@query("""SELECT 'my_region' AS "table", 'loaded' AS status, count(*) AS rows, 0 AS skipped, count(*) AS n FROM region
    UNION ALL SELECT 'customer', 'loaded', count(*), 0, count(*) FROM customer UNION ALL SELECT 'nothing', 'empty', 0, 0, NULL
    UNION ALL SELECT 'bad', 'failed', 0, count(*), NULL FROM nation UNION ALL SELECT 'mixed', 'loaded', count(*), count(*), count(*) FROM nation""")
def s2_load_inventory(t: Tables) -> DataFrame:
    path = _folder(t)
    for name, df in (("my-region", t("region")), ("customer", t("customer")), ("nothing", t("region").limit(0)), ("mixed", t("nation"))):
        sinks.write_jsonl(df, f"{path}/{name}.jsonl")
    for name in ("bad", "mixed"):
        sinks.write_values(t("nation"), "n_name", f"{path}/{name}.jsonl", mode="append")
    views, report = lines.load_inventory(t.spark, path)
    counts = None
    for name, df in views.items():
        n = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "n")
        counts = n if counts is None else counts.union(n)
    return report.join(counts, "table", "left")


#: Objects that a listing page holds at most.
PAGE = 1000


def _page_store(objects: DataFrame) -> DataFrame:
    """Listing pages in XML, each of at most PAGE objects of a bucket that follow one another, with their least and greatest keys; in key
    order, as scanners write them."""
    one = F.struct("Key", F.concat(F.lit("<Contents><Key>"), F.replace("Key", F.lit("/"), F.lit("%2F")), F.lit("</Key><Size>"), F.col("Size").cast("string"), F.lit("</Size></Contents>")).alias("xml"))
    body = F.concat(F.lit('<ListBucketResult xmlns="http://example.com/doc/"><Name>b</Name>'), F.array_join(F.sort_array(F.collect_list(one))["xml"], ""), F.lit("</ListBucketResult>"))
    ranked = keyspace.with_rank(objects, "Bucket", "Key").withColumn("page", F.floor((F.col("rank") - 1) / PAGE))
    pages = ranked.groupBy("Bucket", "page").agg(F.min("Key").alias("first"), F.max("Key").alias("last"), body.alias("body")).drop("page")
    return pages.repartitionByRange("Bucket", "first").sortWithinPartitions("Bucket", "first")


def _write_pages(objects: DataFrame, path: str) -> None:
    """Row groups of some 8 MB, so that a reader of a few pages passes the others over."""
    _page_store(objects).write.mode("append").option("parquet.block.size", 8 << 20).parquet(path)


@query("SELECT Bucket, Key, Size FROM $OBJ WHERE Key >= '2024/01/05' AND Key < '2024/01/20/8' AND Bucket <> 'b-view'")
def s5_listing_source(t: Tables) -> DataFrame:
    """Pages outside the key range are passed over; three seeds cut a bucket."""
    path = _folder(t)
    _write_pages(t("OBJ"), path)
    cuts = F.explode(F.array(*(F.struct(F.lit(a).alias("StartAfter"), F.lit(b).alias("EndAt")) for a, b in (("", "2024/01/07/7"), ("2024/01/07/7", "2024/01/18"), ("2024/01/18", "")))))
    seeds = t("OBJ").where("Bucket <> 'b-view'").select("Bucket").distinct().select("Bucket", cuts.alias("s")).select("Bucket", "s.*")
    return listing_source.read_listing(t.spark, path, seeds).where("Key >= '2024/01/05' and Key < '2024/01/20/8'").select("Bucket", "Key", "Size")


@query("SELECT Bucket, Key, Size, 1 AS times FROM $OBJ")
def s5_listing_stream(t: Tables) -> DataFrame:
    """A scan that is stopped and goes on: each object comes once."""
    path = _folder(t)
    for part in ("Key < '2024/01/11'", "Key >= '2024/01/11'"):
        _write_pages(t("OBJ").where(part), f"{path}/pages")
        stream = listing_source.read_listing_stream(t.spark, f"{path}/pages")
        _finished(flows.write_stream(stream, f"{path}/out", f"{path}/state"))
    return t.spark.read.schema("Bucket string, Key string, Size long").json(f"{path}/out").groupBy("Bucket", "Key", "Size").agg(F.count("*").alias("times"))


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def s3_save_snapshot(t: Tables) -> DataFrame:
    path, rows = _folder(t), t("orders").select("o_orderkey", "o_orderstatus")
    for df in (rows.where("o_orderstatus = 'F'"), rows, rows):
        sinks.save_snapshot(df, path)
    return store.read(t.spark, path)


@query("SELECT Ts, Service, Operation, Profile, Region, DurationS, HttpStatus, Attempts, Items, Outcome, ErrorCode, Message FROM $LOG")
def s4_read_call_log(t: Tables) -> DataFrame:
    return lines.read_call_log(t.spark, _log(t))


@query("SELECT DISTINCT service, operation, direction, member, CASE WHEN member IN ('Id', 'ID') THEN 'integer' ELSE 'string' END AS type, member = 'Id' AS required FROM $MODEL")
def s9_read_models(t: Tables) -> DataFrame:
    path, m = _folder(t), t("MODEL").distinct()
    kind = F.when(F.col("member").isin("Id", "ID"), "Int").otherwise("Text")
    side = m.groupBy("service", "operation", "direction").agg(F.map_from_entries(F.collect_list(F.struct("member", F.struct(kind.alias("shape"))))).alias("members"), F.collect_list(F.when(F.col("member") == "Id", "Id")).alias("required"))
    side = side.withColumn("name", F.concat("operation", "direction"))
    of = lambda d: F.max(F.when(F.col("direction") == d, F.col("name"))).alias(d)
    ops = side.groupBy("service", "operation").agg(of("input"), of("output")).groupBy("service").agg(F.map_from_entries(F.collect_list(F.struct("operation", F.struct("input", "output")))).alias("operations"))
    scalar = lambda n, k: F.struct(F.lit(n).alias("name"), F.struct(F.lit(k).alias("type"), F.array().cast("array<string>").alias("required"), F.create_map().cast("map<string,struct<shape:string>>").alias("members")).alias("shape"))
    own = F.collect_list(F.struct("name", F.struct(F.lit("structure").alias("type"), "required", "members").alias("shape")))
    shapes = side.groupBy("service").agg(F.map_from_entries(F.concat(own, F.array(scalar("Int", "integer"), scalar("Text", "string")))).alias("shapes"))
    models = ops.join(shapes, "service").select(F.pmod(F.xxhash64("service"), F.lit(8)).alias("file"), F.struct("service", "operations", "shapes").alias("model"))
    models.groupBy("file").agg(F.to_json(F.collect_list("model")).alias("value")).write.partitionBy("file").text(path)  # a file each, of an array of models
    return pages.read_models(t.spark, path)[1]


@query("SELECT event_id, ts FROM events")
def k1_write_jsonl(t: Tables) -> DataFrame:
    path = _folder(t)
    sinks.write_jsonl(t("events").select("event_id", "ts"), path)
    return lines.read_jsonl(t.spark, path, "event_id long, ts string").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"))


@query("""SELECT k AS kind, CASE k WHEN 'lines' THEN count(*) WHEN 'failed' THEN count(*) FILTER (Outcome = 'error') ELSE count(*) FILTER (Attempts > 1) END AS n, count(*) AS written
    FROM $LOG, (VALUES ('lines'), ('failed'), ('retried')) v(k) GROUP BY k""")
def a9_counted_write(t: Tables) -> DataFrame:
    """Run counters taken while the run is written, beside what is read back."""
    path, log = _folder(t), t("LOG").drop("event_id")
    counts = sinks.write_counted(log, path, {"failed": F.col("Outcome") == "error", "retried": F.col("Attempts") > 1})
    kinds = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.lit(n).cast("long").alias("n")) for k, n in counts.items())))
    return lines.read_call_log(t.spark, path).agg(F.count("*").alias("written")).select(kinds.alias("k"), "written").select("k.*", "written")


@query("SELECT p_name AS name, count(*) AS n FROM part GROUP BY p_name")
def k2_write_values(t: Tables) -> DataFrame:
    path = _folder(t)
    sinks.write_values(t("part"), "p_name", path)
    return lines.read_names(t.spark, path).groupBy("name").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, o_custkey FROM orders")
def k3_write_compressed(t: Tables) -> DataFrame:
    path = _folder(t)
    sinks.write_jsonl(t("orders").select("o_orderkey", "o_custkey"), path, compression="gzip")
    return lines.read_jsonl(t.spark, path, "o_orderkey long, o_custkey long")


@query("SELECT 'odd' AS sink, c_custkey FROM customer WHERE c_custkey % 2 = 1 UNION ALL SELECT 'all', c_custkey FROM customer")
def k4_tee(t: Tables) -> DataFrame:
    path = _folder(t)
    sinks.tee(t("customer").select("c_custkey"), {"odd": lambda d: sinks.write_jsonl(d.where("c_custkey % 2 = 1"), f"{path}/odd"), "all": lambda d: sinks.write_jsonl(d, f"{path}/all")})
    made = [lines.read_jsonl(t.spark, f"{path}/{n}", "c_custkey long").select(F.lit(n).alias("sink"), "c_custkey") for n in ("odd", "all")]
    return made[0].union(made[1])


@query("SELECT lang, doc_id FROM documents")
def k5_write_partitioned(t: Tables) -> DataFrame:
    path = _folder(t)
    sinks.write_partitioned(t("documents").select("doc_id", "lang"), "lang", path)
    return t.spark.read.schema("doc_id long, lang string").json(path).select("lang", "doc_id")


@query("SELECT 'clean' AS run, count(*) AS calls FROM $LOG WHERE Outcome = 'success' UNION ALL SELECT 'partial', 0")
def c7_commit_if_clean(t: Tables) -> DataFrame:
    out = None
    for name, log in (("clean", t("LOG").where("Outcome = 'success'")), ("partial", t("LOG"))):
        path = _folder(t)
        stored = snapshots.commit_if_clean(log, logs.is_clean(log), path)
        n = (store.read(t.spark, path) if stored else log.limit(0)).agg(F.count("*").alias("calls")).select(F.lit(name).alias("run"), "calls")
        out = n if out is None else out.union(n)
    return out


@query("""SELECT 'calls' AS key, 'cairn logs --all' AS command, '30m' AS age, '2.0h' AS expires_in, count(*) AS lines, true AS has_bytes FROM $LOG WHERE Outcome = 'success'""")
def c4_recorded_run(t: Tables) -> DataFrame:
    """The catalogue of a clean and a partial run, with the lines and bytes counted while they were written."""
    path, entries = _folder(t), None
    for name, log in (("calls", t("LOG").where("Outcome = 'success'")), ("partial", t("LOG"))):
        entry = snapshots.record_run(log, logs.is_clean(log), f"{path}/{name}", name, ["logs", "--all"], 1e6, 9000.0)
        entries = entry if entries is None else entries.union(entry)
    found = snapshots.list_snapshots(entries, 1e6 + 1800)
    return found.select("key", "command", "age", "expires_in", "lines", (F.col("bytes") > 0).alias("has_bytes"))


@query("SELECT concat(CAST(l_orderkey AS STRING), '/', CAST(l_linenumber AS STRING)) AS id FROM lineitem")
def n9_root_template(t: Tables) -> DataFrame:
    page = t("lineitem").groupBy(F.col("l_orderkey").alias("OrderId")).agg(F.collect_list(F.struct(F.col("l_linenumber").alias("Line"))).alias("Lines"))
    return shape.normalize(page, [Shape("line", ("Lines",), arn="{root_OrderId}/{Line}")]).select(F.col("meta.arn").alias("id"))


@query("""SELECT 'custom' AS way, CAST(o_orderkey AS STRING) AS id FROM orders UNION ALL SELECT 'declared', CAST(o_orderkey AS STRING) FROM orders UNION ALL SELECT 'default', CAST(o_orderkey AS STRING) FROM orders""")
def x2_registry(t: Tables) -> DataFrame:
    page = t("orders").groupBy(F.col("o_custkey").alias("customer")).agg(F.collect_list(F.struct(F.col("o_orderkey").alias("Id"))).alias("Items"))
    declared = {"A": [Shape("order", ("Items",), id="Id")], "B": [Shape("order", ("Items",), id="Id")]}
    ways = Registry({"A": lambda p: p.select(F.explode("Items.Id").alias("made"))}, declared)
    text = lambda c: F.col(c).cast("string").alias("id")
    custom = ways.shape("A", page).select(F.lit("custom").alias("way"), text("made"))
    stated = ways.shape("B", page).select(F.lit("declared").alias("way"), text("meta.id"))
    return custom.union(stated).union(ways.shape("C", page.select("Items")).select(F.lit("default").alias("way"), text("Id")))


@query("""SELECT signature, n, row_number() OVER (ORDER BY n DESC, signature) AS rank
    FROM (SELECT coalesce(ErrorCode, substr(Message, 1, 60)) AS signature, count(*) AS n FROM $LOG WHERE Outcome = 'error' GROUP BY 1)""")
def w9_ordered_errors(t: Tables) -> DataFrame:
    errors = logs.error_summary(t("LOG")).withColumn("low", -F.col("n"))
    return keyspace.with_rank(errors, "low", "signature").drop("low")


def _finished(stream) -> None:
    stream.awaitTermination()


@query("SELECT Service, Operation, Profile AS profile, Region AS region, 'own' AS account, count(*) AS n FROM $LOG WHERE Outcome = 'error' GROUP BY ALL")
def t1_shape_stream(t: Tables) -> DataFrame:
    """Stamped, then filtered, then shaped."""
    path, stream = _folder(t), flows.read_json_stream(t.spark, _log(t), lines.CALL_LOG)
    stamp = lambda d: shape.stamp_session(d, F.col("Profile"), F.col("Region"), F.lit("own"))
    keep = lambda d: d.where("Outcome = 'error' and meta.stamp.account = 'own'")
    shaped = flows.shape_stream(stream, stamp, keep, lambda d: d.select("Service", "Operation", F.struct("meta.stamp").alias("meta")))
    _finished(flows.write_stream(shaped, f"{path}/out", f"{path}/state"))
    read = t.spark.read.schema(f"Service string, Operation string, meta struct<stamp:{shape.STAMP}>").json(f"{path}/out")
    return read.groupBy("Service", "Operation", "meta.stamp.profile", "meta.stamp.region", "meta.stamp.account").agg(F.count("*").alias("n"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'own' ELSE c_mktsegment END AS segment FROM customer")
def t2_enrich_stream(t: Tables) -> DataFrame:
    path, own = _folder(t), F.create_map(F.lit("segment"), F.lit("own"))
    records = t("customer").select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, own).otherwise(F.create_map().cast("map<string,string>")).alias("tags"))
    sinks.write_jsonl(records, f"{path}/in")
    table = t("customer").select("c_custkey", F.create_map(F.lit("segment"), "c_mktsegment").alias("tags"))
    stream = flows.read_json_stream(t.spark, f"{path}/in", "c_custkey long, tags map<string,string>")
    _finished(flows.write_stream(flows.enrich_stream(stream, table, ["c_custkey"]), f"{path}/out", f"{path}/state"))
    return t.spark.read.schema("c_custkey long, tags map<string,string>").json(f"{path}/out").select("c_custkey", F.col("tags")["segment"].alias("segment"))


@query("SELECT Outcome AS sink, Service, count(*) AS n FROM $LOG GROUP BY 1, 2")
def t3_tee_stream(t: Tables) -> DataFrame:
    path, stream = _folder(t), flows.read_json_stream(t.spark, _log(t), lines.CALL_LOG)
    kinds = ("success", "error")
    _finished(flows.tee_stream(stream, {k: (lambda d, k=k: d.where(F.col("Outcome") == k)) for k in kinds}, f"{path}/out", f"{path}/state"))
    made = [t.spark.read.schema("Service string").json(f"{path}/out/{k}/*").select(F.lit(k).alias("sink"), "Service") for k in kinds]
    return made[0].union(made[1]).groupBy("sink", "Service").agg(F.count("*").alias("n"))


def _totals(t: Tables, df: DataFrame) -> DataFrame:
    """The last result of a stream of totals, of which there are few."""
    name = f"totals_{uuid.uuid4().hex}"
    _finished(df.writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", _folder(t)).trigger(availableNow=True).start())
    return t.spark.table(name)


@query("SELECT Outcome, count(*) AS n FROM $LOG GROUP BY 1")
def t4_running_counts(t: Tables) -> DataFrame:
    return _totals(t, flows.running_counts(flows.read_json_stream(t.spark, _log(t), lines.CALL_LOG), "Outcome"))


@query("""SELECT Service, Operation, count(*) AS calls, sum(DurationS) AS total_s, sum(Attempts)::BIGINT AS attempts, (sum(Attempts) - count(*))::BIGINT AS retries,
    sum(CASE WHEN Outcome = 'error' THEN 1 ELSE 0 END)::BIGINT AS errors FROM $LOG GROUP BY 1, 2""")
def t5_tail_call_log(t: Tables) -> DataFrame:
    return _totals(t, flows.tail_call_log(t.spark, _log(t)))


@query("""SELECT CAST(user_id AS STRING) AS key, arg_max(event_type, event_id) AS value, max(event_id)::DOUBLE AS ts FROM events
    WHERE event_type <> 'error' AND event_id >= (SELECT max(event_id) - 700 FROM events WHERE event_type <> 'error') GROUP BY user_id""")
def c8_latest_stream(t: Tables) -> DataFrame:
    """The log in several micro-batches, in no order of time; values expire as newer ones come."""
    path = _folder(t)
    value = F.when(F.col("event_type") != "error", F.col("event_type")).otherwise("")
    log = t("events").select(F.col("user_id").cast("string").alias("key"), value.alias("value"), F.col("event_id").cast("double").alias("ts"))
    sinks.write_jsonl(log.repartition(4, "ts"), f"{path}/in")
    stream = t.spark.readStream.schema("key string, value string, ts double").option("maxFilesPerTrigger", 1).json(f"{path}/in")
    _finished(flows.keep_changes(flows.latest_values_stream(stream, 700.0), f"{path}/out", f"{path}/state"))
    return flows.kept_values(t.spark, f"{path}/out", 700.0)


@query("SELECT event_id % 3 > 0 AS good, count(*) AS n FROM events GROUP BY 1")
def t6_contain(t: Tables) -> DataFrame:
    path, events = _folder(t), t("events")
    line = F.when(F.col("event_id") % 3 > 0, F.to_json(F.struct("event_id"))).otherwise(F.concat(F.lit("event "), F.col("event_id").cast("string")))
    sinks.write_values(events.select(line.alias("line")), "line", f"{path}/in")
    _finished(flows.contain(t.spark.readStream.text(f"{path}/in"), lambda d: d.select(F.variant_get("params", "$.event_id", "long").alias("event_id")), f"{path}/out", f"{path}/state"))
    good, bad = t.spark.read.schema("event_id long").json(f"{path}/out/good/*").where("event_id is not null"), t.spark.read.text(f"{path}/out/bad/*")
    made = [df.agg(F.count("*").alias("n")).select(F.lit(k).alias("good"), "n") for k, df in ((True, good), (False, bad))]
    return made[0].union(made[1])


@query("SELECT c_custkey, CAST(floor((row_number() OVER (ORDER BY CAST(c_custkey AS STRING)) - 1) / 10) AS BIGINT) AS batch FROM customer")
def j10_describe_unscoped(t: Tables) -> DataFrame:
    from cairn.operators import enrich

    d = t("customer").select("c_custkey")
    return enrich.describe(d, d, "c_custkey", batch_size=10).select("c_custkey", "batch")
