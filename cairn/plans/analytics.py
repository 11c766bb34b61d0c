"""Queries of the checks, log analytics, keyspace and snapshot operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.functions import expr
from cairn.operators import checks, key_trie, keyspace, logs, seal, snapshots
from cairn.plans.tables import Tables, query
from cairn.session import cut
from cairn.sources import pages

KEYS = ["Type", "Id", "Name", "Arn", "Tags"]
IN_KEYS = "('Type', 'Id', 'Name', 'Arn', 'Tags')"


@query("SELECT Id FROM $RES WHERE Id % 3 = 0 AND Segment = 'BUILDING'")
def p4_public_endpoint(t: Tables) -> DataFrame:
    cidrs = F.when(F.col("Segment") == "BUILDING", F.array(F.lit("10.0.0.0/8"), F.lit(checks.OPEN))).otherwise(F.array(F.lit("10.0.0.0/8")))
    rows = t("RES").select("Id", F.struct((F.col("Id") % 3 == 0).alias("public"), cidrs.alias("cidrs")).alias("access"))
    return checks.check_public_endpoint(rows).select("Id")


def _certs(t: Tables) -> DataFrame:
    used = t("lineitem").where("l_returnflag = 'R'").groupBy("l_orderkey").agg(F.collect_list("l_linenumber").alias("used_by"))
    return t("orders").join(used, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "EXPIRED").otherwise("ISSUED").alias("status"), "used_by")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def p5_expired_in_use(t: Tables) -> DataFrame:
    return checks.check_expired(_certs(t), True).select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def p5_expired_unused(t: Tables) -> DataFrame:
    return checks.check_expired(_certs(t), False).select("o_orderkey")


@query("SELECT DISTINCT doc_id FROM labels WHERE quality = 0")
def p7_flag_off(t: Tables) -> DataFrame:
    return checks.check_flag_off(t("labels").withColumn("good", F.col("quality") == 1), "good", "doc_id")


@query("SELECT DISTINCT s_suppkey AS profile, n_name AS role FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name LIKE '%A'")
def j1_privileged_profiles(t: Tables) -> DataFrame:
    profiles = t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("profile"), F.array("n_name").alias("roles"))
    policies = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("role"), F.concat(F.lit("arn:policy/"), "r_name").alias("policy_arn"))
    return checks.check_privileged_profiles(profiles, t("nation").select(F.col("n_name").alias("role")), policies, "A")


@query("SELECT DISTINCT o_custkey AS db, o_orderkey AS \"group\" FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM $ITEM WHERE Cidr = '0.0.0.0/0')")
def j2_open_databases(t: Tables) -> DataFrame:
    dbs = t("orders").groupBy(F.col("o_custkey").alias("db")).agg(F.collect_list("o_orderkey").alias("groups"))
    return checks.check_open_databases(dbs, t.groups())


@query("SELECT DISTINCT d.doc_id, l.doc_id IS NOT NULL AS bucket_known, p.page_id IS NOT NULL AS blocked FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id LEFT JOIN pages p ON d.doc_id = p.page_id")
def j3_trail_buckets(t: Tables) -> DataFrame:
    return checks.check_trail_buckets(t("documents"), t("labels"), t("pages").withColumnRenamed("page_id", "doc_id"), "doc_id")


@query("""SELECT DISTINCT l_orderkey AS "group" FROM $ITEM WHERE Cidr = '0.0.0.0/0' AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' UNION SELECT c_custkey FROM customer)""")
def j4_unattached_open(t: Tables) -> DataFrame:
    one = t("orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("group"))
    return checks.check_unattached_open(t.groups(), [one, t("customer").select(F.col("c_custkey").alias("group"))])


@query("SELECT DISTINCT doc_id, CASE quality WHEN 0 THEN 'Suspended' WHEN 1 THEN 'Enabled' END AS status FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL OR quality <> 1")
def j5_unversioned(t: Tables) -> DataFrame:
    status = t("labels").select("doc_id", F.when(F.col("quality") == 1, "Enabled").otherwise("Suspended").alias("status"))
    return checks.check_unversioned(t("documents"), status, "doc_id")


@query("""SELECT c_custkey AS key, date_diff('day', DATE '1995-01-01' + CAST(c_custkey % 2000 AS INT), DATE '2001-08-01') AS age_days, date_diff('day', CAST(last_used AS DATE), DATE '2001-08-01') AS idle_days
    FROM customer LEFT JOIN $KEYS k ON c_custkey = k.key WHERE age_days > 2200 OR idle_days > 600 OR idle_days IS NULL""")
def j6_stale_keys(t: Tables) -> DataFrame:
    created = F.date_add(F.lit("1995-01-01").cast("date"), (F.col("c_custkey") % 2000).cast("int"))
    return checks.check_stale_keys(t("customer").select(F.col("c_custkey").alias("key"), created.alias("created")), t("KEYS"), "key", "2001-08-01", 2200, 600)


@query("SELECT s_nationkey, s_suppkey % 3 AS zone, count(*) AS total, sum(CASE WHEN s_acctbal > 5000 THEN 0 ELSE 1 END)::BIGINT AS not_redundant FROM supplier GROUP BY 1, 2 HAVING not_redundant > 0")
def a1_single_zone(t: Tables) -> DataFrame:
    rows = t("supplier").withColumn("zone", F.col("s_suppkey") % 3).withColumn("redundant", F.when(F.col("s_acctbal") > 5000, True))
    return checks.check_single_zone(rows, ["s_nationkey", "zone"], "redundant")


@query("SELECT count(*) AS total, sum(quality)::BIGINT AS enabled, round(100.0 * sum(quality)::DOUBLE / count(*)::DOUBLE, 2) AS percent FROM labels")
def a2_coverage(t: Tables) -> DataFrame:
    return checks.coverage(t("labels").withColumn("on", F.col("quality") == 1), "on")


CALLS = "count(*) AS calls, sum(DurationS) AS total_s, sum(Attempts)::BIGINT AS attempts, (sum(Attempts) - count(*))::BIGINT AS retries, sum(CASE WHEN Outcome = 'error' THEN 1 ELSE 0 END)::BIGINT AS errors"


@query(f"SELECT Service, Operation, {CALLS.replace('sum(DurationS)', 'CAST(sum(DurationS) AS DOUBLE)')} FROM $LOG WHERE Ts BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-20' GROUP BY 1, 2")
def a3_call_summary(t: Tables) -> DataFrame:
    ts = lambda x: F.lit(x).cast(dict(t("events").dtypes)["ts"])
    return logs.call_summary(t("LOG"), ts("2024-01-03"), ts("2024-01-20")).withColumn("total_s", F.col("total_s").cast("double"))


@query("SELECT min(ts) AS first_ts, max(ts) AS last_ts FROM events")
def a4_log_extent(t: Tables) -> DataFrame:
    return logs.log_extent(t("LOG"))


@query("""WITH p AS (SELECT Service, Operation, sum(DurationS) AS s, sum(CASE WHEN Attempts > 1 THEN DurationS ELSE 0 END) AS r FROM $LOG GROUP BY 1, 2)
    SELECT Service, Operation, CAST(s AS DOUBLE) AS total_s, round(s::DOUBLE / (sum(s) OVER ())::DOUBLE, 6) AS share, round(r::DOUBLE / s::DOUBLE, 6) AS retried_share FROM p""")
def a5_call_share(t: Tables) -> DataFrame:
    return logs.call_share(t("LOG")).withColumn("total_s", F.col("total_s").cast("double"))


SIGNATURE = "coalesce(ErrorCode, substr(Message, 1, 60))"


@query(f"SELECT {SIGNATURE} AS signature, count(*) AS n FROM $LOG WHERE Outcome = 'error' GROUP BY 1")
def a6_error_summary(t: Tables) -> DataFrame:
    return logs.error_summary(t("LOG"))


@query(f"SELECT signature, Ts, Service, Operation, Profile, Region FROM (SELECT {SIGNATURE} AS signature, * FROM $LOG WHERE Outcome = 'error') QUALIFY row_number() OVER (PARTITION BY signature ORDER BY Ts, Service, Operation, Profile, Region) = 1")
def a7_first_errors(t: Tables) -> DataFrame:
    return logs.first_errors(t("LOG"))


@query("SELECT Profile, Region, count(*) AS calls, sum(CASE WHEN Outcome = 'error' THEN 1 ELSE 0 END)::BIGINT AS errored, errored = 0 AS clean FROM $LOG GROUP BY 1, 2")
def a8_fanout_outcome(t: Tables) -> DataFrame:
    return logs.fanout_outcome(t("LOG"))


@query("""SELECT count(*) FILTER (k = 0) AS tasks, count(*) FILTER (k = 1) AS calls, count(*) FILTER (k = 2) AS objects, count(*) FILTER (k = 3) AS prefixes, count(*) FILTER (k = 4) AS splits,
    count(*) FILTER (k = 5) AS abandons, count(*) FILTER (event_type = 'error') AS failures FROM (SELECT *, event_id % 6 AS k FROM events)""")
def a9_run_stats(t: Tables) -> DataFrame:
    kinds = F.array(*map(F.lit, ("task", "call", "object", "prefix", "split", "abandon")))
    return logs.run_stats(t("events").select(F.get(kinds, (F.col("event_id") % 6).cast("int")).alias("kind"), (F.col("event_type") == "error").alias("failed")))


@query("""SELECT 'customer' AS type, count(*) AS n FROM customer UNION ALL SELECT 'parameter', count(*) FROM part UNION ALL SELECT 'object', count(*) FROM events
    UNION ALL SELECT kind, count(*) FROM $VER GROUP BY 1 UNION ALL SELECT CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE 'order' END, count(*) FROM orders GROUP BY 1
    UNION ALL SELECT 'profile', count(*) FROM supplier""")
def a10_count_by_type(t: Tables) -> DataFrame:
    """Over all inventories: full and lean envelopes, versions and markers, two types in one table."""
    from cairn.operators import shape
    from cairn.plans.records import RESOURCE

    kinds = lambda df, kind: df.select(F.struct(kind.alias("type")).alias("meta"))
    orders = [shape.with_envelope(t("orders").where(f"(o_orderstatus = 'F') = {closed}"), shape.Shape(kind, id="o_orderkey")).select("meta") for kind, closed in (("closed", "true"), ("order", "false"))]
    return logs.count_by_type([
        shape.with_envelope(t("RES"), RESOURCE).select("meta"), shape.shape_parameters(t("PAR")).select("meta"), keyspace.lean_objects(t("OBJ")).select("meta"),
        kinds(t("VER"), F.col("kind")), *orders, shape.with_envelope(t("SESS"), shape.Shape("profile", id="profile")).select("meta"),
    ])


@query(f"SELECT upper(substr(member, 1, 1)) || lower(substr(member, 2)) AS key, count(*) FILTER (member IN {IN_KEYS}) AS exact, count(*) FILTER (member NOT IN {IN_KEYS}) AS near, count(DISTINCT service) AS services FROM $MODEL WHERE member <> 'Other' GROUP BY 1")
def a12_name_collisions(t: Tables) -> DataFrame:
    return logs.name_collisions(t("MODEL"), KEYS)


@query(f"""WITH p AS (SELECT service, bool_or(member IN {IN_KEYS}) AS e, bool_or(member NOT IN {IN_KEYS} AND member <> 'Other') AS n FROM $MODEL GROUP BY 1)
    SELECT count(*) AS services, count(*) FILTER (e) AS exact, count(*) FILTER (n) AS near, count(*) FILTER (e OR n) AS either, round(100.0 * (count(*) FILTER (e OR n))::DOUBLE / count(*)::DOUBLE, 2) AS either_percent FROM p""")
def a13_collision_totals(t: Tables) -> DataFrame:
    return logs.collision_totals(t("MODEL"), KEYS)


@query(f"SELECT service, count(*) AS hits FROM $MODEL WHERE member IN {IN_KEYS} GROUP BY 1 ORDER BY hits DESC, service LIMIT 10")
def a14_collision_topk(t: Tables) -> DataFrame:
    return logs.collision_topk(t("MODEL"), KEYS, 10)


@query(f"SELECT member, count(*) AS n, count(DISTINCT service) AS services FROM $MODEL WHERE member NOT IN {IN_KEYS} AND member <> 'Other' GROUP BY 1")
def a15_collision_spelling(t: Tables) -> DataFrame:
    return logs.collision_spelling(t("MODEL"), KEYS)


@query("""SELECT CASE Items % 3 WHEN 0 THEN 'hit' WHEN 1 THEN 'miss' ELSE 'off' END AS "Cache", count(*) AS runs, CAST(sum(DurationS) AS DOUBLE) AS total_s,
    CAST(sum(CASE WHEN Items % 3 = 0 THEN DurationS ELSE 0 END) AS DOUBLE) AS saved_s, count(*) FILTER (Outcome = 'error') AS failures FROM $LOG GROUP BY 1""")
def a16_audit_summary(t: Tables) -> DataFrame:
    cache = F.when(F.col("Items") % 3 == 0, "hit").when(F.col("Items") % 3 == 1, "miss").otherwise("off")
    audit = t("LOG").withColumns({"Cache": cache, "SavedS": F.when(F.col("Items") % 3 == 0, F.col("DurationS")).otherwise(F.lit(0).cast("decimal(12,2)")), "ExitCode": F.when(F.col("Outcome") == "error", 1).otherwise(0)})
    return logs.audit_summary(audit).withColumns({"total_s": F.col("total_s").cast("double"), "saved_s": F.col("saved_s").cast("double")})


@query("SELECT Service, min(Ts) AS starts, max(Ts) AS ends, starts < lag(max(Ts)) OVER (ORDER BY min(Ts), Service) AS overlaps FROM $LOG GROUP BY Service")
def w1_overlap_check(t: Tables) -> DataFrame:
    return logs.overlap_check(t("LOG"))


# keyspace

DAY = "substr(Key, 1, 11)"


@query(f"SELECT Bucket, 'prefix' AS kind, {DAY} AS key, count(*) AS n FROM $OBJ WHERE Key > '2024/01/03' GROUP BY 1, 3")
def o1_list_level(t: Tables) -> DataFrame:
    return keyspace.list_level(t("OBJ"), "2024/01/", "/", "2024/01/03")


@query(f"""SELECT Bucket, 2 AS level, 'object' AS kind, Key AS key FROM $OBJ
    UNION ALL SELECT DISTINCT Bucket, 0, 'prefix', substr(Key, 1, 5) FROM $OBJ UNION ALL SELECT DISTINCT Bucket, 1, 'prefix', substr(Key, 1, 8) FROM $OBJ""")
def o2_list_schedule(t: Tables) -> DataFrame:
    return keyspace.list_schedule(t("OBJ"), ["/", "/"])


@query(f"SELECT Bucket, Key, {DAY} AS prefix FROM $OBJ WHERE {DAY} IN ('2024/01/02/', '2024/01/09/')")
def o3_list_from_seeds(t: Tables) -> DataFrame:
    seeds = keyspace.list_level(t("OBJ"), "2024/01/").where("key in ('2024/01/02/', '2024/01/09/')").select("Bucket", F.col("key").alias("prefix"))
    return keyspace.list_from_seeds(t("OBJ"), seeds).select("Bucket", "Key", "prefix")


@query("""SELECT Bucket, Key, substr(Key, 1, l) AS prefix FROM $OBJ, (VALUES (0), (4), (5), (8), (11), (12), (13)) s(l)
    WHERE starts_with(Key, '2024/01/02/') OR l <= 8""")
def o3_nested_seeds(t: Tables) -> DataFrame:
    """Seeds that lie in one another: every key is below several."""
    lengths = F.explode(F.array(*map(F.lit, (0, 4, 5, 8, 11, 12, 13)))).alias("l")
    seeds = t("OBJ").select("Bucket", "Key", lengths).where("startswith(Key, '2024/01/02/') or l <= 8").select("Bucket", F.substring(F.col("Key"), F.lit(1), F.col("l")).alias("prefix"))
    return keyspace.list_from_seeds(t("OBJ").select("Bucket", "Key"), seeds)


@query(f"""WITH p AS (SELECT Bucket, substr(Key, 1, 8) AS prefix, count(*) AS n, count(DISTINCT {DAY}) AS fan, CAST(ceil(count(*) / 100.0) AS BIGINT) AS pages FROM $OBJ GROUP BY 1, 2)
    SELECT *, CASE WHEN pages <= 1 THEN 'one-page' WHEN fan > 28 THEN 'over-shatter' WHEN fan > 0 THEN 'fan' WHEN pages > 10 THEN 'under-shatter' ELSE 'hot leaf' END AS verdict FROM p""")
def o4_fan_profile(t: Tables) -> DataFrame:
    return keyspace.fan_profile(t("OBJ"), depth=2, page=100, max_fan=28)


@query(f"SELECT Bucket, {DAY} AS day, min(Key) AS low, max(Key) AS high, count(*) AS n, {DAY} AS stem FROM $OBJ GROUP BY Bucket, {DAY} HAVING substr(min(Key), 12, 1) <> substr(max(Key), 12, 1)")
def o5_common_stem(t: Tables) -> DataFrame:
    return keyspace.common_stem(t("OBJ").withColumn("day", F.substring("Key", 1, 11)), ["Bucket", "day"]).where("substr(low, 12, 1) <> substr(high, 12, 1)")


@query(f"SELECT Bucket, {DAY} AS day, {DAY} AS stem, string_agg(DISTINCT substr(Key, 12, 1), '' ORDER BY substr(Key, 12, 1)) AS chars FROM $OBJ GROUP BY Bucket, {DAY} HAVING count(DISTINCT substr(Key, 12, 1)) > 1")
def o6_branches(t: Tables) -> DataFrame:
    b = keyspace.branches(t("OBJ").withColumn("day", F.substring("Key", 1, 11)), ["Bucket", "day"])
    return b.where(F.length("stem") == 11).select("Bucket", "day", "stem", F.array_join("chars", "").alias("chars"))


def _whole(t: Tables) -> DataFrame:
    return t("OBJ").select("Bucket").distinct().select("Bucket", F.lit("").alias("start_after"), F.lit("").alias("end_at"))


@query("""WITH s AS (SELECT Bucket, substr(min(Key), 1, 8) AS stem FROM $OBJ GROUP BY 1), c AS (SELECT DISTINCT Bucket, substr(Key, 9, 1) AS c FROM $OBJ),
    b AS (SELECT x.Bucket, stem || x.c || y.c AS b FROM c x JOIN c y USING (Bucket) JOIN s USING (Bucket))
    SELECT Bucket, coalesce(lag(b) OVER (PARTITION BY Bucket ORDER BY b), '') AS start_after, b AS end_at FROM b UNION ALL SELECT Bucket, max(b), '' FROM b GROUP BY 1""")
def o7_radix_split(t: Tables) -> DataFrame:
    return keyspace.radix_split(keyspace.assign_slices(t("OBJ"), _whole(t)), _whole(t))


@query("""WITH h AS (SELECT CASE WHEN i < 10 THEN chr((48 + i)::INT) ELSE chr((87 + i)::INT) END AS c FROM range(16) r(i)), b AS (SELECT '2024/01/05/' || x.c || y.c AS b FROM h x, h y),
    s AS (SELECT coalesce(lag(b) OVER (ORDER BY b), '') AS start_after, b AS end_at FROM b UNION ALL SELECT max(b), '' FROM b)
    SELECT Bucket, start_after, end_at, count(*) AS n FROM $OBJ JOIN s ON Key > start_after AND (end_at = '' OR Key <= end_at) GROUP BY ALL""")
def o8_fixed_split(t: Tables) -> DataFrame:
    slices = keyspace.fixed_split_all(t("OBJ").select("Bucket").distinct(), "hex2", "2024/01/05/")
    return keyspace.slice_counts(t("OBJ"), slices)


#: The trie of all keys, by the prefixes of every length; nodes with over 80 objects.
TRIE = """k AS (SELECT Bucket, Key, count(*) AS w FROM $OBJ GROUP BY ALL),
    heavy AS (SELECT Bucket, substr(Key, 1, l) AS stem, sum(w)::BIGINT AS n FROM k, range(0, 45) g(l) WHERE l <= length(Key) GROUP BY ALL HAVING sum(w) > 80),
    pairs AS (SELECT Bucket, Key, lead(Key) OVER (PARTITION BY Bucket ORDER BY Key) AS nxt FROM k),
    met AS (SELECT *, list_max(list_filter(range(0, 45), lambda l: l <= least(length(Key), length(nxt)) AND substr(Key, 1, l) = substr(nxt, 1, l))) AS h FROM pairs WHERE nxt IS NOT NULL),
    cuts AS (SELECT m.Bucket, m.Key, nxt, h, stem, n FROM met m JOIN heavy x ON x.Bucket = m.Bucket AND x.stem = substr(m.Key, 1, h))"""


@query(f"""WITH {TRIE} SELECT c.Bucket, stem, any_value(n) AS n, bool_or(c.Key = stem) AS is_key,
    (SELECT string_agg(DISTINCT substr(k.Key, length(c.stem) + 1, 1), '' ORDER BY substr(k.Key, length(c.stem) + 1, 1)) FROM k WHERE k.Bucket = c.Bucket AND starts_with(k.Key, c.stem)) AS chars FROM cuts c GROUP BY c.Bucket, stem""")
def o5_trie(t: Tables) -> DataFrame:
    return key_trie.trie(t("OBJ"), 80).select("Bucket", "stem", "n", "is_key", F.array_join("chars", "").alias("chars"))


@query(f"""WITH {TRIE}, b AS (SELECT DISTINCT Bucket, CASE WHEN substr(nxt, 1, h + 1) = nxt THEN Key ELSE substr(nxt, 1, h + 1) END AS b FROM cuts),
    s AS (SELECT Bucket, coalesce(lag(b) OVER (PARTITION BY Bucket ORDER BY b), '') AS start_after, b AS end_at FROM b UNION ALL SELECT Bucket, coalesce(max(b), ''), '' FROM (SELECT DISTINCT Bucket FROM k) LEFT JOIN b USING (Bucket) GROUP BY Bucket)
    SELECT s.Bucket, start_after, end_at, count(o.Key) AS n, count(o.Key) <= 80 AS small FROM s JOIN $OBJ o ON o.Bucket = s.Bucket AND o.Key > start_after AND (end_at = '' OR o.Key <= end_at) GROUP BY ALL""")
def o9_rebalance(t: Tables) -> DataFrame:
    slices = cut(keyspace.rebalance(t("OBJ"), max_pages=2, page=40))
    return keyspace.slice_counts(t("OBJ"), slices).withColumn("small", F.col("n") <= 80)


@query(f"""SELECT Bucket, {DAY} AS day, {DAY} AS stem, string_agg(DISTINCT substr(Key, 12, 1), '' ORDER BY substr(Key, 12, 1)) AS chars FROM $OBJ GROUP BY Bucket, {DAY} HAVING count(DISTINCT substr(Key, 12, 1)) > 1""")
def o6_marker_chains(t: Tables) -> DataFrame:
    """With folder markers above the keys, the stem is the folder that holds them."""
    keys = t("OBJ").select("Bucket", "Key", F.substring("Key", 1, 11).alias("day"))
    markers = keys.select("Bucket", "day").distinct().select("Bucket", F.explode(F.array(F.substring("day", 1, 5), F.substring("day", 1, 8), "day")).alias("Key"), "day")
    return keyspace.branches(keys.unionByName(markers), ["Bucket", "day"]).where(F.length("stem") == 11).select("Bucket", "day", "stem", F.array_join("chars", "").alias("chars"))


def _done(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Slices of days, those of odd buckets completed, and keys handled up to a point."""
    days = t("OBJ").select("Bucket", F.substring("Key", 1, 10).alias("d")).distinct()
    slices = days.select("Bucket", F.col("d").alias("start_after"), F.concat("d", F.lit("/~")).alias("end_at"))
    completed = slices.where("Bucket in ('b-click', 'b-view')")
    handled = keyspace.assign_slices(t("OBJ").where("event_id % 2 = 0"), slices).select("Bucket", "start_after", "end_at", F.col("Key").alias("key"), F.lit(False).alias("is_prefix"))
    return slices, completed, handled


LEFT = """(SELECT Bucket, d AS start_after, d || '/~' AS end_at, coalesce(max(Key) FILTER (event_id % 2 = 0), d) AS resume_after FROM (SELECT *, substr(Key, 1, 10) AS d FROM $OBJ) GROUP BY Bucket, d)"""


@query(f"SELECT Bucket, '{{\"Bucket\":\"' || Bucket || '\",\"StartAfter\":\"' || resume_after || '\",\"EndAt\":\"' || end_at || '\"}}' AS seed FROM {LEFT} WHERE Bucket NOT IN ('b-click', 'b-view')")
def o10_failed_seeds(t: Tables) -> DataFrame:
    return keyspace.failed_seeds(*_done(t))


@query(f"SELECT * FROM {LEFT}")
def w3_resume_points(t: Tables) -> DataFrame:
    slices, _, handled = _done(t)
    return keyspace.resume_points(slices, handled)


@query(f"SELECT Bucket, start_after, end_at FROM {LEFT} WHERE Bucket NOT IN ('b-click', 'b-view')")
def u5_remaining(t: Tables) -> DataFrame:
    slices, completed, _ = _done(t)
    return keyspace.remaining(slices, completed)


@query("""SELECT (SELECT sum(ceil(n / 1000.0))::BIGINT FROM (SELECT count(*) AS n FROM $OBJ GROUP BY Bucket)) AS serial_pages,
    sum(greatest(ceil(n / 1000.0), 1))::BIGINT AS sliced_calls, count(*) AS slices FROM (SELECT count(*) AS n FROM $OBJ GROUP BY Bucket, substr(Key, 1, 10))""")
def o11_listing_cost(t: Tables) -> DataFrame:
    return keyspace.listing_cost(t("OBJ"), _done(t)[0])


@query("SELECT Bucket, count(*) AS n, true AS gapless FROM $OBJ GROUP BY 1")
def o12_split_with(t: Tables) -> DataFrame:
    slices = cut(keyspace.split_with(t("OBJ"), lambda o: keyspace.even_bounds(o, 16)))
    gaps = keyspace.check_partition(slices).select("Bucket").distinct().withColumn("gap", F.lit(True))
    return keyspace.slice_counts(t("OBJ"), slices).groupBy("Bucket").agg(F.sum("n").alias("n")).join(gaps, "Bucket", "left").select("Bucket", "n", F.col("gap").isNull().alias("gapless"))


@query("""WITH k AS (SELECT Bucket, Key, row_number() OVER (PARTITION BY Bucket ORDER BY md5(Key), Key) AS h FROM (SELECT DISTINCT Bucket, Key FROM $OBJ)),
    s AS (SELECT Bucket, Key, row_number() OVER (PARTITION BY Bucket ORDER BY Key) AS r, count(*) OVER (PARTITION BY Bucket) AS m FROM k WHERE h <= 4 * 64),
    b AS (SELECT Bucket, Key AS b FROM s WHERE floor(r * 4 / m) > floor((r - 1) * 4 / m) AND r < m),
    x AS (SELECT Bucket, coalesce(lag(b) OVER (PARTITION BY Bucket ORDER BY b), '') AS start_after, b AS end_at FROM b UNION ALL SELECT Bucket, max(b), '' FROM b GROUP BY 1)
    SELECT x.Bucket, start_after, end_at, count(*) AS n FROM x JOIN $OBJ o ON o.Bucket = x.Bucket AND o.Key > start_after AND (end_at = '' OR o.Key <= end_at) GROUP BY ALL""")
def o12_sampled_split(t: Tables) -> DataFrame:
    """Four parts of each bucket by a sample of 64 keys a part."""
    return keyspace.slice_counts(t("OBJ"), cut(keyspace.split_with(t("OBJ"), lambda o: keyspace.sampled_bounds(o, 4, 64))))


@query("SELECT VersionId, CASE WHEN Key <= 'u/5' THEN '' ELSE 'u/5' END AS start_after FROM $VER")
def o13_scan_versions(t: Tables) -> DataFrame:
    slices = t.spark.sql("SELECT 'vb' AS Bucket, '' AS start_after, 'u/5' AS end_at UNION ALL SELECT 'vb', 'u/5', ''")
    return keyspace.scan_versions(t("VER"), slices).select("VersionId", "start_after")


@query("SELECT VersionId, CASE WHEN kind = 'object-version' THEN (VersionId % 2 = 0)::INT END AS n FROM $VER")
def o14_enrich_version_tags(t: Tables) -> DataFrame:
    tags = t("VER").where("VersionId % 2 = 0").select("Bucket", "Key", "VersionId", F.create_map(F.lit("a"), F.lit("b")).alias("tags"))
    out = keyspace.enrich_version_tags(t("VER"), tags)
    return out.select("VersionId", F.when(F.col("tags").isNotNull(), F.size("tags")).alias("n"))


@query(f"SELECT Bucket, Key, {DAY[:-3]}10) AS start_after FROM $OBJ")
def j14_assign_slices_many(t: Tables) -> DataFrame:
    return keyspace.assign_slices(t("OBJ"), _done(t)[0], few=0).select("Bucket", "Key", "start_after")


@query(f"SELECT Bucket, Key, {DAY[:-3]}10) AS start_after FROM $OBJ")
def j14_assign_slices_few(t: Tables) -> DataFrame:
    return keyspace.assign_slices(t("OBJ"), _done(t)[0], few=10**6).select("Bucket", "Key", "start_after")


@query(f"SELECT Bucket, d AS start_after, d || '/~' AS end_at, coalesce(lag(d || '/~') OVER (PARTITION BY Bucket ORDER BY d), '') AS expected FROM (SELECT DISTINCT Bucket, substr(Key, 1, 10) AS d FROM $OBJ)")
def w4_check_partition(t: Tables) -> DataFrame:
    return keyspace.check_partition(_done(t)[0])


@query("SELECT Key, VersionId, kind, row_number() OVER (ORDER BY Key, kind DESC, VersionId) AS rank FROM $VER")
def w6_merge_by_key(t: Tables) -> DataFrame:
    v = t("VER")
    return keyspace.merge_by_key(v.where("kind = 'object-version'"), v.where("kind = 'delete-marker'")).select("Key", "VersionId", "kind", "rank")


@query("SELECT 'current' AS part, count(DISTINCT user_id) AS n FROM events UNION ALL SELECT 'noncurrent', count(*) - count(DISTINCT user_id) FROM events UNION ALL SELECT 'faults', 0")
def w7_versions(t: Tables) -> DataFrame:
    v = t("VER")
    count = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("part"), "n")
    return count(keyspace.current(v), "current").union(count(keyspace.noncurrent(v), "noncurrent")).union(count(keyspace.latest_faults(v), "faults"))


def _listing(t: Tables) -> DataFrame:
    """XML listing pages, one a bucket and day, with keys that are percent-encoded."""
    one = F.concat(F.lit("<Contents><Key>"), F.replace("Key", F.lit("/"), F.lit("%2F")), F.lit("+1</Key><Size>"), F.col("Size").cast("string"), F.lit("</Size></Contents>"))
    body = F.concat(F.lit('<ListBucketResult xmlns="http://example.com/doc/"><Name>b</Name><IsTruncated>false</IsTruncated>'), F.array_join(F.collect_list(one), ""), F.lit("<CommonPrefixes><Prefix>x%2F</Prefix></CommonPrefixes></ListBucketResult>"))
    return t("OBJ").groupBy("Bucket", F.substring("Key", 1, 11).alias("day")).agg(body.alias("body"))


@query("""SELECT 'object' AS kind, Bucket, Key || '+1' AS Key, Size FROM $OBJ UNION ALL SELECT 'prefix', Bucket, 'x/', NULL FROM (SELECT DISTINCT Bucket, substr(Key, 1, 11) FROM $OBJ)""")
def s5_n14_listing_pages(t: Tables) -> DataFrame:
    return keyspace.shape_listing(pages.parse_listing_pages(_listing(t), "body").select("Bucket", "page")).select("kind", "Bucket", "Key", "Size")


@query("SELECT kind, Key, CAST(VersionId AS STRING) AS \"VersionId\", IsLatest, Size FROM $VER")
def s6_n15_version_pages(t: Tables) -> DataFrame:
    tag = F.when(F.col("kind") == "delete-marker", "DeleteMarker").otherwise("Version")
    size = F.when(F.col("Size").isNotNull(), F.concat(F.lit("<Size>"), F.col("Size").cast("string"), F.lit("</Size>"))).otherwise("")
    one = F.concat(F.lit("<"), tag, F.lit("><Key>"), F.replace("Key", F.lit("/"), F.lit("%2F")), F.lit("</Key><VersionId>"), F.col("VersionId").cast("string"), F.lit("</VersionId><IsLatest>"), F.col("IsLatest").cast("string"), F.lit("</IsLatest>"), size, F.lit("</"), tag, F.lit(">"))
    body = F.concat(F.lit('<ListVersionsResult xmlns="http://example.com/doc/"><Name>vb</Name>'), F.array_join(F.collect_list(one), ""), F.lit("</ListVersionsResult>"))
    made = t("VER").groupBy("Bucket", "Key").agg(body.alias("body"))
    return keyspace.shape_versions(pages.parse_version_pages(made, "body").select("Bucket", "page")).select("kind", "Key", "VersionId", "IsLatest", "Size")


# snapshots, parameters, sealing


@query("""WITH r AS (SELECT DISTINCT o_custkey AS key, epoch(TIMESTAMP '2000-01-01')::BIGINT AS "at" FROM orders), s AS (SELECT o_custkey AS key, epoch(o_orderdate)::BIGINT AS created FROM orders)
    SELECT r.key, r."at", max(created) AS created, r."at" - max(created) AS age, CASE WHEN max(created) IS NULL THEN 'miss' WHEN r."at" - max(created) <= 8640000 THEN 'hit' ELSE 'stale' END AS decision
    FROM r LEFT JOIN s ON r.key = s.key AND created <= r."at" GROUP BY r.key, r."at" """)
def j15_c2_reuse_snapshot(t: Tables) -> DataFrame:
    secs = lambda c: F.unix_timestamp(c.cast("timestamp"))
    requests = t("orders").select(F.col("o_custkey").alias("key"), secs(F.lit("2000-01-01")).alias("at")).distinct()
    return snapshots.reuse_snapshot(requests, t("orders").select(F.col("o_custkey").alias("key"), secs(F.col("o_orderdate")).alias("created")), 8640000)


@query("""SELECT o_orderkey, substr(sha256(concat('{"o_custkey":', o_custkey, ',"o_orderstatus":"', o_orderstatus, '","p":', CASE WHEN o_orderkey % 2 = 0 THEN concat('"', o_orderpriority, '"') ELSE 'null' END, '}')), 1, 32) AS key FROM orders""")
def c1_snapshot_key(t: Tables) -> DataFrame:
    key = snapshots.snapshot_key(F.col("o_custkey"), F.col("o_orderstatus"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).alias("p"))
    return t("orders").select("o_orderkey", key.alias("key"))


@query("SELECT o_orderkey FROM orders WHERE epoch(o_orderdate) + 86400 > epoch(TIMESTAMP '1999-01-01')")
def c3_sweep(t: Tables) -> DataFrame:
    rows = t("orders").select("o_orderkey", (F.unix_timestamp(F.col("o_orderdate").cast("timestamp")) + 86400).alias("expires"))
    kept = snapshots.sweep(rows, 915148800.0)
    return kept.union(snapshots.sweep(rows, 915148800.0, everything=True)).select("o_orderkey")


def _age(x: str) -> str:
    """Seconds in words, in SQL."""
    return f"CASE WHEN {x} < 90 THEN printf('%.0fs', {x}) WHEN {x} < 5400 THEN printf('%.0fm', {x} / 60) WHEN {x} < 129600 THEN printf('%.1fh', {x} / 3600) ELSE printf('%.1fd', {x} / 86400) END"


@query(f"""SELECT event_id AS key, {_age("a")} AS age, {_age("l")} AS expires_in, 'cairn list --all' AS command, event_id AS lines, 0 AS bytes, false AS encrypted, 0.5::DOUBLE AS duration
    FROM (SELECT event_id, (event_id * 7.5)::DOUBLE AS a, greatest((event_id - 50) * 90.0, 0)::DOUBLE AS l FROM events)""")
def c4_list_snapshots(t: Tables) -> DataFrame:
    e = F.col("event_id")
    rows = t("events").select(e.alias("key"), (F.lit(1e6) - e * 7.5).alias("created"), (F.lit(1e6) + (e - 50) * 90.0).alias("expires"), F.array(F.lit("list"), F.lit("--all")).alias("argv"), e.alias("lines"), F.lit(0.5).alias("duration"))
    return snapshots.list_snapshots(rows, 1e6)


@query("SELECT CAST(user_id AS STRING) AS key, arg_max(event_type, event_id) AS value, max(event_id)::DOUBLE AS ts FROM events WHERE event_type <> 'error' AND event_id >= 200 GROUP BY user_id")
def c8_latest_values(t: Tables) -> DataFrame:
    log = t("events").select(F.col("user_id").cast("string").alias("key"), F.when(F.col("event_type") != "error", F.col("event_type")).otherwise("").alias("value"), F.col("event_id").cast("double").alias("ts"))
    return snapshots.latest_values(log, 10**12, 200.0 + 10**12)


PLAN = """SELECT Name, CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 3 = 0 THEN Value ELSE 'new' END AS "Value", Type,
    CASE WHEN p_partkey % 5 = 0 THEN 'error' WHEN p_partkey % 3 = 0 THEN 'unchanged' ELSE 'update' END AS action,
    CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 3 = 0 THEN Version ELSE Version + 1 END AS "Version" FROM $PAR"""


def _writes(t: Tables) -> DataFrame:
    par = t("PAR")
    incoming = par.select("Name", F.when(F.col("p_partkey") % 3 == 0, F.col("Value")).otherwise("new").alias("Value"), "Type")
    return snapshots.plan_writes(incoming, par.where("p_partkey % 5 <> 0"), "update")


@query(PLAN)
def e4_plan_writes(t: Tables) -> DataFrame:
    return _writes(t)


#: Four lines a name, the last without a value; one in four of the first lines says what is there, sealed.
REPLAY = """SELECT p.Name, seq, CASE WHEN p_partkey % 5 = 0 OR seq = 4 THEN NULL WHEN seq = 1 AND p_partkey % 4 = 0 THEN p.Value WHEN seq = 1 THEN 'first' ELSE 'second' END AS "Value",
    CASE WHEN p_partkey % 5 = 0 OR seq = 4 THEN 'error' WHEN seq = 1 AND p_partkey % 4 = 0 OR seq = 3 THEN 'unchanged' ELSE 'update' END AS action,
    CASE WHEN p_partkey % 5 = 0 OR seq = 4 THEN NULL ELSE p.Version + CASE WHEN p_partkey % 4 = 0 THEN 0 ELSE 1 END + CASE WHEN seq > 1 THEN 1 ELSE 0 END END AS "Version" FROM $PAR p, range(1, 5) g(seq)"""


def _replay(t: Tables) -> tuple[DataFrame, DataFrame]:
    par, key = t("PAR"), "0123456789abcdef"
    first = seal.seal(par.where("p_partkey % 4 = 0"), "Value", key).unionByName(par.where("p_partkey % 4 <> 0").withColumn("Value", F.lit("first"))).select("Name", "Value", F.lit(1).alias("seq"))
    more = par.select("Name", F.explode(F.array(*(F.struct(F.lit(v).cast("string").alias("Value"), F.lit(n).alias("seq")) for n, v in ((2, "second"), (3, "second"), (4, None))))).alias("l")).select("Name", "l.*")
    current = par.where("p_partkey % 5 <> 0")
    return current, snapshots.plan_writes(first.union(more), current, "update", order="seq", key=key)


@query(REPLAY)
def e4_replay_writes(t: Tables) -> DataFrame:
    return _replay(t)[1].select("Name", "seq", "Value", "action", "Version")


@query("""SELECT Name, 'second' AS "Value", Type, Version + CASE WHEN p_partkey % 4 = 0 THEN 1 ELSE 2 END AS "Version" FROM $PAR WHERE p_partkey % 5 <> 0""")
def e4_apply_writes(t: Tables) -> DataFrame:
    return snapshots.apply_writes(*_replay(t))


@query(f"SELECT action, count(*) AS n FROM ({PLAN}) GROUP BY 1")
def a17_outcome_counts(t: Tables) -> DataFrame:
    return snapshots.outcome_counts(_writes(t))


@query("SELECT Name, Value, Type = 'SecureString' AS was_sealed FROM $PAR")
def e1_e2_seal_round_trip(t: Tables) -> DataFrame:
    key = "0123456789abcdef"
    once = seal.seal(t("PAR"), "Value", key, F.col("Type") == "SecureString")
    marked = seal.seal(once, "Value", key, F.col("Type") == "SecureString").withColumn("was_sealed", F.col("Value").startswith(seal.PREFIX))
    return seal.unseal(marked, "Value", key)[0].select("Name", "Value", "was_sealed")


@query("SELECT conv_id, turn, role, text FROM conversations")
def e3_unseal_all(t: Tables) -> DataFrame:
    key = b"0123456789abcdef01234567"
    nested = seal.seal(t("conversations"), "text", key).select("conv_id", "turn", F.array(F.struct("role", F.create_map(F.lit("t"), F.col("text")).alias("m"))).alias("n"))
    return seal.unseal_all(nested, key).select("conv_id", "turn", F.get("n", F.lit(0))["role"].alias("role"), F.get("n", F.lit(0))["m"]["t"].alias("text"))


@query(f"""SELECT event_id, (event_id + 0.5 * (event_id % 2)) * CASE event_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 60 WHEN 2 THEN 3600 ELSE 86400 END::DOUBLE AS secs, event_id % 3 = 0 AS yes, {_age("a")} AS age
    FROM (SELECT event_id, (event_id * 11.25)::DOUBLE AS a FROM events)""")
def f9_durations(t: Tables) -> DataFrame:
    unit = F.get(F.array(*map(F.lit, ("", "m", "H", "d"))), (F.col("event_id") % 4).cast("int"))
    word = F.when(F.col("event_id") % 3 == 0, "Yes").otherwise("no")
    number = F.concat(F.col("event_id").cast("string"), F.when(F.col("event_id") % 2 == 1, ".5").otherwise(""))
    return t("events").select("event_id", expr.seconds(F.concat(number, unit)).alias("secs"), expr.is_true(word).alias("yes"), expr.age_text(F.col("event_id") * 11.25).alias("age"))


@query("SELECT Bucket, Key, true AS below FROM $OBJ")
def f1_f14_uri_parts(t: Tables) -> DataFrame:
    uri = F.concat(F.lit("s3://"), "Bucket", F.lit("/"), "Key")
    return t("OBJ").select(expr.bucket_of(uri).alias("Bucket"), expr.key_of(uri).alias("Key"), (F.col("Key") < expr.branch_end(F.substring("Key", 1, 11))).alias("below"))


@query("SELECT event_id, json_extract_string(props, '$$.k') AS k, 1 AS n FROM events")
def f12_remap_keys(t: Tables) -> DataFrame:
    m = F.map_concat(F.from_json("props", "map<string,string>"), F.create_map(F.lit("gone"), F.lit("x")))
    out = expr.remap_keys(m, ["K", "Other"])
    return t("events").select("event_id", out["K"].alias("k"), F.size(out).alias("n"))


@query("SELECT event_id, props AS key FROM events")
def f8_decode_key(t: Tables) -> DataFrame:
    return t("events").select("event_id", expr.decode_key(F.replace(F.url_encode("props"), F.lit("+"), F.lit("%20"))).alias("key"))
