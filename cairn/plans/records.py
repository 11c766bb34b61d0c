"""Queries of the filters, shaping and enrichment operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.functions import expr
from cairn.operators import enrich, filters, keyspace, ragged, shape
from cairn.operators.shape import Shape
from cairn.plans.tables import Tables, query
from cairn.sources import lines


@query("SELECT o_orderkey, o_totalprice * 2 AS doubled FROM orders WHERE o_orderstatus = 'F'")
def p1_post(t: Tables) -> DataFrame:
    return filters.post(t("orders"), where="o_orderstatus = 'F'", select=["o_orderkey", "o_totalprice * 2 AS doubled"])


@query('SELECT c_custkey AS "C_CustKey", c_name AS "C_Name" FROM customer')
def p2_fit_to_schema(t: Tables) -> DataFrame:
    return filters.fit_to_schema(t("customer"), ["C_CustKey", "C_Name", "Missing"])


@query("""SELECT event_id, CAST(json_extract(props, '$$.k') AS BIGINT) AS k, event_id % 2 = 1 AS odd, CASE WHEN event_id % 3 > 0 THEN event_id END AS n,
    CASE event_id % 4 WHEN 0 THEN 2 ELSE 1 END AS items, CASE event_id % 4 WHEN 0 THEN 'BIGINT' WHEN 1 THEN 'STRING' WHEN 2 THEN 'STRING' ELSE 'BIGINT' END AS kind,
    CASE event_id % 4 WHEN 0 THEN CAST(event_id AS STRING) WHEN 1 THEN '[bad' WHEN 2 THEN 'plain' ELSE CAST(event_id AS STRING) END AS first,
    CASE event_id % 4 WHEN 0 THEN 'ARRAY<BIGINT>' ELSE 'STRING' END AS untyped FROM events""")
def p3_coerce(t: Tables) -> DataFrame:
    """Lists keep the types of their items, and what isn't one is its only item; untyped text is read if it looks like JSON."""
    e = F.col("event_id").cast("string")
    text = t("events").select("event_id", "props", (F.col("event_id") % 2).cast("string").alias("odd"), F.when(F.col("event_id") % 3 == 0, "x").otherwise(e).alias("n"),
                              F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("["), e, F.lit(", 2]"))).when(F.col("event_id") % 4 == 1, "[bad").when(F.col("event_id") % 4 == 2, "plain").otherwise(e).alias("list")).withColumn("any", F.col("list"))
    out = filters.coerce(text, {"props": "map", "odd": "boolean", "n": "long", "list": "list", "any": ""})
    first = F.get("list", F.lit(0))
    return out.select("event_id", F.variant_get("props", "$.k", "long").alias("k"), "odd", "n", F.size("list").alias("items"), F.schema_of_variant(first).alias("kind"), F.variant_get(first, "$", "string").alias("first"), F.schema_of_variant("any").alias("untyped"))


@query("SELECT Name FROM $PAR WHERE starts_with(Name, '/Brand3/')")
def p8_under_path(t: Tables) -> DataFrame:
    return filters.under_path(t("PAR"), "Name", "/Brand3").select("Name")


@query("SELECT Name FROM $PAR WHERE starts_with(Name, '/Brand3/standard/')")
def p8_children(t: Tables) -> DataFrame:
    return filters.under_path(t("PAR"), "Name", "/Brand3/standard", recursive=False).select("Name")


@query("SELECT s_suppkey, s_nationkey FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 2)")
def p9_own_only(t: Tables) -> DataFrame:
    own = t("nation").where("n_regionkey = 2").select(F.col("n_nationkey").alias("s_nationkey"))
    return filters.own_only(t("supplier"), "s_nationkey", own).select("s_suppkey", "s_nationkey")


@query("SELECT event_id FROM $LOG WHERE Ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-12'")
def p10_in_window(t: Tables) -> DataFrame:
    ts = lambda x: F.lit(x).cast("timestamp_ntz" if dict(t("events").dtypes)["ts"] == "timestamp_ntz" else "timestamp")
    return filters.in_window(t("LOG"), "Ts", ts("2024-01-05"), ts("2024-01-12")).select("event_id")


@query("SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) <= 3")
def p11_cap_per(t: Tables) -> DataFrame:
    return filters.cap_per(t("events"), ["user_id"], [F.col("event_id")], 3).select("user_id", "event_id")


@query("SELECT Bucket, Key FROM $OBJ ORDER BY Bucket, Key LIMIT 1500")
def p12_cap(t: Tables) -> DataFrame:
    return filters.cap(t("OBJ"), 1500, [F.col("Bucket"), F.col("Key")]).select("Bucket", "Key")


@query("SELECT Bucket, Key FROM $OBJ WHERE starts_with(Key, '2024/01/') AND Key > '2024/01/05' AND Key <= '2024/01/20/8'")
def p13_in_slice(t: Tables) -> DataFrame:
    return filters.in_slice(t("OBJ"), "Key", "2024/01/", "2024/01/05", "2024/01/20/8").select("Bucket", "Key")


@query('SELECT l_orderkey AS "root_group", l_linenumber AS line, Cidr FROM $ITEM')
def n1_explode_path(t: Tables) -> DataFrame:
    perms = shape.explode_path(t.groups(), ("Perms",))
    ranges = shape.explode_path(perms.withColumnRenamed("root_group", "group"), ("Ranges",))
    return ranges.select("root_group", F.col("root_line").alias("line"), "Cidr")


def _ragged(t: Tables) -> DataFrame:
    """A page an order, in one of five shapes."""
    k, c = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    page = lambda text: F.replace(F.replace(F.lit(text), F.lit("@k"), k), F.lit("@c"), c)
    way = F.col("o_orderkey") % 5
    text = (
        F.when(way == 0, page('{"Owner":"u@c","Groups":[{"Items":[{"Id":"@k-1","Tags":[{"Key":"a","Value":"1"},{"Key":"a","Value":"2"}]},{"Id":"@k-2","Tags":{"b":"x"}}]}]}'))
        .when(way == 1, page('{"Owner":"u@c","Groups":{"Items":{"Id":@k,"Tags":[{"Key":null,"TagKey":"t","Value":"no"},{"TagKey":"t","TagValue":"yes"},"junk"]}}}'))
        .when(way == 2, page('{"Owner":"u@c","Groups":[{"Items":null},{"Other":1},7]}'))
        .when(way == 3, page('{"Owner":null,"Groups":[{"Items":["s@k",null]}]}')).otherwise(page('{"Owner":"u@c","Groups":[{"Items":[{"Id":null,"Tags":"none","Size":@c}]},{"Items":[]}]}'))
    )
    return t("orders").select("o_orderkey", F.parse_json(text).alias("page"))


@query("""SELECT o_orderkey, n AS node FROM (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN [o_orderkey || '-1', o_orderkey || '-2'] WHEN 1 THEN [o_orderkey || ''] WHEN 3 THEN [] ELSE [NULL] END AS ids FROM orders WHERE o_orderkey % 5 <> 2), unnest(ids) u(n) WHERE n IS NOT NULL""")
def n1_walk_ragged(t: Tables) -> DataFrame:
    found = ragged.walk(ragged.walk(_ragged(t), "page", ("Groups", "Items")), "item", ("Id",), "id")
    return found.select("o_orderkey", ragged.scalar(F.col("id")).alias("node"))


@query("""WITH o AS (SELECT o_orderkey, o_orderkey % 5 AS w, o_orderkey || '' AS k, 'u' || o_custkey AS u, o_custkey AS c FROM orders)
    SELECT o_orderkey, k || '-1' AS id, 'arn:c:s:r:' || u || ':item/' || k || '-1' AS arn, 'a=2' AS tags, '{"Id":"' || k || '-1"}' AS raw FROM o WHERE w = 0
    UNION ALL SELECT o_orderkey, k || '-2', 'arn:c:s:r:' || u || ':item/' || k || '-2', 'b=x', '{"Id":"' || k || '-2"}' FROM o WHERE w = 0
    UNION ALL SELECT o_orderkey, k, 'arn:c:s:r:' || u || ':item/' || k, 't=yes', '{"Id":' || k || '}' FROM o WHERE w = 1
    UNION ALL SELECT o_orderkey, '', '', '', '{"Value":"s' || k || '"}' FROM o WHERE w = 3 UNION ALL SELECT o_orderkey, '', '', '', '{"Value":null}' FROM o WHERE w = 3
    UNION ALL SELECT o_orderkey, '', '', '', '{"Id":null,"Size":' || c || ',"Tags":"none"}' FROM o WHERE w = 4""")
def n3_ragged_records(t: Tables) -> DataFrame:
    """Envelopes over pages of many shapes: present nulls, single objects for lists, tags as lists and objects."""
    made = ragged.normalize(_ragged(t), "page", [Shape("item", ("Groups", "Items"), id="Id", arn="arn:c:s:r:{root_Owner}:item/{Id}")])
    tags = F.array_join(F.transform(F.map_entries("meta.tags"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return made.select("o_orderkey", "meta.id", "meta.arn", tags.alias("tags"), F.to_json("item").alias("raw"))


@query('SELECT o_custkey AS "root_customer", o_orderkey AS "Value" FROM orders')
def n2_scalar_items(t: Tables) -> DataFrame:
    page = t("orders").groupBy(F.col("o_custkey").alias("customer")).agg(F.collect_list("o_orderkey").alias("ids"))
    return shape.explode_path(page, ("ids",))


@query("""SELECT 'paid' AS type, CAST(o_orderkey AS STRING) AS id FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 'due', CAST(o_orderkey AS STRING) FROM orders WHERE o_orderstatus <> 'F'""")
def n3_normalize(t: Tables) -> DataFrame:
    one = F.struct(F.col("o_orderkey").alias("Id"))
    page = t("orders").groupBy(F.col("o_custkey").alias("customer")).agg(F.collect_list(F.when(F.col("o_orderstatus") == "F", one)).alias("Paid"), F.collect_list(F.when(F.col("o_orderstatus") != "F", one)).alias("Due"))
    return shape.normalize(page, [Shape("paid", ("Paid",), id="Id"), Shape("due", ("Due",), id="Id")]).select("meta.type", "meta.id")


def _tagged(t: Tables) -> DataFrame:
    """Resources with tag lists in which a key is repeated (the last counts) and one is null."""
    tag = lambda k, v: F.struct(F.lit(k).cast("string").alias("Key"), v.cast("string").alias("Value"))
    tags = F.array(tag("Segment", F.lit("old")), tag("Segment", F.col("Segment")), tag(None, F.lit("x")), tag("Name", F.concat(F.lit("n"), F.col("Id") % 10)))
    return t("RES").withColumn("Tags", F.when(F.col("Id") % 4 == 0, F.array().cast("array<struct<Key:string,Value:string>>")).otherwise(tags))


@query("SELECT Id, CASE WHEN Id % 4 > 0 THEN Segment END AS segment, CASE WHEN Id % 4 > 0 THEN 2 ELSE 0 END AS n FROM $RES")
def n4_tags_to_map(t: Tables) -> DataFrame:
    df = _tagged(t)
    tags = expr.tags_to_map(F.col("Tags"), df.schema["Tags"].dataType)
    return df.select("Id", F.try_element_at(tags, F.lit("Segment")).alias("segment"), F.size(tags).alias("n"))


RESOURCE = Shape("customer", id="", name="Missing", arn="arn:aws:crm:{region}:{account}:customer/{Id}", uri="crm://{region}/{Nothing}")


@query("""SELECT 'customer' AS type, CAST(Id AS STRING) AS id, CASE WHEN Id % 4 > 0 THEN concat('n', CAST(Id % 10 AS STRING)) ELSE '' END AS name,
    concat('arn:aws:crm:', region, ':', CAST(account AS STRING), ':customer/', CAST(Id AS STRING)) AS arn, CASE WHEN Id % 4 > 0 THEN 2 ELSE 0 END AS n_tags, CAST(NULL AS STRING) AS uri FROM $RES""")
def n5_with_envelope(t: Tables) -> DataFrame:
    m = shape.with_envelope(_tagged(t), RESOURCE)
    return m.select("meta.type", "meta.id", "meta.name", "meta.arn", F.size("meta.tags").alias("n_tags"), "meta.uri")


@query("SELECT Id, concat(region, '/', CAST(account AS STRING)) AS full_, '' AS missing FROM $RES")
def n6_render_template(t: Tables) -> DataFrame:
    own = {c: F.col(c) for c in ("region", "account")}
    return t("RES").select("Id", expr.render_or_empty("{region}/{account}", own).alias("full_"), expr.render_or_empty("{region}/{zone}", own).alias("missing"))


@query("SELECT concat('s3://', Bucket, '/', Key) AS uri, 'object' AS type FROM $OBJ")
def n7_n25_lean_objects(t: Tables) -> DataFrame:
    from cairn.operators.keyspace import lean_objects

    return lean_objects(t("OBJ")).select("meta.uri", "meta.type")


@query("SELECT c_custkey, regexp_extract(c_name, '[0-9]+$$') AS id, '' AS none FROM customer")
def n8_id_from_arn(t: Tables) -> DataFrame:
    arn = F.concat(F.lit("arn:aws:crm:eu:1:customer:group/"), F.regexp_extract("c_name", "[0-9]+$", 0))
    return t("customer").select("c_custkey", expr.id_from_arn(arn).alias("id"), expr.id_from_arn(F.col("c_name")).alias("none"))


_PAGE = """CASE event_id % 4 WHEN 0 THEN '{"Things":[' || event_id || ',{"k":2}],"Next":"[9]"}' WHEN 1 THEN '{"A":[' || event_id || '],"B":[2]}' WHEN 2 THEN '{"Only":' || props || '}' ELSE '{"None":[],"Size":' || user_id || '}' END"""


def _listed(t: Tables) -> DataFrame:
    """Pages with one list, two, none, and an empty one."""
    return t("events").select("event_id", F.parse_json(F.expr(_PAGE)).alias("page"))


@query(f"""SELECT event_id, item FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN [event_id || '', '{{"k":2}}'] WHEN 1 THEN ['{{"A":[' || event_id || '],"B":[2]}}'] WHEN 2 THEN ['{{"Only":' || replace(props, ' ', '') || '}}'] ELSE [] END AS items FROM events), unnest(items) u(item)""")
def n12_unwrap_variant(t: Tables) -> DataFrame:
    return shape.unwrap_variant(_listed(t), "page", "event_id").select("event_id", F.to_json("item").alias("item"))


@query("SELECT o_custkey AS customer, l_orderkey AS \"order\", l_linenumber AS line FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def n13_explode_with_parent(t: Tables) -> DataFrame:
    page = t("lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_linenumber").alias("line"))).alias("Lines")).join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    out = shape.explode_with_parent(page, ["o_custkey", "o_orderkey"], "Lines", "Order")
    return out.select(F.col("Order.o_custkey").alias("customer"), F.col("Order.o_orderkey").alias("order"), "line")


@query("SELECT c_custkey, regexp_replace(c_name, '^Customer#', '') AS id FROM customer")
def n16_strip_prefix(t: Tables) -> DataFrame:
    return t("customer").select("c_custkey", expr.strip_prefix(F.col("c_name"), "Customer#").alias("id"))


@query("SELECT page_id, split_part(url, '/', -1) AS name, split_part(url, '/', -2) AS owner FROM pages")
def n17_from_url(t: Tables) -> DataFrame:
    return shape.from_url(t("pages"), "url").select("page_id", "name", "owner")


@query("SELECT event_id, 'k' AS key, json_extract_string(props, '$$.k') AS value FROM events")
def n18_explode_map(t: Tables) -> DataFrame:
    return shape.explode_map(t("events").select("event_id", "props"), "props")


@query("SELECT l_orderkey AS \"group\", count(*)::BIGINT AS n FROM lineitem GROUP BY l_orderkey")
def n19_strip_metadata(t: Tables) -> DataFrame:
    page = t.groups().withColumn("ResponseMetadata", F.struct(F.lit("1").alias("RequestId")))
    return shape.strip_metadata(page).select("group", F.size("Perms").cast("long").alias("n"))


@query("SELECT CAST(Id AS STRING) AS id, 'ops' AS profile, region, CAST(account AS STRING) AS account FROM $RES")
def n20_stamp_session(t: Tables) -> DataFrame:
    m = shape.with_envelope(_tagged(t), RESOURCE)
    out = shape.stamp_session(m, F.lit("ops"), F.col("region"), F.col("account"))
    return out.select("meta.id", "meta.stamp.profile", "meta.stamp.region", "meta.stamp.account")


@query("SELECT CAST(Id AS STRING) AS id, region AS first, 'b' AS second FROM $RES")
def n21_stamp_params(t: Tables) -> DataFrame:
    m = shape.with_envelope(_tagged(t), RESOURCE)
    out = shape.stamp_params(shape.stamp_params(m, {"Region": F.col("region")}), {"Region": F.lit("other"), "More": F.lit("b"), "None": F.lit(None)})
    return out.select("meta.id", F.col("meta.stamp.params")["Region"].alias("first"), F.col("meta.stamp.params")["More"].alias("second"))


@query("SELECT Id, CASE WHEN Id % 2 = 0 THEN 'flat' ELSE 'ops' END AS profile, region FROM $RES")
def n22_route_session(t: Tables) -> DataFrame:
    m = shape.stamp_session(shape.with_envelope(_tagged(t), RESOURCE).withColumnRenamed("region", "own_region"), F.lit("ops"), F.col("own_region"), F.col("account"))
    return shape.route_session(m.withColumn("profile", F.when(F.col("Id") % 2 == 0, "flat"))).select("Id", "profile", "region")


@query("SELECT Id, CASE WHEN Id % 2 = 0 THEN 'flat' END AS profile, NULL AS region FROM $RES")
def n22_route_flat(t: Tables) -> DataFrame:
    """Records without an envelope."""
    flat = t("RES").select("Id", F.when(F.col("Id") % 2 == 0, "flat").otherwise("").alias("profile"))
    return shape.route_session(flat).select("Id", "profile", "region")


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN 2 WHEN 1 THEN 2 WHEN 3 THEN 0 END AS n FROM events")
def n24_page_items(t: Tables) -> DataFrame:
    return _listed(t).select("event_id", shape.page_items(F.col("page")).alias("n"))


@query("SELECT Name AS id, Type AS kind, Version AS version FROM $PAR")
def n26_shape_parameters(t: Tables) -> DataFrame:
    return shape.shape_parameters(t("PAR")).select("meta.id", F.col("Type").alias("kind"), F.col("Version").alias("version"))


@query("""SELECT event_id, event_id % 6 < 4 AS good, CASE event_id % 6 WHEN 0 THEN Bucket WHEN 1 THEN Bucket WHEN 2 THEN 'other' WHEN 3 THEN 'low' END AS bucket,
    CASE event_id % 6 WHEN 0 THEN '' WHEN 1 THEN substr(Key, 1, 8) WHEN 2 THEN 'y/' WHEN 3 THEN 'z' END AS prefix,
    CASE event_id % 6 WHEN 0 THEN '/' WHEN 1 THEN '' WHEN 2 THEN '//' WHEN 3 THEN '' END AS delimiters, CASE WHEN event_id % 6 < 4 THEN coalesce(CASE WHEN event_id % 6 = 2 THEN 'own' END, 'stamped') END AS profile FROM $OBJ""")
def n27_to_seeds(t: Tables) -> DataFrame:
    """A Bucket with a Uri that doesn't count; an end that clears the delimiters; a Uri alone, with a Prefix that doesn't count; an
    envelope's uri; and two without a bucket."""
    way, text, arr = F.col("event_id") % 6, F.lit(None).cast("string"), F.lit(None).cast("array<string>")
    pick = lambda *cs: F.element_at(F.array(*cs, text, text, text, text, text, text), (way + 1).cast("int"))
    lines = t("OBJ").select(
        F.col("event_id").cast("string").alias("VersionAfter"), pick("Bucket", "Bucket", F.lit(""), text).alias("Bucket"), pick(F.lit(""), F.substring("Key", 1, 8), F.lit("p/"), text).alias("Prefix"),
        pick(F.lit("s3://b/x/"), text, F.lit("s3://other/y/"), text, F.lit("s3://"), F.lit("http://b/x")).alias("Uri"),
        pick(F.lit("/"), F.lit("/")).alias("Delimiter"), F.when(way == 2, F.array(F.lit("/"), F.lit("/"))).otherwise(arr).alias("Delimiters"), pick(text, F.lit("~")).alias("EndAt"), pick(text, text, F.lit("own")).alias("profile"),
        F.struct(F.when(way == 3, "s3://low/z").alias("uri"), F.struct(F.lit("stamped").alias("profile")).alias("stamp")).alias("meta"),
    )
    good, bad = keyspace.to_seeds(lines)
    event = F.col("VersionAfter").cast("long").alias("event_id")
    good = good.select(event, F.lit(True).alias("good"), F.col("Bucket").alias("bucket"), F.col("Prefix").alias("prefix"), F.array_join("Delimiters", "").alias("delimiters"), "profile")
    return good.union(bad.select(event, F.lit(False), text, text, text, text))


@query("SELECT event_id, coalesce(json_extract_string(props, '$$.k'), '') <> '' AS good FROM events WHERE event_id % 5 > 0")
def s7_split_params(t: Tables) -> DataFrame:
    text = t("events").select("event_id", F.when(F.col("event_id") % 5 == 0, "[1, 2").otherwise(F.col("props")).alias("value"))
    good, _ = lines.split_lines(text)
    return good.select("event_id", F.variant_get("params", "$.k", "string").isNotNull().alias("good"))


@query("SELECT event_id, '[1, 2' AS value FROM events WHERE event_id % 5 = 0")
def s7_quarantine(t: Tables) -> DataFrame:
    text = t("events").select("event_id", F.when(F.col("event_id") % 5 == 0, "[1, 2").otherwise(F.col("props")).alias("value"))
    return lines.split_lines(text)[1]


@query("SELECT p_name AS name FROM part WHERE trim(p_name) <> ''")
def s8_names(t: Tables) -> DataFrame:
    return lines.names_of(t("part").select(F.concat(F.lit("  "), "p_name", F.lit("\t")).alias("value")))


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_type ELSE 'base' END AS service, 'List' AS operation FROM events")
def s11_with_defaults(t: Tables) -> DataFrame:
    params = t("events").select("event_id", F.when(F.col("event_id") % 2 == 0, F.col("event_type")).otherwise("").alias("service"))
    return lines.with_defaults(params, {"service": "base", "operation": "List"})[0].select("event_id", "service", "operation")


@query("SELECT doc_id, (l.doc_id IS NOT NULL) AS labelled, l.quality AS quality FROM documents d LEFT JOIN labels l USING (doc_id)")
def j7_bucket_posture(t: Tables) -> DataFrame:
    out = enrich.bucket_posture(t("documents").select("doc_id"), "doc_id", {"label": t("labels")})
    return out.select("doc_id", F.col("label").isNotNull().alias("labelled"), F.col("label.quality").alias("quality"))


@query("""SELECT Id, CASE WHEN Id % 3 = 0 THEN 'own' WHEN account % 2 = 0 THEN 'found' ELSE 'none' END AS source,
    CASE WHEN Id % 3 = 0 THEN 'x' WHEN account % 2 = 0 THEN concat('seg-', Segment) ELSE '' END AS name FROM $RES""")
def j8_enrich_tags(t: Tables) -> DataFrame:
    res = t("RES").select("Id", F.lit("ops").alias("profile"), "region", F.concat(F.lit("arn:"), F.col("Id").cast("string")).alias("arn"), F.when(F.col("Id") % 3 == 0, "x").otherwise("").alias("name"), "Segment", "account",
                          F.when(F.col("Id") % 3 == 0, F.create_map(F.lit("Own"), F.lit("1"))).otherwise(F.create_map().cast("map<string,string>")).alias("tags"))
    table = res.where("account % 2 = 0").select("profile", "region", "arn", F.create_map(F.lit("Name"), F.concat(F.lit("seg-"), "Segment")).alias("tags"))
    out = enrich.enrich_tags(res, table)
    return out.select("Id", F.when(F.map_contains_key("tags", "Own"), "own").when(F.size("tags") > 0, "found").otherwise("none").alias("source"), "name")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def j9_describe(t: Tables) -> DataFrame:
    listed = t("orders").where("o_totalprice > 300000").select(F.concat(F.lit("arn:aws:crm:eu:1:customer/"), F.col("o_custkey").cast("string")).alias("c_custkey"))
    return enrich.describe(listed, t("customer"), "c_custkey").select("c_custkey", "c_name")


@query("""SELECT n_nationkey, c_custkey, CAST(floor((row_number() OVER (PARTITION BY n_nationkey ORDER BY CAST(c_custkey AS STRING)) - 1) / 10) AS BIGINT) AS batch
    FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def j10_describe_batches(t: Tables) -> DataFrame:
    d = t("customer").withColumnRenamed("c_nationkey", "n_nationkey")
    return enrich.describe(d, d, "c_custkey", ("n_nationkey",), batch_size=10).select("n_nationkey", "c_custkey", "batch")


@query("SELECT r_name, n_name, c_custkey, o_orderkey FROM region JOIN nation ON r_regionkey = n_regionkey JOIN customer ON n_nationkey = c_nationkey JOIN orders ON c_custkey = o_custkey")
def j11_chain(t: Tables) -> DataFrame:
    hops = [(t("region").withColumnRenamed("r_regionkey", "r"), []), (t("nation").withColumnsRenamed({"n_regionkey": "r", "n_nationkey": "n"}), ["r"]), (t("customer").withColumnsRenamed({"c_nationkey": "n", "c_custkey": "c"}), ["n"]), (t("orders").withColumnRenamed("o_custkey", "c"), ["c"])]
    return enrich.chain(hops).select("r_name", "n_name", F.col("c").alias("c_custkey"), "o_orderkey")


@query("SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey AND substr(r_name, 1, 1) = 'A'")
def j12_composite_detail(t: Tables) -> DataFrame:
    listed = t("nation").select("n_name", F.col("n_regionkey").alias("r_regionkey"), F.lit("A").alias("scope"))
    return enrich.chain([(listed, []), (t("region").withColumn("scope", F.substring("r_name", 1, 1)), ["r_regionkey", "scope"])]).select("n_name", "r_name")


@query("SELECT Name, Version FROM $PAR WHERE p_partkey % 7 = 0")
def j13_lookup_found(t: Tables) -> DataFrame:
    return enrich.lookup(_wanted(t), t("PAR"), "Name")[0].select("Name", "Version")


@query("SELECT concat('/missing/', CAST(p_partkey AS STRING)) AS Name FROM part WHERE p_partkey % 11 = 3")
def j13_lookup_invalid(t: Tables) -> DataFrame:
    return enrich.lookup(_wanted(t), t("PAR"), "Name")[1]


def _wanted(t: Tables) -> DataFrame:
    return t("PAR").where("p_partkey % 7 = 0").select("Name").union(t("PAR").where("p_partkey % 11 = 3").select(F.concat(F.lit("/missing/"), F.col("p_partkey").cast("string"))))


@query("""WITH i AS (SELECT service, operation, member FROM $MODEL WHERE direction = 'input'), o AS (SELECT service, operation, CASE WHEN member IN ('Id', 'Name') THEN concat('Next', member) ELSE member END AS m FROM $MODEL WHERE direction = 'output')
    SELECT o.service, o.operation, o.m AS output_marker, i.member AS input_marker FROM o JOIN i ON o.service = i.service AND o.operation = i.operation AND (o.m = i.member OR o.m = concat('Next', i.member))
    QUALIFY row_number() OVER (PARTITION BY o.service, o.operation, o.m ORDER BY CASE WHEN o.m = i.member THEN 0 ELSE 1 END) = 1""")
def j16_marker_pairs(t: Tables) -> DataFrame:
    m = t("MODEL")
    named = F.when((F.col("direction") == "output") & F.col("member").isin("Id", "Name"), F.concat(F.lit("Next"), "member")).otherwise(F.col("member"))
    return enrich.marker_pairs(m.withColumn("member", named).distinct())


@query("""WITH a AS (SELECT * FROM $SESS WHERE account <> '' QUALIFY row_number() OVER (PARTITION BY account ORDER BY pos) = 1)
    SELECT profile, account, r_name AS region FROM a, region WHERE r_regionkey < 3 OR (r_regionkey = CAST(account AS INT) % 5)""")
def j17_plan_sessions(t: Tables) -> DataFrame:
    regions = t("region").select(F.col("r_name").alias("region"), (F.col("r_regionkey") >= 3).alias("opt_in"))
    enabled = t("nation").select(F.col("n_nationkey").cast("string").alias("account"), (F.col("n_nationkey") % 5).alias("r_regionkey")).join(t("region"), "r_regionkey").select("account", F.col("r_name").alias("region"))
    return enrich.plan_sessions(t("SESS"), regions, enabled).select("profile", "account", "region")


@query("""WITH c AS (SELECT DISTINCT service, operation, member AS name FROM $MODEL), o AS (SELECT service, operation, member AS name FROM $MODEL WHERE direction = 'output'),
    p AS (SELECT DISTINCT service, operation FROM $MODEL), i AS (SELECT service, operation, member AS name FROM $MODEL WHERE direction = 'input')
    SELECT 'root' AS problem, service, operation, name FROM c ANTI JOIN o USING (service, operation, name)
    UNION ALL SELECT 'param', service, operation, 'Id' FROM (SELECT *, 'Id' AS name FROM p) ANTI JOIN i USING (service, operation, name)
    UNION ALL SELECT 'target', service, operation, 'Gone' FROM p WHERE operation = 'Op1'""")
def j18_lint_configs(t: Tables) -> DataFrame:
    m = t("MODEL")
    ops = m.select("service", "operation").distinct()
    pairings = ops.select("service", "operation", F.col("operation").alias("target"), F.lit("Id").alias("param")).union(ops.where("operation = 'Op1'").select("service", "operation", F.lit("Gone"), F.lit("Id")))
    return enrich.lint_configs(m.select("service", "operation", F.col("member").alias("root")), pairings, m)


_SAID = "CASE event_id % 4 WHEN 0 THEN member WHEN 1 THEN upper(member) WHEN 2 THEN lower(member) ELSE concat(member, '?') END"


@query(f"""WITH n AS (SELECT DISTINCT member FROM $MODEL), s AS (SELECT event_id, {_SAID} AS name FROM (SELECT event_id, ['Type','type','Id','ID','Name','name','Arn','ARN','Tags','Other'][event_id % 10 + 1] AS member FROM events))
    SELECT event_id, name, coalesce((SELECT any_value(member) FROM n WHERE member = name), (SELECT min(member) FROM n WHERE lower(member) = lower(name))) AS matched FROM s""")
def j19_match_ci(t: Tables) -> DataFrame:
    """Names as they are in the model, in capitals, in small letters, and unknown ones."""
    member = F.get(F.array(*map(F.lit, ("Type", "type", "Id", "ID", "Name", "name", "Arn", "ARN", "Tags", "Other"))), (F.col("event_id") % 10).cast("int"))
    rows = t("events").withColumn("member", member).select("event_id", F.expr(_SAID).alias("name"))
    return enrich.match_ci(rows, t("MODEL").select("member").distinct(), "name", "member")


@query("SELECT doc_id, coalesce(quality = 1, false) AS versions FROM documents LEFT JOIN labels USING (doc_id)")
def j20_choose_listing(t: Tables) -> DataFrame:
    status = t("labels").select("doc_id", F.when(F.col("quality") == 1, "Enabled").otherwise("Off").alias("status"))
    return enrich.choose_listing(t("documents").select("doc_id"), status, "doc_id")


@query("SELECT account, profile FROM $SESS WHERE account <> '' QUALIFY row_number() OVER (PARTITION BY account ORDER BY pos) = 1")
def w2_dedupe_accounts(t: Tables) -> DataFrame:
    return enrich.dedupe_accounts(t("SESS"))[0].select("account", "profile")


@query("""SELECT c_nationkey, floor((k - 1) / 10)::BIGINT AS batch, count(*) AS n, min(c_custkey) AS low, max(c_custkey) AS high
    FROM (SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS k FROM customer) GROUP BY 1, 2""")
def w5_batches(t: Tables) -> DataFrame:
    b = enrich.batches(t("customer"), "c_custkey", 10, ("c_nationkey",))
    return b.select("c_nationkey", "batch", F.size("ids").cast("long").alias("n"), F.array_min("ids").alias("low"), F.array_max("ids").alias("high"))


@query("SELECT o_custkey AS id FROM orders UNION SELECT c_custkey FROM customer UNION SELECT s_suppkey FROM supplier")
def u1_union_ids(t: Tables) -> DataFrame:
    return enrich.union_ids({"o_custkey": t("orders"), "c_custkey": t("customer"), "s_suppkey": t("supplier")})


@query("""WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'), b AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderdate >= TIMESTAMP '2000-06-01')
    SELECT coalesce(a.k, b.k) AS o_custkey, CASE WHEN a.k IS NULL THEN 'opened' WHEN b.k IS NULL THEN 'resolved' ELSE 'open' END AS state FROM a FULL JOIN b ON a.k = b.k""")
def u3_findings_diff(t: Tables) -> DataFrame:
    return enrich.findings_diff(t("orders").where("o_orderdate < '1996-01-01'"), t("orders").where("o_orderdate >= '2000-06-01'"), ["o_custkey"])


_CHANGED = "o_orderkey % 1000 = 7"


@query(f"""SELECT o_orderkey, CASE WHEN o_orderkey % 2000 = 7 THEN 'resolved' WHEN {_CHANGED} THEN 'opened' ELSE 'open' END AS state FROM (SELECT DISTINCT o_orderkey FROM orders)""")
def u3_diff_by_digest(t: Tables) -> DataFrame:
    """Two snapshots that differ in one key of a thousand."""
    keys = t("orders").select("o_orderkey").distinct()
    return enrich.findings_diff_by_digest(keys.where(f"not ({_CHANGED}) or o_orderkey % 2000 = 7"), keys.where(f"not ({_CHANGED}) or o_orderkey % 2000 <> 7"), ["o_orderkey"])


@query("SELECT o_orderkey AS key, 'missing' AS problem FROM orders WHERE o_orderkey % 10 = 0 UNION ALL SELECT o_orderkey, 'repeated' FROM orders WHERE o_orderkey % 10 = 1")
def u4_exactly_once(t: Tables) -> DataFrame:
    keys = t("orders").select(F.col("o_orderkey").alias("key"))
    return enrich.exactly_once(keys.where("key % 10 <> 0").union(keys.where("key % 10 = 1")), keys, "key")
