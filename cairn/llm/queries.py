"""The queries that apply each operator, with production parameters, to its whole table."""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm import bpe, embedding_dedup, filter_audit, license_scan, minhash_dedup, packing, quality_rules, secret_scan, sharding, substring_dedup, toxicity, url_filter, vector_codes


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, "text", ranks, public_tokenizers.PATTERN).select("doc_id", "ids")
    return bpe.decode(coded, "ids", ranks).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", (toxicity.fold(F.col("doc_id")) == 2).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.3).cast("int").alias("predicted"), F.size("passages").alias("n_passages"),
    )


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_documents(table(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs, secret_scan.learn(docs)).select("doc_id", "secrets")
    count = lambda k: F.size(F.filter("secrets", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")  # noqa: E731
    base = F.filter("secrets", lambda s: s["kind"] != "network")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(secret_scan.listed(base).cast("binary"), 256).alias("base_sha256"), secret_scan.listed(F.col("secrets")).alias("spans"),
    )


# fixed values: the rules
RULES = (("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql("SELECT * FROM VALUES " + ", ".join(map(str, RULES)) + " AS rules(host, path, verdict)")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


OP6_SQL = """
WITH rules(host, path, verdict) AS (VALUES """ + ", ".join(map(str, RULES)) + """),
cut AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
best AS (SELECT p.page_id, p.host, p.path, max(struct_pack(n := length(r.host || r.path), rule := r.host || r.path, verdict := r.verdict)) AS b
         FROM parts p LEFT JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
         GROUP BY p.page_id, p.host, p.path)
SELECT page_id, host, path, b.rule AS rule, coalesce(b.verdict, 'allow') AS verdict FROM best
"""


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    field = quality_rules.train(docs, table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, field).drop("text")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), Path(public_tokenizers.path("word_bpe_49k.json")).read_text()))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.judge(table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a tree source/lang/hundred/name. Those whose id ends with 0 or 1 stand for the licence
    files of the upper directories: they lie in source, or in source/lang; besides them, a document whose first line
    names a licence is the licence file of its directory."""
    tail, text_id = F.pmod("doc_id", F.lit(10)), F.col("doc_id").cast("string")
    lang, hundred = F.when(tail.isNull() | (tail > 0), F.col("lang")), F.when(tail > 1, F.floor(F.col("doc_id") / 100).cast("string"))
    path = F.concat_ws("/", "source", lang, hundred, F.coalesce(text_id, F.lit("")))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", path.alias("path"))
    opens = (tail < 2) | F.substring_index("text", "\n", 1).rlike("(?i)licen[cs]e")
    found = license_scan.scan(docs, license_scan.templates(spark), opens, keep=("doc_id",))
    return found.select("doc_id", "license", "score", "origin", F.substring_index("origin_path", "/", -1).try_cast("long").alias("origin_doc_id"))


OP10_SQL = r"""
WITH known(template_id, license, statement) AS (VALUES """ + ", ".join(f"({i}, '{a}', '{b}')" for i, (a, b) in enumerate(license_scan.TEMPLATES)) + r"""),
docs AS (SELECT doc_id, text, regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir, path, doc_id % 10 < 2 OR regexp_matches(split_part(text, chr(10), 1), '(?i)licen[cs]e') AS file
         FROM (SELECT *, concat_ws('/', source, CASE WHEN doc_id % 10 > 0 THEN lang END, CASE WHEN doc_id % 10 > 1 THEN CAST(doc_id // 100 AS VARCHAR) END, CAST(doc_id AS VARCHAR)) AS path FROM documents)),
blocks AS (SELECT doc_id, unnest([text] || list_transform(string_split_regex(text, '
[ 	
]*
'), lambda b: regexp_replace(b, '[ 	
]+', ' ', 'g'))) AS b FROM docs),
named AS (SELECT DISTINCT doc_id, unnest(string_split(regexp_replace(b, '([.!?])[ 	
]+', '\1' || chr(10), 'g'), chr(10))) AS statement FROM blocks),
said AS (SELECT DISTINCT statement FROM named),
ours AS (SELECT statement, token, count(*) AS tf FROM (SELECT statement, unnest(regexp_extract_all(lower(statement), '[a-z0-9]+')) AS token FROM said) GROUP BY ALL),
theirs AS (SELECT template_id, token, count(*) AS tf FROM (SELECT template_id, unnest(regexp_extract_all(lower(statement), '[a-z0-9]+')) AS token FROM known) GROUP BY ALL),
n AS (SELECT count(*) AS n FROM known),
idf AS (SELECT token, ln((1.0 + any_value(n)) / (1.0 + count(*))) + 1.0 AS idf FROM theirs, n GROUP BY token),
ow AS (SELECT statement, token, tf * coalesce(idf, ln(1.0 + n) + 1.0) AS w FROM ours LEFT JOIN idf USING (token), n),
tw AS (SELECT template_id, token, tf * idf AS w FROM theirs JOIN idf USING (token)),
os AS (SELECT statement, sqrt(sum(w * w)) AS s FROM ow GROUP BY 1),
ts AS (SELECT template_id, sqrt(sum(w * w)) AS s FROM tw GROUP BY 1),
scored AS (SELECT statement, template_id, round(sum(ow.w * tw.w) / (any_value(os.s) * any_value(ts.s)), 6) AS score
           FROM ow JOIN tw USING (token) JOIN os USING (statement) JOIN ts USING (template_id) GROUP BY 1, 2),
matched AS (SELECT statement, license, score FROM (SELECT *, row_number() OVER (PARTITION BY statement ORDER BY score DESC, template_id) AS k FROM scored WHERE score >= 0.75) JOIN (SELECT template_id, license FROM known) USING (template_id) WHERE k = 1),
own AS (SELECT doc_id, max(struct_pack(score := score, license := license)) AS m FROM named JOIN matched USING (statement) GROUP BY doc_id),
giving AS (SELECT dir, doc_id AS g_id, m.license AS g_license, m.score AS g_score FROM own JOIN docs USING (doc_id) WHERE file
           QUALIFY row_number() OVER (PARTITION BY dir ORDER BY m.score DESC, path) = 1),
near AS (SELECT d.doc_id, g.* FROM docs d JOIN giving g ON d.dir = g.dir OR starts_with(d.dir, g.dir || '/') QUALIFY row_number() OVER (PARTITION BY d.doc_id ORDER BY length(g.dir) DESC) = 1)
SELECT d.doc_id, coalesce(o.m.license, g.g_license) AS license, coalesce(o.m.score, g.g_score) AS score,
       CASE WHEN o.doc_id IS NOT NULL THEN 'own' WHEN g.g_id IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
       CASE WHEN o.doc_id IS NOT NULL THEN d.doc_id ELSE g.g_id END AS origin_doc_id
FROM docs d LEFT JOIN own o ON d.doc_id = o.doc_id LEFT JOIN near g ON d.doc_id = g.doc_id
"""


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels"))


OP11_SQL = r"""
WITH words AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
failing AS (SELECT doc_id, part, {A: len(w) < 200, B: 100 * len(list_distinct(w)) < 50 * len(w), C: 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text),
                   D: regexp_matches(text, '[#$%&*|]'), E: coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)} AS f FROM words),
marked AS (SELECT part, f, coalesce(good, false) AS good, coalesce(bad, false) AS bad FROM failing
           LEFT JOIN (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS bad FROM labels GROUP BY doc_id) USING (doc_id)),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
           WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
counted AS (SELECT part, [x FOR x IN ['A', 'B', 'C', 'D', 'E'] IF CASE x WHEN 'A' THEN f.A WHEN 'B' THEN f.B WHEN 'C' THEN f.C WHEN 'D' THEN f.D ELSE f.E END] AS fails,
                   count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS bad FROM marked GROUP BY ALL),
steps AS (SELECT part, filter_order, step, filter_order[step] AS own, string_split(filter_order[1:step - 1], '') AS before, fails, n, good, bad
          FROM counted, orders, range(1, 6) g(step)),
judged AS (SELECT *, list_contains(fails, own) AS hit, list_has_any(fails, before) AS gone FROM steps),
rows AS (SELECT part, filter_order, step, own, sum(n) FILTER (NOT hit AND NOT gone) AS kept, sum(n) FILTER (hit AND NOT gone) AS removed, sum(n) FILTER (hit AND gone) AS redundant,
                sum(n) FILTER (fails = [own]) AS unique_fails, sum(good) FILTER (hit AND NOT gone) AS good_lost, sum(bad) FILTER (hit AND NOT gone) AS toxic_lost
         FROM judged GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, coalesce(kept, 0) AS kept, coalesce(removed, 0) AS removed, coalesce(redundant, 0) AS redundant, coalesce(unique_fails, 0) AS unique_fails,
       coalesce(good_lost, 0) AS good_lost, coalesce(toxic_lost, 0) AS toxic_lost, coalesce(sum(removed) OVER (PARTITION BY part, own), 0) AS shapley
FROM rows
"""


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def _op12_sql(parts: int = vector_codes.PARTS, entries: int = vector_codes.ENTRIES, rounds: int = vector_codes.ROUNDS) -> str:
    """Every part against every entry, one round after the other."""
    steps = [f"c0 AS (SELECT p, r - 1 AS k, v AS e FROM cut WHERE r <= {entries})"]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT r, p, min(struct_pack(far := far, k := k)) AS best
            FROM (SELECT r, cut.p, k, list_sum(list_transform(list_zip(v, e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS far FROM cut JOIN c{i} USING (p)) GROUP BY r, p)""")
        if i < rounds:
            steps.append(f"""m{i} AS (SELECT p, k, list(x ORDER BY place) AS e FROM (SELECT p, best.k AS k, place, floor(sum(v[place])::DOUBLE / count(*))::BIGINT AS x
                FROM a{i} JOIN cut USING (r, p), generate_series(1, len(v)) g(place) GROUP BY ALL) GROUP BY p, k)""")
            steps.append(f"c{i + 1} AS MATERIALIZED (SELECT p, k, coalesce(m{i}.e, c{i}.e) AS e FROM c{i} LEFT JOIN m{i} USING (p, k))")
    return f"""
WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id, ints) AS r, * FROM (SELECT vec_id, label, list_transform(embedding, lambda x: floor({vector_codes.SCALE} * x::DOUBLE)::BIGINT) AS ints
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
cut AS MATERIALIZED (SELECT r, p, ints[p * len(ints) // {parts} + 1 : (p + 1) * len(ints) // {parts}] AS v FROM kept, range({parts}) g(p)),
{", ".join(steps)},
coded AS (SELECT r, string_agg(right('0' || lower(hex(best.k)), 2), '' ORDER BY p) AS code, sum(best.far)::BIGINT AS error FROM a{rounds} GROUP BY r),
said AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, k, place)) AS codebooks_sha256 FROM (SELECT p, k, unnest(e) AS x, generate_subscripts(e, 1) AS place FROM c{rounds}))
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256, label FROM coded JOIN kept USING (r), said
"""


OP12_SQL = _op12_sql()


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.slots(table(spark, sf_dir, "documents"))


OP13_SQL = f"""
WITH RECURSIVE docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
bits AS (SELECT i AS b, 0 AS k, i::BIGINT AS c FROM range(256) t(i)
         UNION ALL SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE k = 8),
sums AS (SELECT r, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::BIGINT)),
                           lambda s, x: xor(s >> 8, t[(xor(s, x) & 255) + 1])), 4294967295::BIGINT) AS crc FROM docs, crc),
jumps AS (SELECT r, ((coalesce(doc_id, 0)::HUGEINT + {sharding.TOP}::HUGEINT) % {sharding.TOP}::HUGEINT) AS k, 0::BIGINT AS home FROM docs
          UNION ALL SELECT r, n, floor((home + 1) * (2147483648.0::DOUBLE / ((n // 8589934592)::DOUBLE + 1)))::BIGINT
          FROM (SELECT r, home, (k * {sharding.FACTOR}::HUGEINT + 1) % {sharding.TOP}::HUGEINT AS n FROM jumps WHERE home < 9)),
homes AS (SELECT r, max(home) FILTER (home < 8) AS shard, max(home) FILTER (home < 9) AS grown_shard FROM jumps GROUP BY r)
SELECT doc_id, octet_length(encode(text)) + 1 AS size, crc::BIGINT AS text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY md5(text), doc_id NULLS FIRST) - 1 AS slot, grown_shard, md5(text) AS text_md5
FROM docs JOIN homes USING (r) JOIN sums USING (r)
"""


QUERIES = {f.__name__: f for f in (op1_embedding_dedup, op2_bpe, op3_toxicity, op4_minhash_dedup, op5_secret_scan, op6_url_filter, op7_quality_rules, op8_packing, op9_substring_dedup, op10_license_scan, op11_filter_audit, op12_vector_codes, op13_sharding)}
ORACLE = {"op6_url_filter": OP6_SQL, "op10_license_scan": OP10_SQL, "op11_filter_audit": OP11_SQL, "op12_vector_codes": OP12_SQL, "op13_sharding": OP13_SQL}
