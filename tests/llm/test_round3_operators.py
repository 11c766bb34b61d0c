"""Filter audit, vector codes and sharding against brute force."""

import base64
import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from compare import duck_rows, spark_rows
from pyspark.sql import functions as F

from cairn.llm import bpe, common, filter_audit, minhash_dedup, quality_rules, secret_scan, sharding, vector_codes
from cairn.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", ["op11_filter_audit", "op12_vector_codes", "op13_sharding"])
def test_same_rows_as_sql(spark, sf_dir, name):
    assert spark_rows(QUERIES[name](spark, sf_dir)) == duck_rows(ORACLE[name], sf_dir)


# sharding


def jump(key: int, n: int) -> int:
    """The published loop, with Python's integers."""
    at, nxt, key = -1, 0, key % 2**64
    while nxt < n:
        at = nxt
        key = (key * 2862933555777941757 + 1) % 2**64
        nxt = math.floor((at + 1) * (2**31 / ((key >> 33) + 1)))
    return at


def test_jump_paths(spark):
    keys = [0, 1, -1, 7, 2**63 - 1, -(2**63), None, *random.Random(1).sample(range(2**60), 300)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = df.select("k", sharding.path(F.col("k"), 2000).alias("p")).collect()
    for r in got:
        for n in (1, 2, 8, 9, 31, 32, 33, 500, 2000):
            assert [x for x in r.p if x < n][-1] == jump(r.k or 0, n)


def check_slots(rows, source, shards=8):
    assert len(rows) == len(source)
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    for r in rows:
        assert (r.shard, r.grown_shard, r.law) == (jump(r.doc_id or 0, shards), jump(r.doc_id or 0, shards + 1), "key")
    want = sorted((i is not None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in source)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r["size"], r.text_crc32) for r in rows) == want
    at = sorted((r.shard, r.slot, r.text_md5) for r in rows)
    groups = [k for k, _ in itertools.groupby((s, m) for s, _, m in at)]
    assert len(groups) == len(set(groups))  # equal texts side by side


def test_slots_of_odd_rows(spark, odd):
    check_slots(sharding.slots(odd).collect(), [(r.doc_id, r.text) for r in odd.collect()])
    assert sharding.slots(odd.limit(0)).count() == 0


def test_slots_of_long_and_hot_texts(spark):
    rows = [(i, "copy") for i in range(300)] + [(5, "same row")] * 200 + [(1000, "é" * 3_000_000), (1001, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    check_slots(sharding.slots(df, 3).collect(), rows, 3)


def test_moves_and_files(spark, tmp_path, docs):
    few = docs.select("doc_id", "text")
    moved = sharding.moves(few, 8, 11).select("doc_id", "shard", "new_shard").collect()
    assert {(r.doc_id, r.shard, r.new_shard) for r in moved} == {(i, jump(i, 8), jump(i, 11)) for (i,) in few.select("doc_id").collect() if jump(i, 8) != jump(i, 11)}
    assert all(r.new_shard >= 8 for r in moved)
    sharding.write(few, str(tmp_path / "out"), 8, files=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert {(r.doc_id, r.shard) for r in back.collect()} == {(r.doc_id, jump(r.doc_id, 8)) for r in few.collect()}
    assert back.count() == few.count()


# vector codes


def product_codes(rows):
    """rows: (vec_id, label, vector); every part against every entry."""
    good = [(i, lab, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, lab, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    d = len(good[0][2])
    good = [r for r in good if len(r[2]) == d]
    cuts = [(d * p // 4, d * (p + 1) // 4) for p in range(4)]
    books = [[r[2][lo:hi] for r in good[:256]] for lo, hi in cuts]
    near = lambda v, book: min((sum((a - b) ** 2 for a, b in zip(v, e, strict=True)), k) for k, e in enumerate(book))
    for turn in range(5):
        found = [[near(r[2][lo:hi], b) for r in good] for (lo, hi), b in zip(cuts, books, strict=True)]
        if turn < 4:
            for p, (lo, hi) in enumerate(cuts):
                for k in range(len(books[p])):
                    own = [r[2][lo:hi] for r, (_, e) in zip(good, found[p], strict=True) if e == k]
                    if own:
                        books[p][k] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = [(r[0], r[1], "".join(f"{found[p][i][1]:02x}" for p in range(4)), sum(found[p][i][0] for p in range(4))) for i, r in enumerate(good)]
    total = {lab: sum(o[3] for o in out if o[1] == lab) for lab in {o[1] for o in out}}
    return sorted(((*o, total[o[1]], sha) for o in out), key=repr)


def as_rows(df):
    return sorted(((r.vec_id, r.label, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect()), key=repr)


@pytest.mark.parametrize("dimension", [8, 3])
def test_codes_of_odd_vectors(spark, dimension):
    g = random.Random(dimension)
    rows = [(i, g.choice([0, 1, None]), [round(g.gauss(i % 3, 0.2), 3) for _ in range(dimension)]) for i in range(350)]
    rows += [(i, 1, rows[3][2]) for i in range(400, 460)] + [(5, 2, rows[7][2]), (5, 2, rows[7][2]), (None, None, [-0.5] * dimension)]
    rows += [(900, 0, None), (901, 0, []), (902, 0, [None] * dimension), (903, 0, [float("nan")] * dimension), (904, 0, [float("inf")] * dimension), (905, 0, [1.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, label int, embedding array<float>, code string").repartition(3)
    assert as_rows(vector_codes.compress(df)) == product_codes(rows)


def test_codes_of_few_or_no_vectors(spark):
    schema = "vec_id long, label int, embedding array<float>"
    assert vector_codes.compress(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, None, [1.0, -2.0, 0.0005, 3.0])]
    assert as_rows(vector_codes.compress(spark.createDataFrame(rows, schema))) == product_codes(rows)
    huge = vector_codes.compress(spark.createDataFrame([(1, 1, [3e38] * 4), (2, 1, [-3e38] * 4)], schema)).collect()
    assert [r.error for r in huge] == [0, 0]


@pytest.mark.parametrize("n, k, entries, spread", [(1, 4, 1, 5), (700, 4, 200, 3), (3000, 16, 256, 90), (2000, 1, 30, 900), (64, 16, 256, 2)])
def test_search_is_exact(n, k, entries, spread):
    g = np.random.default_rng(n)
    x = np.round(g.normal(size=(n, k)) * spread).astype(np.int64) + np.round(g.normal(size=(8, k)) * spread * 20).astype(np.int64)[g.integers(0, 8, n)]
    book = x[g.integers(0, n, entries)]
    tree = vector_codes.grow(x, vector_codes.LEAF)
    node, owner, place, own = vector_codes.search(tree, book)
    got = np.full(n, -1)
    for (lo, hi), o in zip(zip(*tree.bounds(node), strict=True), owner, strict=True):
        assert (got[lo:hi] == -1).all()
        got[lo:hi] = o
    got[place] = own
    assert (got == ((tree.points[:, None] - book[None]) ** 2).sum(2).argmin(1)).all()
    assert all((tree.sums[i] == tree.points[lo:hi].sum(0)).all() for i, (lo, hi) in enumerate(zip(*tree.bounds(np.arange(len(tree.low))), strict=True)))


def test_whole_nodes_are_assigned_and_exactness_beyond_doubles():
    g = np.random.default_rng(2)
    x = np.repeat(np.array([[0] * 4, [1000] * 4, [5000] * 4]), 200, 0) + g.integers(-5, 6, (600, 4))
    tree = vector_codes.grow(x, vector_codes.LEAF)
    node, _, place, _ = vector_codes.search(tree, np.array([[0] * 4, [1000] * 4, [5000] * 4]))
    assert len(place) < 64 and len(node) < 20  # only leaves that reach over two groups
    big = (x << 18) + g.integers(0, 3, (600, 4))
    book = big[:200]
    tree = vector_codes.grow(big, vector_codes.LEAF)
    node, owner, place, own = vector_codes.search(tree, book)
    want = ((tree.points[:, None] - book[None]) ** 2).sum(2).argmin(1)
    assert (want[place] == own).all()


# filter audit


def audited(rows, labels):
    """rows: (doc_id, text, source); each order is run, one filter after the other."""
    good, toxic = ({i for i, q, t in labels if (q, t)[k] == 1 and i is not None} for k in (0, 1))
    least: dict = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    own_fails = {}
    for t in {t or "" for _, t, _ in rows}:
        w = [x for x in t.translate({c: " " for c in range(9, 14)}).split(" ") if x]
        own_fails[t] = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t), "D": any(c in "#$%&*|" for c in t)}
    fails = [own_fails[t or ""] | {"E": i is not None and least[t or ""] < i} for i, t, _ in rows]
    out, own = {}, {}
    for part in {s or "" for _, _, s in rows}:
        mine = [(i, f) for (i, _, s), f in zip(rows, fails, strict=True) if (s or "") == part]
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [x for x in left if x[1][f]]
                left = [x for x in left if not x[1][f]]
                own[part, f] = own.get((part, f), 0) + len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), sum(x[1][f] for x in mine) - len(gone), sum(x[1][f] and sum(x[1].values()) == 1 for x in mine), sum(x[0] in good for x in gone), sum(x[0] in toxic for x in gone)]
    return {k: (*v, own[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def report_rows(df):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in df.collect()}


def test_audit_takes_back_what_smaller_ids_change(spark, tmp_path):
    g = random.Random(3)
    long = " ".join(f"w{i}" for i in range(250))
    texts = [None, "", long, long + " A", long.upper(), "same " * 300, "cost $5 | x", "İ \x1c a b c " + long, "x" * 500_000]
    rows = [(g.choice([None, *range(40)]), g.choice(texts), g.choice(["s", "t", "", None])) for _ in range(300)]
    labels = [(i, g.choice([0, 1, None]), g.choice([0, 1])) for i in range(0, 40, 2)] + [(4, 1, 1), (None, 1, 1)]
    labelled = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    kind, path, folder = "doc_id long, text string, source string", str(tmp_path / "docs"), str(tmp_path / "state")
    seen = []
    for size in (100, 1, 199):  # files come in three runs, so later ones have smaller ids for known texts
        some = rows[len(seen) : len(seen) + size]
        seen += some
        spark.createDataFrame(some, kind).repartition(min(4, size)).write.mode("append").parquet(path)
        counters = filter_audit.update(spark, path, labelled, folder)
        assert report_rows(filter_audit.report(counters)) == audited(seen, labels)
    again = filter_audit.update(spark, path, labelled, folder)  # nothing new
    assert report_rows(filter_audit.report(again)) == audited(seen, labels)
    assert sum(r.n for r in again.collect()) == len(rows)


def test_audit_of_an_empty_table_and_other_columns(spark, tmp_path):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    spark.createDataFrame([], "doc_id long, text string, source string").write.parquet(str(tmp_path / "none"))
    assert filter_audit.audit(spark, str(tmp_path / "none"), labels).count() == 0
    rows = [(1, "a b", "x"), (2, "a b", "x")]
    spark.createDataFrame([(i, t, s, "m", 7) for i, t, s in rows], "doc_id long, text string, source string, mask string, n int").write.parquet(str(tmp_path / "more"))
    assert report_rows(filter_audit.audit(spark, str(tmp_path / "more"), labels)) == audited(rows, [])
    spark.createDataFrame(rows, "k long, body string, kind string").write.parquet(str(tmp_path / "named"))
    assert report_rows(filter_audit.audit(spark, str(tmp_path / "named"), labels, id_="k", text="body", part="kind")) == audited(rows, [])


# secrets beyond the base patterns


def test_network_finds_planted_secrets(spark, docs):
    g = random.Random(1)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    some = lambda n, of=letters: "".join(g.choices(of, k=n))
    raw = lambda n: g.randbytes(n)
    plain = lambda n: base64.urlsafe_b64encode(raw(n)).decode().rstrip("=")
    known = [w for r in docs.limit(150).collect() for w in (r.text or "").split() if w.isalpha()]
    words = lambda n: [g.choice(known) for _ in range(n)]
    base = [f"{' '.join(words(20))} {s} {' '.join(words(20))} {'-'.join(words(4))} {'/'.join(words(5))} {'.'.join(words(4))}" for s in
            [*(f"password = {some(12)}" for _ in range(120)), *(f"api_key: {some(30)}" for _ in range(120)), *(raw(16).hex() for _ in range(120)), *("AKIA" + some(16, letters[:26]) for _ in range(60))]]
    net = secret_scan.train(spark.createDataFrame([(i, t) for i, t in enumerate(base)], "doc_id long, text string").union(docs.select("doc_id", "text")))
    secrets = {"base64": lambda: base64.b64encode(raw(30)).decode(), "prefixed": lambda: "ghp_" + some(36), "signed": lambda: ".".join((plain(27), plain(40), plain(32))), "mixed": lambda: some(28)}
    harmless = {"address": lambda: "www." + ".".join(words(1)).lower() + ".example.com/" + "/".join(words(3)), "joined": lambda: "".join(words(5)), "hyphens": lambda: "-".join(words(5)), "path": lambda: "/usr/share/" + "/".join(words(3)) + ".txt"}
    rows = [(k, f"{' '.join(words(8))} {f()} {' '.join(words(8))}") for k, f in (secrets | harmless).items() for _ in range(50)]
    found = secret_scan.scan(spark.createDataFrame(rows, "kind string, text string"), net)
    share = {r.kind: r.n / 50 for r in found.groupBy("kind").agg(F.sum((F.size("secrets") > 0).cast("int")).alias("n")).collect()}
    assert all(share[k] >= 0.9 for k in secrets) and sum(share[k] for k in harmless) / len(harmless) <= 0.05, share
    clean = secret_scan.scan(docs.select("doc_id", "text"), net).select(F.explode("secrets.kind").alias("k")).where("k = 'network'").count()
    assert clean <= 2


def test_recoded_values_are_candidates():
    for i in range(200):
        value = secret_scan.recoded(f"value{i}")
        assert value == secret_scan.recoded(f"value{i}") and secret_scan.RUN.fullmatch(value)
    assert secret_scan.restless("aB3dE5gH7jK9mN1p") and not secret_scan.restless("just-some-long-words/and/a/path")


def test_network_learns_from_all_findings_without_a_sample(spark, docs, monkeypatch):
    g = random.Random(2)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    some = lambda n: "".join(g.choices(letters, k=n))
    known = [w for r in docs.limit(150).collect() for w in (r.text or "").split() if w.isalpha()]
    words = lambda n: [g.choice(known) for _ in range(n)]
    base = [f"{' '.join(words(9))} {s} {' '.join(words(9))} {'-'.join(words(5))} {'/'.join(words(6))} {'.'.join(words(5))}" for s in
            [*(f"password = {some(16)}" for _ in range(300)), *(f"api_key: {some(30)}" for _ in range(300)), *(g.randbytes(16).hex() for _ in range(300))]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(base)], "doc_id long, text string")
    for name, few in (("SAMPLE", 50), ("SHARE", 1000)):  # no bound of the sample holds; several shares
        monkeypatch.setattr(secret_scan, name, few)
    want = {(y, w[1]) for t in base for y, own, a, b in secret_scan.labelled(t) for w in secret_scan.windows(own, a, b)}
    assert sorted((r.y, r.b) for r in secret_scan.examples_of(df).collect()) == sorted(want) and len(want) > 3000
    net = secret_scan.learn(df)
    again = secret_scan.learn(df.repartition(7, "text"))  # partitions don't matter
    assert np.allclose(net.conv, again.conv) and np.isclose(net.threshold, again.threshold)
    rows = [(k, f"{' '.join(words(8))} {f()} {' '.join(words(8))}") for k, f in (("secret", lambda: "ghp_" + some(36)), ("mixed", lambda: some(28)), ("path", lambda: "/".join(words(5))), ("joined", lambda: "-".join(words(5)))) for _ in range(50)]
    found = secret_scan.scan(spark.createDataFrame(rows, "kind string, text string"), net)
    share = {r.kind: r.n / 50 for r in found.groupBy("kind").agg(F.sum((F.size("secrets") > 0).cast("int")).alias("n")).collect()}
    assert share["secret"] >= 0.9 and share["mixed"] >= 0.9 and share["path"] + share["joined"] <= 0.1, share
    with pytest.warns(UserWarning, match="no network"):
        assert secret_scan.learn(df.limit(2)) is None


def test_few_rows_are_in_transit_to_python(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name, "10000")
    try:
        for own, most in (("10000", common.BATCH), ("0", common.BATCH), ("7", 7)):
            spark.conf.set(name, own)
            common.short_batches(spark)
            sizes = spark.range(0, 2000, 1, 1).mapInArrow(lambda bs: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in bs), "n long").collect()
            assert sum(r.n for r in sizes) == 2000 and max(r.n for r in sizes) == most
    finally:
        spark.conf.set(name, before)
    batch = pa.RecordBatch.from_pydict({"text": ["x" * 100_000] * 10})
    assert [b.num_rows for b in common.parts(iter([batch]))] == [2] * 5


# texts of several MB


def test_very_long_texts(spark, ranks):
    import public_tokenizers

    long = "ordinary words of a long line " * 150_000  # 4.5 MB
    df = spark.createDataFrame([(1, long), (2, "short"), (3, None), (4, long + "end"), (5, "")], "doc_id long, text string")
    coded = bpe.encode(df, "text", ranks, public_tokenizers.PATTERN)
    back = {r.doc_id: bytes(r.bytes).decode() for r in bpe.decode(coded, "ids", ranks).select("doc_id", "bytes").collect()}
    assert back == {1: long, 2: "short", 3: "", 4: long + "end", 5: ""}
    net = secret_scan.scan(df.withColumn("text", F.concat("text", F.lit(" password=abcdef12"))), None)
    assert {r.doc_id: len(r.secrets) for r in net.collect()} == {1: 1, 2: 1, 3: 0, 4: 1, 5: 1}
    judged = quality_rules.judge(df, quality_rules.Field(np.zeros(quality_rules.FEATURES), np.zeros((2, 2)), 0.0))
    assert {r.doc_id: r.n_words for r in judged.collect()} == {1: 900_000, 2: 1, 3: 0, 4: 900_001, 5: 0}
    classes = {r.doc_id: r.component_id for r in minhash_dedup.near_documents(df).collect()}
    assert classes[1] == classes[4] == 1 and classes[2] == 2


def test_document_frequencies_of_many_tasks(spark, docs):
    one = minhash_dedup.document_frequencies(docs.coalesce(1))
    many = minhash_dedup.document_frequencies(docs.repartition(37))
    assert one[1] == many[1] == docs.count() and (one[0] == many[0]).all() and one[0].sum() > 0


# recall of near copies by weighted similarity, toxicity from end to end


def test_weighted_near_copies_are_found(spark):
    g = random.Random(11)
    word = lambda: "".join(g.choices("abcdefghijklmnopqrstuvwxyz", k=7))
    rows, pairs = [], []
    for k in range(260):
        words = [word() for _ in range(g.choice([60, 150, 400]))]
        other = list(words)
        for _ in range(g.randint(0, max(1, len(words) // 30))):
            other[g.randrange(len(other))] = word()
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    weights = minhash_dedup.idf(*minhash_dedup.document_frequencies(df))
    bags = []
    for _, t in rows:
        hashes, _ = minhash_dedup.Words([t]).shingles(5)
        keys, counts = np.unique(hashes, return_counts=True)
        bags.append(dict(zip(keys.tolist(), (counts * weights[(keys & np.uint64(minhash_dedup.WIDTH - 1)).astype(np.intp)]).tolist(), strict=True)))
    for k in range(260):
        a, b = bags[2 * k], bags[2 * k + 1]
        pairs.append(sum(min(a[x], b[x]) for x in a.keys() & b.keys()) / sum(max(a.get(x, 0), b.get(x, 0)) for x in a.keys() | b.keys()))
    component = {r.doc_id: r.component_id for r in minhash_dedup.near_documents(df).collect()}
    linked = [component[2 * k + 1] == 2 * k for k in range(260)]
    near = [y for x, y in zip(pairs, linked, strict=True) if x >= 0.801]
    assert len(near) > 80 and sum(near) >= 0.97 * len(near)
    assert not any(y for x, y in zip(pairs, linked, strict=True) if x < 0.799) and sum(x < 0.799 for x in pairs) > 40


def test_toxicity_of_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    rows = QUERIES["op3_toxicity"](spark, sf_dir).where("held_out").join(labels, "doc_id").collect()
    toxic, clean = [r.predicted for r in rows if r.toxic == 1], [r.predicted for r in rows if r.toxic == 0]
    assert len(toxic) > 5 and sum(toxic) >= 0.5 * len(toxic) and sum(clean) <= 0.06 * len(clean)


# tasks follow rows


def _unmerged(spark, n):
    """Sets n shuffle partitions that nothing coalesces; returns what was set before."""
    new = {"spark.sql.shuffle.partitions": str(n), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in new}
    for k, v in new.items():
        spark.conf.set(k, v)
    return before


def _restore(spark, before):
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_counted_tables(spark):
    before = _unmerged(spark, 30)
    try:
        some = spark.range(100).groupBy((F.col("id") % 50).alias("k")).count()
        nothing = spark.range(100).where("id < 0")
        for df, n in ((some, 50), (nothing, 0), (nothing.groupBy("id").count(), 0), (some.join(nothing.withColumnRenamed("id", "k"), "k"), 0), (spark.createDataFrame([], "k long"), 0), (spark.range(common.ROWS + 1), common.ROWS + 1)):
            table, rows = common.counted(df)
            assert rows == n == table.count()
            assert table.rdd.getNumPartitions() <= common.tasks(n)
    finally:
        _restore(spark, before)


def test_near_copies_tasks_follow_rows(spark):
    words = [f"w{i}" for i in range(200)]
    docs = [(i, " ".join(words[:40] + [f"x{i % 7}"] + words[40:])) for i in range(1, 30)] + [(100 + i, " ".join(f"{w}y{i}" for w in words)) for i in range(30)]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    expected = {(r.doc_id, r.component_id) for r in minhash_dedup.near_documents(df).collect()}
    assert sum(a != b for a, b in expected) == 28
    before, sc = _unmerged(spark, 40), spark.sparkContext
    try:
        sc.setJobGroup("tasks follow rows", "")
        found = {(r.doc_id, r.component_id) for r in minhash_dedup.near_documents(df).collect()}
        status = sc.statusTracker()
        stages = {s for j in status.getJobIdsForGroup("tasks follow rows") for s in status.getJobInfo(j).stageIds}
        tasks = sum(i.numCompletedTasks for s in stages if (i := status.getStageInfo(s)))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        _restore(spark, before)
    assert found == expected
    assert tasks < 700
