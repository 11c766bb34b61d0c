"""Toxic passages: maximum-scoring segments of token log-odds, judged by extreme-value statistics."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.llm.common import parts, tidy

TOKEN = re.compile(r"\w+")
#: Labelled rows of each label and fold that training takes at most, by the order of a hash of their id.
SAMPLE = 20_000
#: Tokens with a weight of their own at most.
TOKENS = 50_000
PASSAGES = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType()), T.StructField("p_value", T.DoubleType())]))


def fold(doc_id: Column) -> Column:
    """0 to 3; 2 is held out, 3 calibrates, the others teach the token weights."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def segments(points: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(first, last, score)`` in linear time (Ruzzo and Tompa's scan).

    ``points`` are the (position, score) of the tokens that have a weight; every token costs ``drift`` besides.
    """
    found: list[list] = []  # low sum, high sum, first, last, index of the nearest earlier segment with a lower low sum
    total, at = 0.0, 0
    for i, s in points:
        total -= drift * (i - at)
        at = i + 1
        s -= drift
        low, total = total, total + s
        if s <= 0:
            continue
        new = [low, total, i, i, -1]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][0] >= new[0]:
                j = found[j][4]
            if j < 0 or found[j][1] >= new[1]:
                new[4] = j
                found.append(new)
                break
            new[0], new[2] = found[j][0], found[j][2]
            del found[j:]
    return [(a, b, high - low) for low, high, a, b, _ in found]


@dataclass
class Model:
    weights: dict[str, float]
    drift: float
    rate: float
    log_k: float
    coef: tuple[float, float, float]
    level: float = 0.05

    def evidence(self, scored: list[tuple[int, int, float]], n: int) -> list[tuple[int, int, float, float]]:
        """The segments whose chance, by the law of the largest of n random segments, is under the level."""
        out = []
        for a, b, s in scored:
            bits = self.rate * s - math.log(max(n, 1)) - self.log_k
            p = -math.expm1(-math.exp(min(50.0, -bits)))
            if p < self.level:
                out.append((a, b, s, p))
        return out

    def features(self, kept: list[tuple[int, int, float, float]], n: int) -> tuple[float, float]:
        bits = [self.rate * s - math.log(max(n, 1)) - self.log_k for _, _, s, _ in kept]
        return math.log1p(max([0.0, *bits])), math.log1p(sum(max(0.0, x) for x in bits))

    def score(self, x: tuple[float, float]) -> float:
        z = self.coef[0] + self.coef[1] * x[0] + self.coef[2] * x[1]
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def token_weights(counts: DataFrame, drift: float, z: float = 2.5, least: int = 5) -> tuple[dict[str, float], float, float]:
    """Log-odds of tokens with an informative Dirichlet prior, of those whose z-score is at least ``z``.

    ``counts``: (token, y1, y0), numbers of texts of either label that hold it. Returns the weights, at most TOKENS
    of them, the extreme-value rate and the share of kept tokens in clean text, by which the rate was found.
    """
    n1, n0 = counts.agg(F.coalesce(F.sum("y1"), F.lit(0)), F.coalesce(F.sum("y0"), F.lit(0))).first()
    if not n1 or not n0:
        return {}, 1.0, 0.0
    prior = float(min(n1, n0))  # as much as the smaller side: a token seen on one side only is held against its overall share
    share = F.lit(prior) * (F.col("y1") + F.col("y0")) / F.lit(float(n1 + n0))
    odds = lambda y, n: F.log((F.col(y) + share) / (F.lit(n + prior) - F.col(y) - share))
    delta = odds("y1", n1) - odds("y0", n0)
    spread = F.sqrt(1 / (F.col("y1") + share) + 1 / (F.col("y0") + share))
    best = (
        counts.where(F.col("y1") + F.col("y0") >= least).select("token", "y0", delta.alias("d"), (delta / spread).alias("z"))
        .where(F.abs("z") >= z).orderBy(F.abs("z").desc(), "token").limit(TOKENS).collect()
    )
    weights = {r.token: r.d for r in best}
    scores = np.array([r.d - drift for r in best] + [-drift])
    seen = np.array([max(r.y0, 0.1) for r in best], float)
    p = np.concatenate([seen / n0, [max(1e-9, 1 - seen.sum() / n0)]])
    low, high = 0.0, 1.0
    moment = lambda x: float((p * np.exp(np.minimum(x * scores, 700))).sum()) - 1
    if scores.max(initial=-1) <= 0 or (p * scores).sum() >= 0:
        return weights, 1.0, float(seen.sum() / n0)
    while moment(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if moment(mid) < 0 else (low, mid)
    return weights, high, float(seen.sum() / n0)


def _tokens(text: str | None) -> list[str]:
    return TOKEN.findall(_lower(text)) if text else []


def _lower(text: str) -> str:
    return text.replace("\u0130", "i").lower()  # the one letter that gets longer


def _points(words: list[str], weights: dict[str, float]) -> list[tuple[int, float]]:
    return [(i, weights[w]) for i, w in enumerate(words) if w in weights]


def train(docs: DataFrame, labels: DataFrame, drift: float = 0.15) -> Model:
    """Learn from the labelled documents outside the held-out fold; at most SAMPLE texts of each label and fold.

    Rows without an id or label are left out, a document labelled more than once counts as toxic if any row says
    so, and of equal texts one is taken. Without labelled rows of both kinds every text scores the share of label 1.
    """
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("y"))
    known = known.withColumn("fold", fold(F.col("doc_id"))).where("fold <> 2")
    total = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    base = (total.get(1, 0) + 1) / (sum(total.values()) + 2)
    part = lambda y, test: known.where((F.col("y") == y) & test).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    teach, judge = F.col("fold") < 2, F.col("fold") == 3
    sample = part(1, teach).union(part(0, teach)).union(part(1, judge)).union(part(0, judge))
    spark = docs.sparkSession
    # at most 4 * SAMPLE rows of 16 bytes, taken to the driver and back so that later scans don't sort the labels anew
    sample = spark.createDataFrame(sample.collect(), "doc_id long, y int, fold long")
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    once = texts.join(F.broadcast(sample), "doc_id").groupBy(F.xxhash64("text"), F.md5("text")).agg(F.min("doc_id").alias("doc_id")).select("doc_id").distinct()
    sample = spark.createDataFrame(sample.join(once, "doc_id").collect(), "doc_id long, y int, fold long")
    labelled = texts.join(F.broadcast(sample), "doc_id")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches, 2000):
            sums = (Counter(), Counter())
            for t, y in zip(b.column("text").to_pylist(), b.column("y").to_pylist(), strict=True):
                sums[y].update(set(_tokens(t)))
            names = list(sums[0].keys() | sums[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([sums[1][w] for w in names], pa.int64()), pa.array([sums[0][w] for w in names], pa.int64())], ["token", "y1", "y0"])

    counts = labelled.where("fold < 2").select("text", "y").mapInArrow(tidy(counted), "token string, y1 long, y0 long").groupBy("token").agg(F.sum("y1").alias("y1"), F.sum("y0").alias("y0")).persist()
    weights, rate, _ = token_weights(counts, drift)
    counts.unpersist()
    model = Model(weights, drift, rate, 0.0, (math.log(base / (1 - base)), 0.0, 0.0))
    if not weights:
        return model

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches, 500):
            rows = [_tokens(t) for t in b.column("text").to_pylist()]
            found = [segments(_points(w, weights), drift) for w in rows]
            yield pa.RecordBatch.from_arrays([b.column("y"), pa.array([len(w) for w in rows], pa.int32()), pa.array([[s for _, _, s in f] for f in found], pa.list_(pa.float64()))], ["y", "n", "scores"])

    got = labelled.where("fold = 3").select("text", "y").mapInArrow(tidy(scanned), "y int, n int, scores array<double>").collect()
    clean = [rate * max(r.scores, default=0.0) - math.log(max(r.n, 1)) for r in got if not r.y]
    model.log_k = float(np.clip(np.mean(clean) - np.euler_gamma, -14, 0)) if clean else 0.0
    y = np.array([r.y for r in got], float)
    if not 0 < y.sum() < len(y):
        return model
    x = np.array([model.features(model.evidence([(0, 0, s) for s in r.scores], r.n), r.n) for r in got])
    weight = np.where(y == 1, base * len(y) / y.sum(), (1 - base) * len(y) / (len(y) - y.sum()))
    model.coef = tuple(_logistic(np.c_[np.ones(len(x)), x], y, weight))
    return model


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    b = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -40, 40)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(b)), x.T @ (weight * (y - p)) - ridge * b)
        b += step
        if np.abs(step).max() < 1e-8:
            break
    return b


def score(df: DataFrame, model: Model, text_col: str = "text", out: str = "toxicity", passages: str = "passages") -> DataFrame:
    """``df`` with ``out`` (0 to 1) and ``passages``: character spans of all significant passages with their p-values.

    Whole texts are scanned; null and empty texts have no passage and score as texts without evidence do. Columns
    of these names are replaced; every other column and repeated rows stay as they are.
    """
    df = df.drop(out, passages)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in parts(batches, 500, column=text_col):
            scores, spans = [], []
            for t in b.column(text_col).to_pylist():
                words = _tokens(t)
                kept = m.evidence(segments(_points(words, m.weights), m.drift), len(words))
                scores.append(m.score(m.features(kept, len(words))))
                at = [x.span() for x in TOKEN.finditer(_lower(t))] if kept else []
                spans.append([{"start": at[i][0], "end": at[j][1], "score": s, "p_value": p} for i, j, s, p in kept])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("p_value", pa.float64())]))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores, pa.float64()), pa.array(spans, kind)], [*b.schema.names, out, passages])

    fields = [*df.schema.fields, T.StructField(out, T.DoubleType()), T.StructField(passages, PASSAGES)]
    return df.mapInArrow(tidy(scored), T.StructType(fields))
