"""A corpus pipeline: each stage gets what its predecessor kept, and its decisions take effect.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``docs``.
Rows without a doc_id pass the stages that compare documents unchanged; null and empty texts are kept.
"""

from __future__ import annotations

import uuid
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm import minhash_dedup, packing, secret_scan, substring_dedup, toxicity
from cairn.llm.common import FEW, counted, mark, shared_folder, small

#: Documents that score as much or more are toxic.
TOXIC = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is under TOXIC, by a model learned from the labels outside the held-out fold."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(docs, model, out="__toxicity", passages="__passages")
    return scored.where(F.col("__toxicity") < TOXIC).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies, that of the smallest id. Rows of one id go or stay
    together."""
    gone, n = counted(minhash_dedup.near_documents(docs).where("not kept").select("doc_id"))  # it is read twice
    marked = mark(docs, "doc_id", gone)
    some = marked.where("__hit").join(small(gone, FEW, n), "doc_id", "left_anti").select(*docs.columns)
    return marked.where("not __hit").select(*docs.columns).union(some)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document or place holds; n_chars follows the text."""
    return _counted(substring_dedup.remove(docs, substring_dedup.repeated_passages(docs)))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every secret replaced by a mark; n_chars follows the text."""
    found = secret_scan.scan(docs, secret_scan.learn(docs), out="__secrets")
    return _counted(secret_scan.redact(found, spans_col="__secrets").select(*docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces, each with its place in a sequence."""
    return packing.pack(packing.pieces(docs, Path(public_tokenizers.path("word_bpe_49k.json")).read_text()))


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_dedup", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("secret_scan", hide_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, the result of each written to the shared folder as Parquet and read again; it goes when
    the next one is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    where, before = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}", None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{where}/{name}")
        docs = spark.read.parquet(f"{where}/{name}")
        if before:
            at = spark._jvm.org.apache.hadoop.fs.Path(f"{where}/{before}")
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)


#: Trained scores, similarity search and tokenising can't be said in SQL; see tests/llm for the brute-force version.
ORACLE_SQL = None
