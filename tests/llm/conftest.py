import public_tokenizers
import pytest


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows and columns whose names clash."""
    words = " ".join(f"word{i}" for i in range(40))
    rows = [(1, None), (2, ""), (3, words), (3, words), (4, words), (None, words), (5, "x" * 30_000), (6, " \n\t "), (7, "İstanbul ﬁ 日本語 e\u0301\u00a0x"), (None, None)]
    return spark.createDataFrame([(i, t, "en", "s", 0, "mine", 1.0, "ids") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, score string, rank double, ids string")


@pytest.fixture(scope="session")
def ranks(spark):
    from cairn.llm import bpe

    return bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
