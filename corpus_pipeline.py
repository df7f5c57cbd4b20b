"""From raw documents to training text: toxic texts out, one of each near-duplicate group, no benchmark text, token ids.

Every stage works on all rows that the one before kept. The first three keep the columns of documents; the last gives
ids, their digest and that of the text they decode to.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docferry.llm import chunked_bpe, decontaminate, signature_join, toxicity
from docferry.llm.common import id_remainder, read_table, ship, unused
from docferry.llm.queries import BYTE_BPE
from docferry.session import scratch_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below the threshold; the model learns from the labelled ones among them."""
    ship(spark)
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"), usable=id_remainder("doc_id", 4) != 2)
    name = unused(docs, "_score")
    return toxicity.score(docs, model, into=name).where(F.col(name) < toxicity.THRESHOLD).drop(name)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near duplicates."""
    ship(spark)
    return signature_join.one_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark passage."""
    ship(spark)
    return decontaminate.without_passages(docs, read_table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and ids of every document."""
    ship(spark)
    return chunked_bpe.encode_documents(docs, public_tokenizers.path(BYTE_BPE))


STAGES = [("toxicity", drop_toxic), ("near_duplicates", one_of_each), ("decontaminate", drop_benchmark), ("encode", encode)]

#: A trained model and token ids have no SQL: tests/llm/test_pipeline.py compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each writes its rows to the shared folder and the next reads them."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
