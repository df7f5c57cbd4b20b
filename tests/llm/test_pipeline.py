"""The pipeline against a brute-force version of its stages, and the registered queries against their SQL."""

import hashlib

import duckdb
import pandas as pd
import pytest
from test_search_archives import brute as contaminated
from test_signature_join import brute as groups

import corpus_pipeline
from docferry.llm import toxicity
from docferry.llm.bpe import codec
from docferry.llm.queries import ORACLES, QUERIES

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_agree_with_their_sql(spark, small, name):
    found = QUERIES[name](spark, small).toPandas()
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{small}/{table}.parquet')")
    want = con.execute(ORACLES[name]).df()
    columns = sorted(found.columns)
    assert sorted(want.columns) == columns
    key = lambda r: tuple(map(str, r))
    assert sorted(rows_of(found, columns), key=key) == sorted(rows_of(want, columns), key=key)


def rows_of(df, columns):
    return [tuple(None if pd.isna(x) else str(x).removesuffix(".0") for x in r) for r in df[columns].itertuples(index=False)]


def test_pipeline(spark, small, byte_bpe):
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, small).collect()}
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{small}/labels.parquet"), usable=corpus_pipeline.id_remainder("doc_id", 4) != 2)
    kept = {r.doc_id: r.text for r in toxicity.score(docs, model).where("score < 0.3").collect()}
    same = groups(sorted(kept.items()))
    kept = {i: kept[i] for i, _, c in same if i == c}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    kept = {i: t for i, t in kept.items() if not contaminated(t, items)[-1]}
    assert found.keys() == kept.keys()
    tokens = codec(byte_bpe).library
    for i, text in kept.items():
        ids = tokens.encode(text, add_special_tokens=False).ids
        assert found[i].ids == ids and found[i].n_tokens == len(ids)
        assert found[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_stages_take_odd_rows(spark, small, odd_documents, no_documents):
    for docs in (odd_documents, no_documents):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, docs, small)
            assert kept.columns == docs.columns
            kept.collect()
        corpus_pipeline.STAGES[-1][1](spark, docs, small).collect()
