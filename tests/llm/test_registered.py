"""The registered queries against their checking SQL, and the pipeline stage by stage."""

from __future__ import annotations

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op1_chat", "op8_warc", "op12_conversation_repair"])
def test_query_equals_its_sql(spark, name):
    connection = duckdb.connect()
    for file in os.listdir(DATA):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{file}'")
    found = __spark_entry__.queries()[name](spark, DATA)
    columns = sorted(found.columns)
    listed = ", ".join(f'"{c}"' for c in columns)
    expected = connection.execute(f"SELECT {listed} FROM ({__spark_entry__.oracle_sql()[name]}) AS e").fetchall()
    assert Counter(tuple(r[c] for c in columns) for r in found.collect()) == Counter(expected)


def test_every_operator_is_registered_once():
    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))


def test_pipeline_stages(spark):
    documents = spark.read.parquet(f"{DATA}/documents.parquet")
    docs, texts, counts = documents, {r.doc_id: r.text for r in documents.collect()}, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, DATA)
        assert kept.columns == documents.columns and kept.dtypes == documents.dtypes
        rows = kept.collect()
        assert {r.doc_id for r in rows} <= set(texts), name
        for r in rows:
            assert name == "repeated_passages" or r.text == texts[r.doc_id]
            assert r.n_chars == len(r.text)
        texts = {r.doc_id: r.text for r in rows}
        counts.append(len(rows))
        docs = spark.createDataFrame(rows, documents.schema)
    assert sorted(counts, reverse=True) == counts and counts[-1] > 100
    final = {r.doc_id: r for r in corpus_pipeline.run(spark, DATA).collect()}
    assert set(final) == set(texts)


def test_pipeline_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, DATA).count() == 0


def test_pipeline_of_odd_documents(spark):
    """Nulls, empty and long texts, repeated rows, clashing names, no n_chars: defined results, and no crash."""
    documents = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang")
    good = documents.where("length(text) BETWEEN 300 AND 3000").orderBy("doc_id").limit(40).collect()
    rows = [(r.doc_id, r.text, r.lang, 1, "r", 2) for r in good]
    odd = [(None, None), (900001, None), (900002, ""), (900003, " \n "), (900003, " \n "), (None, good[0].text + " more"), (900004, good[1].text)]
    rows += [(i, text, None, None, None, None) for i, text in odd]
    rows += [(900005, " ".join(f"{r.text}" for r in good) * 3, "x", 1, "r", 2), rows[2], rows[2]]
    schema = "doc_id long, text string, lang string, hash int, row string, node int"
    docs = spark.createDataFrame(rows, schema).repartition(4)
    kept = None
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        docs = spark.createDataFrame(stage(spark, docs, DATA).collect(), schema)
        kept = [r.doc_id for r in docs.collect()]
        assert docs.columns == schema.replace(",", "").split(" ")[::2], name
        if name == "near_copies":
            assert 900004 not in kept and kept.count(rows[2][0]) == 3
            assert sum(not (r.text or "").strip() for r in docs.collect()) == 1
    final = {r.doc_id: r for r in corpus_pipeline.STAGES[-1][1](spark, docs, DATA).collect()}
    assert set(final) == set(kept) and all((r.n_tokens or 0) == len(r.ids) for r in final.values())
    assert corpus_pipeline.quality(spark, spark.createDataFrame(rows, schema), DATA).columns == docs.columns
