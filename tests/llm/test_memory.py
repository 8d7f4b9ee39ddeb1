"""What Spark and its Python workers hold at a time."""

from __future__ import annotations

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerline.llm import bpe, simhash, token_files, worker
from ledgerline.llm.pieces import Pieces
from ledgerline.llm.shared import BATCH_BYTES
from ledgerline.llm.words import slices


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_each_stage_alone_sends_small_batches(spark, tmp_path, name, stage):
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting)
    rows = [(i, f"some words of text {i}", "en") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    for table, columns in (("labels", "doc_id long, quality int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], columns).write.parquet(f"{tmp_path}/{table}.parquet")
    try:
        stage(spark, docs, str(tmp_path)).collect()

        def sizes(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

        wide = spark.range(3000).coalesce(1).selectExpr("repeat('x', 10000) AS text")
        assert max(r.n for r in wide.mapInArrow(sizes, "n long").collect()) < 2 * BATCH_BYTES
    finally:
        spark.conf.set(setting, before)


def test_tables_of_an_operator_go_with_another_ones_task():
    worker.kept(bpe.OPERATOR)["codec"] = "table"
    batch = pa.RecordBatch.from_arrays([pa.array(["a b", "c"])], ["text"])
    assert [b.num_rows for b in slices(iter([batch]), "text", operator=bpe.OPERATOR)] == [2]
    assert worker.kept(bpe.OPERATOR) == {"codec": "table"}
    assert [b.num_rows for b in slices(iter([batch]), "text")] == [2]
    assert worker.kept(bpe.OPERATOR) == {}


def test_few_edges_take_few_tasks(spark):
    wide = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in wide}
    for k, v in wide.items():
        spark.conf.set(k, v)
    try:
        chain = spark.range(1, 40).repartition(32).selectExpr("id AS u", "id - 1 AS v")
        apart = spark.createDataFrame([(100, 101), (102, 101)], "u long, v long")
        found = simhash.components(chain.union(apart))
        assert found.rdd.getNumPartitions() == 1
        assert {tuple(r) for r in found.collect()} == {*((n, 0) for n in range(1, 40)), (101, 100), (102, 100)}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_joined_labels_give_the_components_of_all_edges(spark):
    first = [(1, 2), (2, 3), (10, 11), (20, 21), (30, 31), (31, 32)]
    between = [(10, 20), (20, 5), (30, 40)]  # labels of the first edges, and nodes in none
    edges, joins = (spark.createDataFrame(x, "u long, v long") for x in (first, between))
    found = simhash.relabelled(simhash.components(edges), joins)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, simhash.components(edges.union(joins)).collect()))


def test_token_files_go_in_small_batches_and_reading_keeps_no_table(spark, tmp_path):
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting)
    docs = spark.range(40).selectExpr("id AS doc_id", "concat('text ', id) AS text")

    class Found:
        """Blocks of which the reading function is taken."""

        sparkSession = spark

        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            return run

    try:
        token_files.write(docs, f"{tmp_path}/files", public_tokenizers.path("byte_bpe_50k.json"))
        assert int(spark.conf.get(setting).rstrip("b")) == token_files.SLICE_BYTES
        spark.conf.set(setting, before)
        read = token_files.checksums(Found())
        assert int(spark.conf.get(setting).rstrip("b")) == token_files.SLICE_BYTES
        worker.kept(token_files.OPERATOR)["table"] = "pieces"
        assert list(read(iter([]))) == []
        assert token_files.OPERATOR not in worker._kept
    finally:
        spark.conf.set(setting, before)


def test_byte_characters_of_plain_words():
    encode = token_files.library_encoder(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read())
    words = [" word", "word", " 12", "!?", " it's", "\u00e9t\u00e9", " \u00fcber", "a\tb", "~", " "]
    ids, sizes = encode(words, Pieces(encode, own=True))
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = [tokenizer.encode(word, add_special_tokens=False).ids for word in words]
    assert [len(x) for x in expected] == sizes.tolist() and sum(expected, []) == ids.tolist()
