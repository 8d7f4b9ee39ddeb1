"""Cases that once gave wrong results: broken records, and dictionaries of copied texts."""

from __future__ import annotations

import os

import duckdb
from pyspark.sql import functions as F

from ledgerline.llm import langid, oracle, statistics, warc


def test_control_characters_cannot_break_records(spark, tmp_path):
    rows = [
        (1, "http://a/\r\nContent-Length: 0", "<title>A\r\nlanguage: xx</title>body\r\n\r\nmore"),
        (2, "http://b/\x00\x1f\x7f\tx y", "<title> \x00\x07 </title>"),
        (3, None, None),
        (3, None, None),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    made = warc.derivatives(warc.responses(pages), ("page_id",))
    warc.write(made, str(tmp_path / "out"))
    read = warc.read(spark, str(tmp_path / "out")).collect()
    assert sorted((r.record_id, r.target_uri or "", r.block) for r in read) == sorted((r.record_id, r.target_uri, r.block) for r in made.collect())
    blocks = {r.page_id: r.block for r in made.collect() if r.record_type == "metadata"}
    assert "title: A language: xx\r\nlanguage: \r\n" in blocks[1] and "title: \r\n" in blocks[2]
    uris = {r.page_id: r.target_uri for r in made.collect()}
    assert uris[1] == "http://a/%0D%0AContent-Length: 0" and uris[2] == "http://b/%00%1F%7F%09x y"
    connection = duckdb.connect()
    connection.register("pages", pages.toArrow())
    columns = ", ".join(sorted(made.columns))
    expected = connection.execute(f"SELECT {columns} FROM ({oracle.OP8_WARC})").fetchall()
    assert sorted(map(str, expected)) == sorted(str(tuple(r[c] for c in sorted(made.columns))) for r in made.collect())


def test_headers_of_other_sources_stay_on_their_lines(spark):
    row = ("<id>", "http://c/", "2024\r\nX: y", "HTTP/1.1 200 OK\r\nA: b\nC: d\r\n\r\n", "text")
    source = spark.createDataFrame([row], "record_id string, target_uri string, date string, http_headers string, payload string")
    values = [r.value for r in warc.records(warc.derivatives(source)).collect()]
    assert all("\nX: y" not in v and "\nC: d" not in v for v in values)
    assert any("source-header: A: b C: d\r\n" in v for v in values)


def test_copied_texts_neither_flood_nor_empty_the_dictionary(spark):
    word = {"en": "the house is there ", "de": "das Haus ist dort "}
    rows = [(i, lang, word[lang] * 40) for i in range(1500) for lang in ("en",)]
    rows += [(2000 + i, "de", f"{word['de'] * 30} {i}") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    found = langid.dictionaries(docs)
    assert b"the house" in found["en"] and len(found["en"]) <= 2000
    assert b"das haus" in found["de"] and found["de"] != b"de      " and len(found["de"]) > 10_000
    judged = langid.classify(docs, found).filter("held_out")
    assert judged.filter(F.col("lang_pred") != F.when(F.col("doc_id") < 2000, "en").otherwise("de")).count() == 0


def test_pieces_come_from_the_whole_text(spark):
    text = "begin " * 60_000 + "middle " * 60_000 + "end " * 60_000
    held = statistics.held_out()
    ids = [r.doc_id for r in spark.range(50).withColumnRenamed("id", "doc_id").filter(~held).collect()][:1]
    docs = spark.createDataFrame([(ids[0], "xx", text)], "doc_id long, lang string, text string")
    content = langid.dictionaries(docs)["xx"]
    assert len(content) <= langid.DICTIONARY_BYTES and all(w in content for w in (b"begin", b"middle", b"end"))


def test_languages_of_empty_tables_ties_and_long_texts(spark):
    docs = spark.createDataFrame([(1, "abc " * 300_000), (2, "abc"), (2, "abc"), (None, None), (3, "12 !")], "doc_id long, text string")
    same = {"b": b"abc abc ", "a": b"abc abc "}
    found = [(r.doc_id, r.lang_pred, r.score) for r in langid.classify(docs, same).collect()]
    assert sorted(found, key=str) == sorted([(1, "a", 0.0), (2, "a", 0.0), (2, "a", 0.0), (None, "und", 0.0), (3, "und", 0.0)], key=str)
    assert langid.classify(docs.limit(0), same).count() == 0
    assert langid.dictionaries(docs.limit(0).withColumn("lang", F.lit("a"))) == {}


def test_repeated_labels_of_one_id_are_bounded(spark):
    docs = spark.createDataFrame([(i, f"text {i} of some words") for i in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(i % 20, i % 2) for i in range(4000)], "doc_id long, quality int")
    _, matrix, answers = statistics.labelled_sample(docs, labels, "quality", 1000)
    assert len(matrix) == len(answers) <= 20


def test_registered_warc_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert os.path.exists(folder)
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    made = warc.derivatives(warc.responses(pages), ("page_id",))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet'")
    columns = sorted(made.columns)
    expected = connection.execute(f"SELECT {', '.join(columns)} FROM ({oracle.OP8_WARC})").fetchall()
    assert sorted(map(str, expected)) == sorted(str(tuple(r[c] for c in columns)) for r in made.collect())
