"""Learned models re-evaluated row by row in plain Python: languages, quality scores and verdicts."""

from __future__ import annotations

import math
import zlib

import pytest
import zstandard

from ledgerline.llm import decision_list, langid, rule_ensemble
from ledgerline.llm.statistics import COUNTS, text_statistics

DATA = "/root/testdata/sf0.001"


def tables(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")


def plain_features(n):
    """The features of one document from its counts."""

    def per(count, whole):
        return n[count] / max(n[whole], 1)

    return {
        "words": float(n["n_words"]), "word_length": per("word_chars", "n_words"), "longest": float(n["longest"]),
        "symbols": per("n_symbols", "n_words"), "dup_lines": per("n_dup_lines", "n_lines"), "repeats": per("n_repeat_words", "n_words"),
        "line_words": per("n_words", "n_lines"), "upper": n["n_upper"] / max(n["n_upper"] + n["n_lower"], 1), "digits": per("n_digits", "n_chars"),
        "marks": per("n_marks", "n_words"), "ends": per("n_ends", "n_words"), "distinct": per("n_distinct", "n_words"), "single": per("n_single", "n_words"),
    }


def holds(rule, names, values):
    return all(values[names[f]] > t if above else values[names[f]] <= t for f, t, above in rule)


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def counted(docs):
    return {r.doc_id: r.asDict() for r in text_statistics(docs).select("row.doc_id", *COUNTS).collect()}


@pytest.fixture(scope="module")
def odd(spark):
    documents = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = [(-1, None), (-2, ""), (-3, " \n "), (-4, "a " * 60_000), (-5, "### $$ && " * 30), (-6, "x" * 100_000)]
    return documents.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))


def test_scores_equal_the_rules_weights(spark, odd):
    documents, labels = tables(spark)
    model = rule_ensemble.train(documents, labels)
    counts = counted(odd)
    rows = rule_ensemble.scored(odd, model).select("row.doc_id", "held_out", "score", "predicted").collect()
    assert len(rows) == len(counts)
    for r in rows:
        values = plain_features(counts[r.doc_id])
        margin = model.intercept + sum(weight for rule, weight in model.rules if holds(rule, model.names, values))
        assert r.score == pytest.approx(1 / (1 + math.exp(-margin)), abs=1e-12)
        assert r.held_out == held(r.doc_id) and r.predicted == (r.score >= 0.3)
    assert rule_ensemble.scored(odd.limit(0), model).count() == 0


def test_verdicts_equal_the_first_rule_that_holds(spark, odd):
    documents, labels = tables(spark)
    names, rules = decision_list.train(documents, labels)
    counts = counted(odd)
    rows = decision_list.judged(odd, names, rules).select("row.doc_id", "base_failed", "kept", "entry").collect()
    assert len(rows) == len(counts)
    for r in rows:
        n = counts[r.doc_id]
        values = plain_features(n)
        entry = next((i for i, rule in enumerate(rules) if holds(rule, names, values)), len(rules))
        failed = n["n_words"] < 50 or 100 * n["n_repeat_words"] > 50 * n["n_words"]
        assert (r.base_failed, r.entry, r.kept) == (failed, entry, not failed and entry == len(rules))
    assert decision_list.judged(odd.limit(0), names, rules).count() == 0


def test_languages_equal_the_least_sum_of_sizes(spark, odd):
    documents, _ = tables(spark)
    contents = langid.dictionaries(documents)
    texts = {r.doc_id: r.text for r in odd.collect()}
    settings = zstandard.ZstdCompressionParameters.from_level(5, **langid.SETTINGS)

    def size(text, content):
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        compressor = zstandard.ZstdCompressor(compression_params=settings, dict_data=dictionary)
        raw = text.lower().encode()
        return sum(len(compressor.compress(raw[at : at + langid.CHUNK_BYTES])) for at in range(0, len(raw), langid.CHUNK_BYTES))

    for r in langid.classify(odd, contents).collect():
        text = texts[r.doc_id]
        if not text or not any(c.isalpha() for c in text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        sizes = sorted((size(text, content), lang) for lang, content in contents.items())
        assert r.lang_pred == sizes[0][1] and r.score == pytest.approx((sizes[1][0] - sizes[0][0]) / sizes[1][0])
        assert r.held_out == held(r.doc_id)
