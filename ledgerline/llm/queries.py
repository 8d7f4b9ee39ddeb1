"""The registered queries of the numbered operators, over whole tables with production parameters, and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerline.llm import (
    bpe,
    chat,
    conversation_repair,
    decision_list,
    decontamination,
    langid,
    oracle,
    rule_ensemble,
    simhash,
    substrings,
    token_counts,
    token_files,
    warc,
    whitening,
)
from ledgerline.llm.shared import shared_folder, table

TOKENIZER = "byte_bpe_50k.tiktoken"
LIBRARY_TOKENIZER = "byte_bpe_50k.json"
WINDOW_WORDS = 20


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "\\### Assistant: </turn> ok"
    added = "conv_id long, turn long, role string, text string"
    extra = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(-7), F.lit(i), F.lit(role), F.lit(text)) for i, role in enumerate(("user", "assistant"))])))
    extra = extra.toDF("conv_id", "turn", "role", "text").select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in added.split(", ")])
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    read = chat.parse(chat.render(chat.messages(chat.from_turns(rows))))
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.classify(docs, langid.dictionaries(docs))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    outputs = ("ids_sha256", "decoded_sha256")
    path = public_tokenizers.path(TOKENIZER)
    return bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, outputs)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = rule_ensemble.train(docs, table(spark, sf_dir, "labels"))
    return rule_ensemble.scored(docs, model).select("row.doc_id", "held_out", "score", "predicted")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    counted = token_counts.lengths(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return token_counts.suffix_sums(token_counts.histogram(counted))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).drop("fp")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivatives(warc.responses(table(spark, sf_dir, "pages")), ("page_id",))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    names, rules = decision_list.train(docs, table(spark, sf_dir, "labels"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return decision_list.judged(docs, names, rules).select("row.doc_id", *counts, "base_failed", "kept", "entry")


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = substrings.dedup(docs, WINDOW_WORDS)
    return found.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/token-files-{uuid.uuid4()}"
    token_files.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path(LIBRARY_TOKENIZER))
    return token_files.checksums(token_files.blocks(spark, path))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports, _ = conversation_repair.repair(conversation_repair.damaged(table(spark, sf_dir, "conversations")))
    return reports.withColumnRenamed("digest", "repaired_sha256")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return whitening.transform(vectors, whitening.fit(vectors))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    operators = (
        op1_chat, op2_decontamination, op3_langid, op4_byte_bpe, op5_quality,
        op6_token_counts, op7_simhash, op8_warc, op9_quality_rules, op10_substrings,
        op11_token_files, op12_conversation_repair, op13_whitening,
    )
    return {f.__name__: f for f in operators} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    known = {"op1_chat": oracle.OP1_CHAT, "op8_warc": oracle.OP8_WARC, "op12_conversation_repair": oracle.OP12_REPAIR, "pipeline": corpus_pipeline.ORACLE_SQL}
    return {name: sql for name, sql in known.items() if sql}
