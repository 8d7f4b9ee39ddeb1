"""From raw documents to token ids: quality, near copies, repeated passages, benchmark leaks, encoding.

Every stage takes the documents that its predecessor kept, and its decisions take effect. A stage's result is written as
Parquet in the shared checkpoint folder and read again as the next one's documents; it goes once the next one's is
written. All stages but the last return the columns of ``documents``; other columns, whatever their names, are
carried through them.

Defined results. Rows are never told apart by anything but id and text, so repeated rows meet one fate, except that of
near copies with one id all rows with that id and fingerprint stay. A null or empty text is scored like any other
text without words (by the rules learned, which as a rule reject it); of those that are left one stays as a copy of
none, nothing is removed from it, it holds no benchmark item, and it has no ids. A null id sorts before all others.
Very long texts are treated whole. Of ties the smallest id stays. An empty table gives an empty result in every stage.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import bpe, decontamination, rule_ensemble, simhash, substrings
from ledgerline.llm.shared import remove_folder, shared_folder, small_batches, table, unpacked

WINDOW_WORDS = 20
TOKENIZER = "byte_bpe_50k.tiktoken"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble, trained on the labels, does not reject."""
    small_batches(spark)
    model = rule_ensemble.train(docs, table(spark, sf_dir, "labels"))
    return unpacked(rule_ensemble.scored(docs, model).filter("predicted = 1"), docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, found by fingerprints in vantage-point trees and by minhashes, and
    decided on the texts' shingles: the one with the smallest id."""
    small_batches(spark)
    return simhash.without_near_copies(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that start earlier in the corpus; documents of which nothing is left go."""
    small_batches(spark)
    found = substrings.dedup(docs, WINDOW_WORDS).filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("row.text"))
    changed = {"text": text}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return unpacked(found, docs.columns, **changed)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    small_batches(spark)
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and digests of the ids and of what they decode to."""
    small_batches(spark)
    outputs = ("ids", "ids_sha256", "decoded_sha256")
    return bpe.encode(docs, public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN, outputs)


STAGES = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("encoded", encoded),
]

# The first stage learns a model, which SQL cannot express. Near copies and repeated passages are tested against brute force
# on small texts; the pipeline as a whole is not.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4()}"
    docs, before = table(spark, sf_dir, "documents"), None
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove_folder(spark, before)
        before = path
    return docs
