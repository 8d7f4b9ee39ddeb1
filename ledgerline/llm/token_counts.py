"""Token counts: the exact histogram of encoded lengths, and suffix sums that answer for every context limit.

Documents are counted with the tokenizer (whole texts, a null text has none) and aggregated by length, so everything after
is as small as the number of different lengths. The suffix sums are made in two steps, of buckets and within them, so that
no task gets all lengths. With them, a limit's documents and tokens beyond, and the total if longer documents are cut
there, are one lookup; so are quantiles. An empty table has an empty histogram. Repeated rows count as often as they come.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.llm.bpe import SLICE_BYTES
from ledgerline.llm.pieces import Pieces, cut
from ledgerline.llm.shared import checkpointed
from ledgerline.llm.words import slices
from ledgerline.llm.worker import kept

BUCKET = 256
OPERATOR = "token_counts"


def lengths(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens) of every row, without special tokens."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = kept(OPERATOR)
        key = (path, pattern, len(shared.value))
        if key not in counters:
            encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=shared.value, special_tokens={})

            def counted(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
                # In place of its ids, a piece's number of ids.
                return np.array([len(encoding.encode_ordinary(piece)) for piece in pieces], np.int32), np.ones(len(pieces), np.int64)

            counters.clear()
            counters[key] = Pieces(counted)
        known = counters[key]
        for part in slices(batches, "text", SLICE_BYTES, OPERATOR):
            pieces, number, limits = cut(part.column(1))
            total = np.append(0, np.cumsum(known.ids(pieces)[0].astype(np.int64)[number]))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(total[limits]))], ["doc_id", "n_tokens"])

    wanted = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return wanted.mapInArrow(run, f"doc_id {wanted.schema['doc_id'].dataType.simpleString()}, n_tokens long")


def histogram(counted: DataFrame) -> DataFrame:
    """(n_tokens, n_docs): exact."""
    return counted.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def suffix_sums(hist: DataFrame) -> DataFrame:
    """Per length: documents and tokens of at least that length, and what remains if all are cut at that length."""
    hist = checkpointed(hist)  # read twice; the documents are counted once
    rows = hist.withColumn("bucket", F.floor(F.col("n_tokens") / BUCKET))
    tokens = F.col("n_tokens") * F.col("n_docs")
    buckets = rows.groupBy("bucket").agg(F.sum("n_docs").alias("d"), F.sum(tokens).alias("t"))
    above = W.orderBy(F.col("bucket").desc()).rowsBetween(W.unboundedPreceding, -1)
    buckets = buckets.select(
        "bucket",
        F.coalesce(F.sum("d").over(above), F.lit(0)).alias("docs_above"),
        F.coalesce(F.sum("t").over(above), F.lit(0)).alias("tokens_above"),
        F.sum("d").over(W.partitionBy()).alias("all_docs"),
        F.sum("t").over(W.partitionBy()).alias("all_tokens"),
    )
    down = W.partitionBy("bucket").orderBy(F.col("n_tokens").desc()).rowsBetween(W.unboundedPreceding, W.currentRow)
    summed = rows.join(buckets, "bucket").select(
        "n_tokens",
        "n_docs",
        (F.col("docs_above") + F.sum("n_docs").over(down)).alias("docs_at_least"),
        (F.col("tokens_above") + F.sum(tokens).over(down)).alias("tokens_at_least"),
        "all_docs",
        "all_tokens",
    )
    cut = F.col("all_tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")
    at_most = F.col("all_docs") - F.col("docs_at_least") + F.col("n_docs")
    return summed.select(
        "n_tokens", "n_docs", "docs_at_least", "tokens_at_least", cut.alias("truncated_total"), at_most.alias("docs_at_most"), "all_docs", "all_tokens"
    )


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """For each context limit: documents over it, and the total tokens if documents are cut there."""
    parts = F.explode(F.array(*[F.lit(limit).cast("long") for limit in limits])).alias("limit")
    total = F.max("all_tokens")
    over = F.col("n_tokens") > F.col("limit")
    docs_over = F.coalesce(F.sum(F.when(over, F.col("n_docs"))), F.lit(0))
    tokens_over = F.coalesce(F.max(F.when(over, F.col("tokens_at_least"))), F.lit(0))
    rows = sums.select("*", parts).groupBy("limit")
    return rows.agg(docs_over.alias("docs_over"), (total - tokens_over + F.col("limit") * docs_over).alias("truncated_total"))


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """The least length that at least each share of the documents does not exceed."""
    parts = F.explode(F.array(*[F.lit(share) for share in shares])).alias("share")
    fits = F.col("docs_at_most") >= F.col("share") * F.col("all_docs")
    return sums.select("*", parts).filter(fits).groupBy("share").agg(F.min("n_tokens").alias("n_tokens"))
