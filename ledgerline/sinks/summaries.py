"""What keys each partition of a target holds, so that a load opens only partitions its keys can be in.

A load writes, beside its data, one summary per partition it wrote: the least and greatest value of every key column,
and a bitmap with one hashed bit per key. A later load keeps the partitions whose ranges meet its own, and of these the
ones whose bitmap shares a bit with the bitmap of its keys. Both may let through too many partitions, never too few: what is let
through is opened and searched by the keys themselves.

The bitmaps are made and met by Spark's bitmap aggregates, in pieces of ``PIECE_BITS``. A partition's bitmap has about
``BITS_A_KEY`` bits per key; the keys of a load are hashed once for each size in use, a power of two.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECE_BITS = 1 << 15
BITS_A_KEY = 64


def summary_schema(keys: Sequence[tuple[str, str]], partition_name: str) -> str:
    ranges = ", ".join(f"`least_{name}` {kind}, `greatest_{name}` {kind}" for name, kind in keys)
    return f"`{partition_name}` string, keys string, row_count bigint, pieces bigint, piece bigint, bits binary, {ranges}"


def _bit(keys: Sequence[str], pieces: Column) -> Column:
    """The key's bit in a bitmap of ``pieces`` pieces (a power of two): the hash's last bits."""
    return F.xxhash64(*keys).bitwiseAND(pieces * PIECE_BITS - 1)


def _bitmaps(rows: DataFrame, by: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """(by, pieces, piece, bits) of rows that have ``pieces``."""
    bit = _bit(keys, F.col("pieces"))
    placed = rows.select(*by, "pieces", F.shiftright(bit, 15).alias("piece"), bit.bitwiseAND(PIECE_BITS - 1).alias("at"))
    return placed.groupBy(*by, "pieces", "piece").agg(F.bitmap_construct_agg("at").alias("bits"))


def summarised(rows: DataFrame, partition_name: str, keys: Sequence[str]) -> DataFrame:
    """Summary rows of all partitions of ``rows``; a key with a null matches nothing and is left out.

    ``row_count`` counts all rows, those without a whole key too.
    """
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    ranges = []
    for key in keys:
        value = F.when(known, F.col(key))
        ranges += [F.min(value).alias(f"least_{key}"), F.max(value).alias(f"greatest_{key}")]
    wanted = F.greatest(F.sum(known.cast("bigint")) * BITS_A_KEY / PIECE_BITS, F.lit(1))
    pieces = F.pow(F.lit(2), F.ceil(F.log2(wanted))).cast("bigint")
    sizes = rows.groupBy(partition_name).agg(F.count(F.lit(1)).alias("row_count"), pieces.alias("pieces"), *ranges)
    held = rows.where(known).select(partition_name, *keys)
    bits = _bitmaps(held.join(sizes.select(partition_name, "pieces"), partition_name), [partition_name], keys)
    whole = sizes.join(bits, [partition_name, "pieces"], "left").withColumn("keys", F.lit(",".join(keys)))
    names = [f"{end}_{key}" for key in keys for end in ("least", "greatest")]
    return whole.select(partition_name, "keys", "row_count", "pieces", "piece", "bits", *names)


def candidates(
    summaries: DataFrame, partition_name: str, wanted: DataFrame, keys: Sequence[str], known: Iterable[str]
) -> set[str]:
    """Partitions that may hold one of the ``wanted`` keys; those of ``known`` without a summary of these keys are among them."""
    own = summaries.where(F.col("keys") == ",".join(keys))
    wanted = wanted.dropna(subset=list(keys))
    ends = [f(F.col(key)).alias(f"{name}_{key}") for key in keys for name, f in (("first", F.min), ("last", F.max))]
    bounds = wanted.agg(*ends).first()
    fits = F.lit(True)
    for key in keys:
        first, last = bounds[f"first_{key}"], bounds[f"last_{key}"]
        fits = fits & (F.col(f"greatest_{key}") >= F.lit(first)) & (F.col(f"least_{key}") <= F.lit(last))
    # One row per partition at most comes to the driver, here and below.
    sizes = own.groupBy(partition_name).agg(F.max("pieces").alias("pieces"), F.max(F.coalesce(fits, F.lit(False))).alias("fits"))
    rows = sizes.collect()
    without = set(known) - {row[0] for row in rows}
    near = {row[0] for row in rows if row["fits"]}
    if not near:
        return without
    used = sorted({row["pieces"] for row in rows if row["fits"]})
    dealt = wanted.withColumn("pieces", F.explode(F.array(*[F.lit(n).cast("bigint") for n in used])))
    asked = _bitmaps(dealt, [], keys).select("pieces", "piece", F.col("bits").alias("asked"))
    met = own.where(F.col(partition_name).isin(*near)).join(asked, ["pieces", "piece"])
    both = met.select(partition_name, "piece", F.explode(F.array("bits", "asked")).alias("b"))
    shared = both.groupBy(partition_name, "piece").agg(F.bitmap_and_agg("b").alias("b")).where(F.bitmap_count("b") > 0)
    return without | {row[0] for row in shared.select(partition_name).distinct().collect()}


def row_counts(summaries: DataFrame, partition_name: str) -> Mapping[str, int]:
    rows = summaries.groupBy(partition_name).agg(F.max("row_count").alias("row_count")).collect()
    return {row[0]: row["row_count"] for row in rows}
