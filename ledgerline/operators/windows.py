"""A window's keys on the tables that have no date of their own.

A window is chosen by dates, but its items, exits and payments are found by key. The least and greatest key of the
window are scalar subqueries on their scans, so Spark prunes files and row groups by them before it reads, and rows
outside never reach a shuffle. The keys need not be in order: the range only narrows, the join still decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def within_keys(rows: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Rows whose ``column`` is between the least and the greatest of ``keys``' first column; none if there is no key."""
    key = F.col(keys.columns[0])
    # Two aggregates would be merged into one subquery of a struct, whose fields are not pushed to a scan; an aggregate
    # and a top row are not.
    least = keys.agg(F.min(key).alias("least")).scalar()
    greatest = keys.select(key.alias("greatest")).orderBy(F.desc_nulls_last("greatest")).limit(1).scalar()
    return rows.where((F.col(column) >= least) & (F.col(column) <= greatest))


SLOTS = 1 << 26


def near_keys(rows: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Rows whose ``column`` may be one of ``keys``: all that are, and of the others those whose hash meets a key's.

    The keys' hashes are bits of a bitmap of ``SLOTS``, 64 to a row of at most 2^20 rows whatever the number of keys, which
    is broadcast. So rows of other keys are left out before they are dealt; the join behind it decides. Where broadcasts
    are switched off, all rows are left to that join.
    """
    if rows.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-"):
        return rows

    def bit_of(key: Column) -> tuple[Column, Column]:
        place = F.pmod(F.xxhash64(key), F.lit(SLOTS))
        return F.shiftright(place, 6), F.call_function("shiftleft", F.lit(1).cast("bigint"), (place % 64).cast("int"))

    key = F.col(keys.columns[0]).try_cast(rows.schema[column].dataType)
    word, bit = bit_of(key)
    bitmap = keys.where(key.isNotNull()).groupBy(word.alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    word, bit = bit_of(F.col(column))
    return rows.join(F.broadcast(bitmap), (word == F.col("_word")) & (F.col("_bits").bitwiseAND(bit) != 0), "left_semi")


def of_keys(rows: DataFrame, column: str, keys: DataFrame, few: bool = False) -> DataFrame:
    """Rows whose ``column`` is one of ``keys``, each once, read in the keys' range only.

    ``few``: the keys are a small part of their range, so that most rows in it are of no key.
    """
    wanted = keys.select(F.col(keys.columns[0]).alias(column))
    rows = within_keys(rows, column, wanted)
    return (near_keys(rows, column, wanted) if few else rows).join(wanted, column, "left_semi")
