"""Mergeable states of days: exact distinct documents and sums, small enough to keep with every load.

A state's rows are of three kinds. ``ids``: documents whose number is written plainly, as bits of a bitmap of dense ids,
2^15 to a row. ``texts``: all other document numbers, each as it is. ``sum``: the day's amount. States of
disjoint rows merge by or-ing bitmaps, keeping different texts and adding sums, in any order and grouping, so a day's
report needs the states only: never the lines they were made of.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATE_SCHEMA = "day date, kind string, piece bigint, bits binary, text string, total decimal(38,10)"


@dataclass(frozen=True)
class DayStates:
    """What is counted and added up by day: the day's column, the document's, and the amounts of a line."""

    day: str
    document: str
    amounts: tuple[str, ...]

    @property
    def columns(self) -> tuple[str, ...]:
        return (self.day, self.document, *self.amounts)


def states_of(lines: DataFrame, what: DayStates, by: Sequence[str] = ()) -> DataFrame:
    """State rows of all days of the lines, apart for each value of ``by``."""
    text = F.col(what.document).cast("string")
    number = F.try_to_number(F.when(text.rlike("^(0|[1-9][0-9]{0,17})$"), text), F.lit("9" * 18)).cast("bigint")
    per_line = F.col(what.amounts[0])
    for name in what.amounts[1:]:
        per_line = per_line + F.col(name)
    rows = lines.select(
        *by,
        F.to_date(F.col(what.day)).alias("day"),
        F.shiftright(number, 15).alias("piece"),
        number.bitwiseAND((1 << 15) - 1).alias("at"),
        F.when(number.isNull(), text).alias("text"),
        per_line.cast("decimal(38,10)").alias("amount"),
    )
    own = [*by, "day"]
    nothing = {"piece": "bigint", "bits": "binary", "text": "string", "total": "decimal(38,10)"}

    def shaped(df: DataFrame, kind: str, *given: str) -> DataFrame:
        values = [F.col(name) if name in given else F.lit(None).cast(cast).alias(name) for name, cast in nothing.items()]
        return df.select(*own, F.lit(kind).alias("kind"), *values)

    ids = rows.where("piece IS NOT NULL").groupBy(*own, "piece").agg(F.bitmap_construct_agg("at").alias("bits"))
    texts = rows.where("text IS NOT NULL").select(*own, "text").distinct()
    sums = rows.groupBy(*own).agg(F.sum("amount").alias("total"))
    return shaped(ids, "ids", "piece", "bits").unionByName(shaped(texts, "texts", "text")).unionByName(shaped(sums, "sum", "total"))


def merged(states: DataFrame) -> DataFrame:
    """One state per day of states of disjoint rows."""
    return states.groupBy("day", "kind", "piece", "text").agg(
        F.bitmap_or_agg("bits").alias("bits"), F.sum("total").cast("decimal(38,10)").alias("total")
    ).select("day", "kind", "piece", "bits", "text", "total")


def day_totals(states: DataFrame, day: date) -> DataFrame:
    """One row: distinct documents of a day and the sum of their amounts, as ``summary.daily_totals`` gives."""
    of_day = merged(states.where(F.col("day") == F.lit(day)))
    documents = F.when(F.col("kind") == "ids", F.bitmap_count("bits")).when(F.col("kind") == "texts", F.lit(1).cast("bigint"))
    return of_day.agg(F.coalesce(F.sum(documents), F.lit(0)).alias("orders"), F.sum("total").alias("total"))
