"""Totals reported against a configured dimension."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def totals_by_entry(dimension: DataFrame, facts: DataFrame, on: Mapping[str, str], measures: Mapping[str, str]) -> DataFrame:
    """Sums per dimension entry, 0 for an entry without rows.

    One pass over the facts: they are summed per key first, so the join is dimension-sized
    on both sides.
    """
    (entry_key, fact_key), = on.items()
    sums = facts.groupBy(fact_key).agg(*[F.sum(column).alias(name) for name, column in measures.items()])
    sums = sums.withColumnRenamed(fact_key, "_fact_key")
    joined = dimension.join(sums, F.col(entry_key) == F.col("_fact_key"), "left").drop("_fact_key")
    return joined.withColumns({name: F.coalesce(F.col(name), F.lit(0)) for name in measures})


def bucket_totals(entries: DataFrame, measures: Mapping[str, str], line: list[str], total: list[str]) -> DataFrame:
    """Every line and every total of ``total`` in one table; ``is_total`` tells them apart."""
    grouped = entries.groupingSets([[*line], [*total]], *line).agg(
        *[F.sum(column).alias(name) for name, column in measures.items()],
        F.grouping(line[-1]).cast("boolean").alias("is_total"),
    )
    return grouped
