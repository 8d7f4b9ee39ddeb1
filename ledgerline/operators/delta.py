"""Table difference: which source rows are new or changed against a target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.joins import lookup
from ledgerline.operators.loads import last_per_key


def _comparable(value: Column, data_type: T.DataType) -> Column:
    """Null and empty text count as the same, in the comparison only."""
    if isinstance(data_type, T.StringType):
        return F.coalesce(value, F.lit(""))
    return value


def dates_only(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.to_date(F.col(column)))


def new_or_changed(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    date_column: str,
    metadata: Sequence[str] = ("created_at",),
) -> DataFrame:
    """Source rows without a target row, or differing from it in a shared column.

    Keys and date are not compared, and columns the target lacks are ignored; the row
    comes back whole, in source column order. A key the source holds twice counts with
    its last row only, so that a second run finds nothing. An empty target makes every
    row new.
    """
    latest = last_per_key(dates_only(source, date_column), keys, [date_column])
    known = target.drop(*metadata)
    compared = [name for name in source.columns if name in known.columns and name not in (*keys, date_column)]
    before = known.select(
        *keys,
        *[F.col(name).alias(f"_before_{name}") for name in compared],
        F.lit(True).alias("_known"),
    )
    differs = F.lit(False)
    for name in compared:
        now = _comparable(F.col(name), source.schema[name].dataType)
        then = _comparable(F.col(f"_before_{name}"), known.schema[name].dataType)
        differs = differs | ~now.eqNullSafe(then)
    merged = lookup(latest, before, list(keys), "left")
    return merged.where(F.col("_known").isNull() | differs).select(*source.columns)
