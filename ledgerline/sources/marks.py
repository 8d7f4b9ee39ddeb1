"""High-water mark of the incremental billing load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.params import RunParams


def high_water_mark(sale: DataFrame, params: RunParams) -> DataFrame:
    """One row ``mark``: the day of the latest change of a finished sale, else the fallback day."""
    codes = params.codes
    finished = sale.where((F.col("situation") == codes.sale_situation) & (F.col("project_id") == codes.sale_project))
    latest = F.to_date(F.max("modified_at"))
    return finished.agg(F.coalesce(latest, F.lit(params.mark_fallback)).alias("mark"))


def mark_value(sale: DataFrame, params: RunParams) -> Column:
    """The mark as a scalar subquery, so that nothing passes through the driver."""
    return high_water_mark(sale, params).scalar()
