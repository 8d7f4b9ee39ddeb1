"""Projection and type operators on whole tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.texts import tolerant_number


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.lower() for name in df.columns])


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Union all by column name; a column one side lacks is null there."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def coerce_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Make the named columns numbers, unreadable or null becoming 0; absent names are skipped."""
    return df.withColumns({name: tolerant_number(F.col(name)) for name in columns if name in df.columns})


def project_allowlist(df: DataFrame, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """Listed columns that exist, in list order, cast to their listed type."""
    return df.select(*[F.col(name).cast(kind).alias(name) for name, kind in columns if name in df.columns])


def conform(df: DataFrame, target: DataFrame, defaults: Mapping[str, Column] | None = None) -> DataFrame:
    """The rows in the target's columns and types.

    A target column the rows lack takes its default, else null; columns the target lacks go.
    """
    defaults = defaults or {}
    columns = []
    for field in target.schema.fields:
        if field.name in df.columns:
            value = F.col(field.name)
        else:
            value = defaults.get(field.name, F.lit(None))
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(*columns)
