"""Extra fields kept as (sale, field type, value) rows, the types found by name pattern."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.filters import name_matches_any


def attribute_codes(types: DataFrame, patterns: Mapping[str, str]) -> DataFrame:
    """Exactly one row: per pattern the highest matching type id, null when none matches."""
    name, code = F.col("name"), F.col("attribute_type_id")
    return types.where(name_matches_any(name, list(patterns.values()))).agg(
        *[F.max(F.when(name.ilike(pattern), code)).alias(role) for role, pattern in patterns.items()]
    )


def attribute_values(types: DataFrame, values: DataFrame, pattern: str | None, name: str) -> DataFrame:
    """``sale_id`` and the values of the field the pattern names, under the given column name.

    The type id is a scalar subquery, so the values are filtered where they are scanned and
    only the wanted ones are shuffled. Without a matching type, or without a pattern, there
    are no rows.
    """
    if pattern is None:
        wanted = F.lit(False)
    else:
        wanted = F.col("attribute_type_id") == attribute_codes(types, {"code": pattern}).scalar()
    return values.where(wanted).select("sale_id", F.col("value").alias(name))


def fields_per_sale(
    types: DataFrame, values: DataFrame, shown: Mapping[str, str | None], counted: Mapping[str, str | None]
) -> DataFrame:
    """Per sale: each shown field's different values with how many rows have each, and each counted field's rows.

    All fields are read in one scan of the values and reduced by value before a sale's values meet. A shown field
    ``name`` is an array ``name`` of (value, n), null or empty where the sale has none; a counted one is the number
    ``name_rows``, null where it has none. A field without a pattern or without a matching type has no rows.
    """
    patterns = {name: pattern for name, pattern in {**shown, **counted}.items() if pattern is not None}
    codes = {name: attribute_codes(types, patterns).select(name).scalar() for name in patterns}
    code = F.col("attribute_type_id")
    wanted = values.where(code.isin(*codes.values()) if codes else F.lit(False))
    # Two patterns may find one type: its rows then count for both.
    rows = {name: F.count(F.when(code == codes[name], F.lit(1)) if name in codes else F.lit(None)) for name in (*shown, *counted)}
    by_value = wanted.groupBy("sale_id", "value").agg(*[n.alias(f"{name}_n") for name, n in rows.items()])

    def values_of(name: str):
        found = F.struct(F.col("value"), F.col(f"{name}_n").alias("n"))
        return F.collect_list(F.when(F.col(f"{name}_n") > 0, found)).alias(name)

    counts = [F.nullif(F.sum(f"{name}_n"), F.lit(0)).alias(f"{name}_rows") for name in counted]
    return by_value.groupBy("sale_id").agg(*[values_of(name) for name in shown], *counts)
