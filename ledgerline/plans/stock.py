"""Stock position by location, product, maker and group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.filters import is_true, listed
from ledgerline.operators.joins import lookup, role
from ledgerline.operators.tables import coerce_numbers
from ledgerline.params import RunParams
from ledgerline.plans import parts
from ledgerline.sources.readers import Tables

NUMERIC_COLUMNS = ("available_quantity", "unit_value", "total_value")


def stock_position(tables: Tables, params: RunParams) -> DataFrame:
    """Available quantity and value (cents) of active products in the configured locations.

    Quantities are summed per product and location before any join, so that a product with
    very many stock rows is one row from there on; the dimension joins may repeat a row, and
    the final sums repeat it as they would the single rows.
    """
    per_product = (
        tables["stock_by_product"]
        .where(listed(F.col("location_id"), params.codes.stock_locations))
        .groupBy("product_id", "group_id", "location_id", "sku", "product_name", "unit_cost")
        .agg(
            F.sum("available_quantity").alias("quantity"),
            F.sum(F.col("available_quantity") * F.col("unit_cost")).alias("value"),
        )
    )
    active = tables["product"].where(is_true(F.col("is_product")) & is_true(F.col("is_active"))).select("product_id")
    locations = role(tables["stock_location"], "location_id", "location_id", location="name")
    groups = role(tables["product_group"], "group_id", "group_id", product_group="name")
    rows = per_product.join(active, "product_id").join(locations, "location_id")
    rows = lookup(rows, groups, "group_id").join(parts.product_makers(tables), "product_id")
    position = rows.groupBy(
        "sku", "location", "product_name", "maker", "product_group", F.col("unit_cost").alias("unit_value")
    ).agg(F.sum("quantity").alias("available_quantity"), F.sum("value").alias("total_value"))
    return position.select(
        "sku", "location", "product_name", "maker", "product_group", "available_quantity", "unit_value", "total_value"
    )


def stock(tables: Tables, params: RunParams) -> DataFrame:
    """Stock position ready to load, numbers filled with 0."""
    return coerce_numbers(stock_position(tables, params), NUMERIC_COLUMNS)
