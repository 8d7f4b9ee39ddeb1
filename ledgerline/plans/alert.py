"""Low-stock alert for watched products and locations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import fixed_values as fv
from ledgerline.functions.labels import stock_level, stock_status
from ledgerline.functions.texts import format_moment, format_units
from ledgerline.operators.filters import listed
from ledgerline.operators.joins import lookup, role
from ledgerline.sources.readers import Tables


def _by_key(key: Column, values: Mapping[str, str]) -> Column:
    chain = F.lit(None).cast("string")
    for name, value in values.items():
        chain = F.when(key == name, F.lit(value)).otherwise(chain)
    return chain


def alert_items(
    tables: Tables,
    products: Sequence = fv.WATCHED_PRODUCTS,
    locations: Sequence = fv.WATCHED_LOCATIONS,
    critical_at: float = fv.CRITICAL_AT,
    low_at: float = fv.LOW_AT,
    product_column: str = "product_id",
) -> DataFrame:
    """Stock of each watched product in each watched location, classified.

    A null quantity is 0. A location without a name gets a default label.
    """
    watched = tables["stock_by_product"].where(
        listed(F.col(product_column), products) & listed(F.col("location_id"), locations)
    )
    per_location = watched.groupBy("product_name", "location_id").agg(F.sum("available_quantity").alias("held"))
    names = role(tables["stock_location"], "location_id", "location_id", location="name")
    items = (
        lookup(per_location, names, "location_id")
        .groupBy("product_name", "location")
        .agg(F.coalesce(F.sum("held"), F.lit(0)).alias("quantity"))
    )
    quantity = F.col("quantity")
    level = stock_level(quantity, critical_at, low_at)
    badge = F.when(quantity <= critical_at, F.lit("critical")).otherwise(F.lit("ok"))
    return items.select(
        F.coalesce(F.col("location"), F.lit(fv.UNKNOWN_LOCATION)).alias("location"),
        "product_name",
        "quantity",
        format_units(quantity, fv.QUANTITY_UNIT).alias("quantity_text"),
        stock_status(quantity, critical_at, fv.STATUS_CRITICAL, fv.STATUS_OK).alias("status"),
        level.alias("level"),
        _by_key(level, fv.QUANTITY_COLOURS).alias("quantity_colour"),
        _by_key(badge, fv.BADGE_BACKGROUND).alias("badge_background"),
        _by_key(badge, fv.BADGE_COLOUR).alias("badge_colour"),
    )


def alert_groups(items: DataFrame, styles: DataFrame, default_colour: str = fv.DEFAULT_COLOUR) -> DataFrame:
    """One row per location and product, with the location's colour.

    Rows, not a list per location: whoever prints them sorts by location and product.
    """
    colours = role(styles, "location_name", "location", colour="colour")
    return lookup(items, colours, "location").select(
        "location", F.coalesce(F.col("colour"), F.lit(default_colour)).alias("colour"), "product_name", "quantity"
    )


def alert_header(items: DataFrame, critical_status: str = fv.STATUS_CRITICAL, moment: datetime | None = None) -> DataFrame:
    """One row: the item counts, whether any item is critical, and the headline; none without items."""
    critical = F.col("status") == critical_status
    header = items.agg(
        F.count(F.lit(1)).alias("item_count"),
        F.count_if(critical).alias("critical_count"),
        F.bool_or(critical).alias("has_critical"),
    ).where(F.col("item_count") > 0)
    headline = F.when(F.col("has_critical"), F.lit(fv.HEADLINE_CRITICAL)).otherwise(F.lit(fv.HEADLINE_NORMAL))
    header = header.withColumn("headline", headline)
    if moment is not None:
        header = header.withColumn("created", format_moment(F.lit(moment)))
    return header


def location_styles(spark, colours: Mapping[str, str] = fv.LOCATION_COLOURS) -> DataFrame:
    return spark.createDataFrame(list(colours.items()), "location_name string, colour string")
