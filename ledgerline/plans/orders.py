"""Order lines of the last days, and their difference from the target."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import fixed_values as fv
from ledgerline.functions import money
from ledgerline.operators.delta import new_or_changed
from ledgerline.operators.filters import listed, other_than, since
from ledgerline.operators.joins import role
from ledgerline.operators.loads import apply_latest
from ledgerline.params import RunParams
from ledgerline.plans import parts
from ledgerline.sources.readers import Tables, target_window

ORDER_KEY = ("order_id", "sku")
ORDER_DATE = "order_date"


def order_lines(tables: Tables, params: RunParams) -> DataFrame:
    """Open order lines since the order window's start; the order's freight is on every line."""
    orders = tables["order"].where(
        since(F.col("order_date"), params.order_start)
        & listed(F.col("situation"), params.codes.order_situations)
        & other_than(F.col("location_id"), params.codes.order_excluded_location)
    )
    orders = parts.with_name(orders, tables["party"], "partner_id", "partner", ["order_id"])
    orders = orders.join(
        role(tables["order_type"], "order_type_id", "order_type_id", order_type="description"), "order_type_id"
    ).join(role(tables["stock_location"], "location_id", "location_id", location="name"), "location_id")
    products = tables["product"].select("product_id", "sku", "product_name")
    lines = tables["order_item"].join(orders, "order_id").join(products, "product_id")
    quantity, price, discount = F.col("quantity"), F.col("unit_price"), F.col("discount")
    return lines.select(
        # Never null behind the join; written so that the schema says it too.
        F.coalesce(F.col("order_id"), F.lit(0).cast(lines.schema["order_id"].dataType)).alias("order_id"),
        "order_date",
        F.coalesce(F.col("partner"), F.lit(fv.ORDER_CHANNEL_DEFAULT)).alias("channel"),
        F.coalesce(F.col("identifier"), F.lit(fv.ORDER_IDENTIFIER_DEFAULT)).alias("identifier"),
        F.coalesce(F.col("sku"), F.lit(fv.ORDER_SKU_DEFAULT)).alias("sku"),
        F.coalesce(F.col("product_name"), F.lit(fv.ORDER_PRODUCT_DEFAULT)).alias("product_name"),
        F.coalesce(quantity, F.lit(0)).alias("quantity"),
        money.cents_to_units(F.col("order_freight")).alias("freight"),
        money.cents_to_units(discount).alias("discount"),
        money.order_unit_value(price, discount).alias("product_value"),
        money.order_final_value(price, quantity, discount, F.col("order_freight")).alias("final_value"),
        F.coalesce(F.col("location"), F.lit(fv.ORDER_LOCATION_DEFAULT)).alias("stock_location"),
        F.coalesce(F.col("order_type"), F.lit(fv.ORDER_ORIGIN_DEFAULT)).alias("origin"),
        F.coalesce(F.col("situation"), F.lit(0)).alias("situation"),
    )


def order_delta(source: DataFrame, target: DataFrame, params: RunParams) -> DataFrame:
    """New or changed order lines against the target's rows of the window."""
    window = target_window(target, ORDER_DATE, params.order_start)
    return new_or_changed(source, window, ORDER_KEY, ORDER_DATE)


def updated_orders(target: DataFrame, delta: DataFrame) -> DataFrame:
    """The target with the delta, one row per key, applied; nothing is ever removed from it."""
    return apply_latest(target, delta, ORDER_KEY)
