"""Dimension and document parts that several datasets share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.filters import is_true
from ledgerline.operators.joins import lookup, role
from ledgerline.operators.windows import near_keys, within_keys
from ledgerline.sources.readers import Tables


def product_makers(tables: Tables) -> DataFrame:
    """``product_id, maker`` of principal suppliers; several of them give several rows.

    The supplier is looked up outer and then required, which is an inner join.
    """
    principal = tables["product_supplier"].where(is_true(F.col("principal"))).select("product_id", "party_id")
    return principal.join(role(tables["party"], "party_id", "party_id", maker="name"), "party_id").drop("party_id")


def products_with_maker(tables: Tables) -> DataFrame:
    """Products that have a group and a principal supplier, with both names."""
    groups = role(tables["product_group"], "group_id", "group_id", product_group="name")
    return tables["product"].join(groups, "group_id").join(product_makers(tables), "product_id")


def places(tables: Tables) -> DataFrame:
    """Addresses with city and state; an address without a city stays."""
    return with_city(tables["address"], tables).select("address_id", "neighbourhood", "city", "state")


def with_city(rows: DataFrame, tables: Tables) -> DataFrame:
    """Add the names of the city and its state."""
    cities = tables["city"].select("city_id", "state_id", F.col("name").alias("city"))
    states = role(tables["state"], "state_id", "state_id", state="code")
    return lookup(lookup(rows, cities, "city_id"), states, "state_id")


def with_seller(rows: DataFrame, tables: Tables, customer: str, spread_by: Sequence[str]) -> DataFrame:
    """Add ``seller``: the principal sellers of the named customer column; the name may be unknown."""
    principal = tables["customer_seller"].where(is_true(F.col("principal")))
    sellers = principal.select(F.col("customer_id").alias("_sold_to"), "seller_id")
    # Named before they meet the rows, which are then dealt by the customer only.
    sellers = with_name(sellers, tables["party"], "seller_id", "seller", ["_sold_to"])
    return lookup(rows, sellers, {customer: "_sold_to"}, spread_by=spread_by)


def with_name(
    rows: DataFrame, dimension: DataFrame, key: str, name: str, spread_by: Sequence[str] = ()
) -> DataFrame:
    """Add the name of the dimension entry a key column points to; the key column goes.

    ``dimension`` is keyed by its first column and named by its column ``name``.
    """
    entries = role(dimension, dimension.columns[0], key, **{name: "name"})
    return lookup(rows, entries, key, spread_by=spread_by).drop(key)


def labelled_order_types(tables: Tables, order_type_id: int) -> DataFrame:
    """The one order type whose description is shown."""
    types = role(tables["order_type"], "order_type_id", "order_type_id", order_type="description")
    return types.where(F.col("order_type_id") == order_type_id)


def with_order_and_partner(
    rows: DataFrame, tables: Tables, spread_by: Sequence[str], order_ids: DataFrame, of_order: DataFrame | None = None
) -> DataFrame:
    """Add the order of ``order_id`` with the name of its partner, and what ``of_order`` has by ``order_id``.

    ``order_ids``: the rows' orders. Few of an order's columns are wanted, so the partner is named there and not on the rows.
    """
    orders = near_keys(within_keys(tables["order"], "order_id", order_ids), "order_id", order_ids).select(
        "order_id", "order_date", F.col("identifier").alias("order_identifier"), "partner_id"
    )
    orders = with_name(orders, tables["party"], "partner_id", "order_partner", ["order_id"])
    if of_order is not None:
        orders = lookup(orders, of_order, "order_id")
    return lookup(rows, orders, "order_id", spread_by=spread_by)
