"""Billing lines: invoices and direct sales.

Both datasets are built document first. The window is applied to documents (or sales),
all party, place, order and payment lookups are made at that grain, and only then are
the items joined, so that the wide joins never carry item rows.

Several joins of these datasets contribute no column but repeat the rows they match
(fiscal exits, payments, the freight field, order totals). They enter as match counts:
a sum over repeated rows is the sum over the rows, each times its count.

Items are reduced to ids, amounts and counts before any name is looked up. A line's group is a group of its items, one
of its document's rows and one of its product's rows, and all its sums are products of those of the three, so the
three are grouped apart, each at its own grain, and joined; no row of names is grouped at the grain of lines.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.fixed_values import DIRECT_SALE_PARTNER, TAXPAYER_DEFAULT
from ledgerline.functions import money
from ledgerline.functions.labels import code_label
from ledgerline.operators.attributes import fields_per_sale
from ledgerline.operators.filters import listed, listed_or_null, on_day, recent_or_modified, since
from ledgerline.operators.joins import lookup, matches_per_key, role, times
from ledgerline.operators.tables import coerce_numbers, lower_names, union_by_name
from ledgerline.operators.windows import near_keys, of_keys, within_keys
from ledgerline.params import RunParams
from ledgerline.plans import parts
from ledgerline.sources.marks import mark_value
from ledgerline.sources.readers import Cut, Tables, keep_lazy

NUMERIC_COLUMNS = (
    "goods_cost", "net_value", "unit_value", "freight", "list_cost", "other_expenses", "tax_difference",
    "channel_commission",
)


def _billed(column: str, params: RunParams, day: date | None) -> Column:
    """Billed in the window, and on the day if one is given."""
    window = since(F.col(column), params.billing_start)
    return window if day is None else window & on_day(F.col(column), day)


def documents_in_window(tables: Tables, params: RunParams, mark: date | Column, day: date | None = None) -> DataFrame:
    """Billable documents of the window (or of one day of it) with their fiscal data and their sale, if any."""
    codes = params.codes
    documents = tables["document"].where(
        _billed("issue_date", params, day) & listed(F.col("status"), codes.document_status)
    )
    ids = documents.select("document_id")
    fiscal = (
        within_keys(tables["document_fiscal"], "document_id", ids)
        .where(listed_or_null(F.col("operation_nature"), codes.invoice_natures))
        .select("document_id", "carrier_id", "destination_code")
    )
    sales = tables["sale"].select(
        "sale_id",
        "modified_at",
        "order_id",
        "order_type_id",
        "payment_form_id",
        "payment_term_id",
        F.col("customer_id").alias("sale_customer_id"),
        F.lit(True).alias("is_known"),
    )
    found = documents.join(fiscal, "document_id")
    found = lookup(found, within_keys(tables["document_sale"], "document_id", ids), "document_id")
    found = lookup(found, sales, "sale_id", spread_by=["document_id"])
    return found.where(
        recent_or_modified(F.col("issue_date"), F.col("modified_at"), params.recent_start, mark)
    ).select(
        "document_id", "issue_date", "document_number", "customer_id", "company_id", "address_id", "carrier_id",
        "destination_code", F.when(F.col("is_known"), F.col("sale_id")).alias("sale_id"), "modified_at", "order_id", "order_type_id",
        "payment_form_id", "payment_term_id", "sale_customer_id",
    )


def payments_per_sale(tables: Tables, sales: DataFrame) -> DataFrame:
    """Per sale: how many payment rows it is repeated for, and their term value."""
    documents = (
        tables["payment_document"]
        .where(F.col("payment_document_id").isNotNull())
        .groupBy("payment_document_id")
        .agg(F.count(F.lit(1)).alias("documents"), F.sum("term_value").alias("document_terms"))
    )
    payments = of_keys(tables["sale_payment"], "sale_id", sales, few=True)
    payments = lookup(payments, documents, "payment_document_id", spread_by=["sale_id"])
    return payments.groupBy("sale_id").agg(
        F.sum(times(F.col("documents"))).alias("payment_rows"), F.sum("document_terms").alias("sale_terms")
    )


def _with_sale_fields(
    rows: DataFrame, tables: Tables, params: RunParams, sales: DataFrame, spread_by: Sequence[str] = ()
) -> DataFrame:
    """Add the sale's total, its two shown extra fields and how many rows the fields stand for.

    A shown field gives one row per different value; ``field_rows`` counts equal values, and
    those of the freight field, which is not shown.
    """
    codes = params.codes
    shown = {"traffic_source": codes.traffic_pattern, "prospect_customer": codes.prospect_pattern}
    values = of_keys(tables["attribute_value"], "sale_id", sales, few=True)
    fields = fields_per_sale(tables["attribute_type"], values, shown, {"freight": codes.sale_freight_pattern})
    totals = near_keys(within_keys(tables["sale_total"], "sale_id", sales), "sale_id", sales)
    rows = lookup(rows, totals, "sale_id", spread_by=spread_by)
    rows = lookup(rows, fields, "sale_id", spread_by=spread_by)
    for name in shown:
        rows = rows.withColumn(f"_{name}", F.explode_outer(name)).drop(name)
    counts = [*[F.col(f"_{name}.n") for name in shown], F.col("freight_rows")]
    rows = rows.withColumns({"field_rows": times(*counts), **{name: F.col(f"_{name}.value") for name in shown}})
    return rows.drop("freight_rows", *[f"_{name}" for name in shown])


def _with_parties(
    rows: DataFrame, tables: Tables, key: str, order_ids: DataFrame, of_order: DataFrame | None = None
) -> DataFrame:
    """Add carrier, order, partner, customer and tax kind. Customer and tax record are required, the others are not."""
    party = tables["party"]
    rows = parts.with_name(rows, party, "carrier_id", "carrier", [key])
    rows = parts.with_order_and_partner(rows, tables, [key], order_ids, of_order)
    rows = rows.join(tables["customer_tax"], "customer_id")
    return rows.join(role(party, "party_id", "customer_id", customer="name"), "customer_id")


def _with_address(rows: DataFrame, tables: Tables) -> DataFrame:
    return rows.join(tables["address"].select("address_id", "neighbourhood", "city_id"), "address_id")


def _with_small_tables(rows: DataFrame, tables: Tables, params: RunParams) -> DataFrame:
    """Add what small tables name: company (required), city, state, order type and payment. Last, as names are long."""
    rows = rows.join(role(tables["company"], "company_id", "company_id", company="trade_name"), "company_id")
    rows = parts.with_city(rows, tables)
    order_types = parts.labelled_order_types(tables, params.codes.labelled_order_type)
    rows = lookup(rows, order_types, "order_type_id")
    rows = parts.with_name(rows, tables["payment_form_sales"], "payment_form_id", "payment_form")
    return parts.with_name(rows, tables["payment_term"], "payment_term_id", "payment_term")


def _shown_labels(params: RunParams) -> dict[str, Column]:
    return {
        "partner": F.coalesce(F.col("order_partner"), F.col("order_type"), F.lit(DIRECT_SALE_PARTNER)),
        "taxpayer_kind": code_label(F.col("taxpayer_code"), params.codes.taxpayer_labels, TAXPAYER_DEFAULT),
        "orders": F.lit(1).cast("bigint"),
        "sale_value": money.in_units(F.col("sale_document_total")),
    }


# What a document's or a sale's rows show, in both datasets.
_DOCUMENT_KEYS = (
    "order_date", "order_partner", "order_type", "company", "carrier", "traffic_source", "prospect_customer", "state",
    "city", "neighbourhood", "customer", "payment_form", "payment_term", "sale_document_total", "taxpayer_code",
    "seller", "order_identifier", "modified_at",
)
_PRODUCT_KEYS = ("sku", "product_name", "list_cost", "product_group", "maker")

_SHOWN = (
    "billing_date", "order_date", "partner", "product_group", "sku", "product_name", "net_value", "unit_value",
    "other_expenses", "company", "goods_cost", "list_cost", "orders", "sold_quantity", "document_number", "carrier",
    "freight", "traffic_source", "prospect_customer", "state", "city", "neighbourhood", "customer", "maker",
    "payment_form", "payment_term", "sale_value", "taxpayer_kind", "destination", "tax_difference", "term_value",
    "line_count", "seller", "order_identifier", "modified_at",
)


def _product_rows(tables: Tables) -> DataFrame:
    """Different rows of names per product, with how many rows of the products and makers each stands for."""
    named = parts.products_with_maker(tables).select("product_id", *_PRODUCT_KEYS)
    return named.groupBy("product_id", *_PRODUCT_KEYS).agg(F.count(F.lit(1)).alias("product_rows"))


def invoice_lines(
    tables: Tables, params: RunParams, mark: date | Column, cut: Cut = keep_lazy, day: date | None = None,
    shown: Sequence[str] = _SHOWN,
) -> DataFrame:
    """Invoice lines of the window, or of one day of it, with the columns of ``shown``.

    Lines are told apart by their values, not by item id: equal lines of one document become
    one row. ``sold_quantity`` is the product's quantity on the whole document, unpriced lines
    included, and repeats on each differing line.
    """
    base = cut(documents_in_window(tables, params, mark, day))
    document_ids = base.select("document_id")
    sale_ids = base.select("sale_id").where(F.col("sale_id").isNotNull())

    # What is looked up by one key follows one another, what adds little comes first, and what adds rows late.
    order_ids = base.select("order_id").where(F.col("order_id").isNotNull())
    documents = _with_parties(base, tables, "document_id", order_ids)
    documents = lookup(documents, payments_per_sale(tables, sale_ids), "sale_id", spread_by=["document_id"])
    documents = _with_sale_fields(documents, tables, params, sale_ids, ["document_id"])
    documents = _with_address(documents, tables)
    documents = parts.with_seller(documents, tables, "sale_customer_id", ["document_id"])
    # Dealt by the document here, by which the rows are grouped and joined behind it.
    exits = of_keys(tables["document_exit"], "document_id", document_ids, few=True)
    documents = documents.join(matches_per_key(exits, "document_id", "exits"), "document_id")
    documents = _with_small_tables(documents, tables, params)
    # Each (document, sale) row stands for this many rows of the full join.
    without_payments = times(F.col("exits"), F.col("field_rows"))
    documents = documents.groupBy(
        "document_id", "issue_date", "document_number", "destination_code", *_DOCUMENT_KEYS
    ).agg(
        F.sum(without_payments * times(F.col("payment_rows"))).alias("document_rows"),
        F.sum(money.repeated(F.col("sale_terms"), without_payments, 4)).alias("document_terms"),
    )

    items = of_keys(tables["document_item"], "document_id", document_ids, few=True)
    sold = tables["sale_item"].select("sale_item_id", "goods_cost", "item_expenses")
    priced = lookup(items.where(F.col("unit_price") > 0), sold, "sale_item_id", spread_by=["document_id", "item_id"])
    # Grouped once dealt by the product.
    lines = priced.join(_product_rows(tables), "product_id").groupBy(
        "document_id", "product_id", "quantity", "unit_price", "discount", "item_freight", "recipient_tax", "goods_cost",
        *_PRODUCT_KEYS, "product_rows",
    ).agg(
        F.count(F.lit(1)).alias("items"),
        F.count("item_id").alias("known_items"),
        F.sum(money.repeated(money.in_units(F.col("item_expenses")), F.lit(1))).alias("item_expenses"),
    )
    if "sold_quantity" in shown:  # of all items, so each line has its one quantity
        quantities = items.groupBy("document_id", "product_id").agg(F.sum("quantity").alias("product_quantity"))
        lines = lines.join(quantities, ["document_id", "product_id"])
    else:
        lines = lines.withColumn("product_quantity", F.lit(None).cast("decimal(28,4)"))
    lines = lines.join(documents, "document_id")
    repeats = F.col("document_rows") * F.col("product_rows")
    grouped = lines.withColumns(
        {
            "expenses": money.repeated(F.col("item_expenses"), repeats),
            "terms": money.repeated(F.col("document_terms"), F.col("items") * F.col("product_rows"), 4),
            "line_count": F.col("known_items") * repeats,
        }
    )
    line = (F.col("quantity"), F.col("unit_price"), F.col("discount"))
    return grouped.withColumns(
        {
            **_shown_labels(params),
            "billing_date": F.col("issue_date"),
            "document_number": F.col("document_number").cast("string"),
            "net_value": money.net_line(*line),
            "unit_value": money.net_unit(*line),
            "other_expenses": F.coalesce(F.col("expenses"), F.lit(0)),
            "sold_quantity": money.rounded_count(F.col("product_quantity")),
            "freight": money.cents_to_units(F.col("item_freight")),
            "destination": code_label(F.col("destination_code"), params.codes.destination_labels),
            "tax_difference": money.cents_to_units(F.col("recipient_tax")),
            "term_value": money.cents_to_units(F.col("terms")),
        }
    ).select(*shown)


def direct_sale_lines(
    tables: Tables, params: RunParams, mark: date | Column, cut: Cut = keep_lazy, day: date | None = None,
    shown: Sequence[str] = _SHOWN,
) -> DataFrame:
    """Lines of finished sales of the direct-sale project, of the window or of one day of it, with the columns of ``shown``.

    The freight is the sale's whole freight and repeats on every line.
    """
    codes = params.codes
    base = cut(
        tables["sale"].where(
            _billed("sale_date", params, day)
            & recent_or_modified(F.col("sale_date"), F.col("modified_at"), params.recent_start, mark)
            & (F.col("situation") == codes.sale_situation)
            & (F.col("project_id") == codes.sale_project)
            & F.col("sale_id").isNotNull()  # such a sale has no items
        ).select(
            "sale_id", "sale_date", "customer_id", "company_id", "address_id", "carrier_id", "order_id",
            "order_type_id", "payment_form_id", "payment_term_id", "sale_freight", "modified_at",
        )
    )
    sale_ids = base.select("sale_id")
    # Order totals are reached through the order, so those of unknown orders count for nothing.
    order_ids = base.select("order_id").where(F.col("order_id").isNotNull())
    order_totals = matches_per_key(of_keys(tables["order_total"], "order_id", order_ids, few=True), "order_id", "order_totals")

    sales = _with_parties(base, tables, "sale_id", order_ids, order_totals)
    # The customer is known, so there is no null to spread.
    sales = parts.with_seller(sales, tables, "customer_id", [])
    sales = _with_address(sales, tables)
    # Dealt by the sale here, by which the rows are grouped and joined behind it.
    sales = _with_sale_fields(sales, tables, params, sale_ids)
    sales = _with_small_tables(sales, tables, params)
    sales = sales.groupBy("sale_id", "sale_date", "sale_freight", *_DOCUMENT_KEYS).agg(
        F.sum(times(F.col("order_totals"), F.col("field_rows"))).alias("sale_rows")
    )

    line = (F.col("quantity"), F.col("unit_price"), F.col("discount"))
    once = F.lit(1)
    items = of_keys(tables["sale_item"], "sale_id", sale_ids, few=True)
    sums = {
        "net_value": (money.net_line(*line), 8),
        "unit_value": (money.net_unit(*line), 10),
        "other_expenses": (money.in_units(F.col("item_expenses")), 8),
    }
    lines = items.groupBy("sale_id", "product_id", "goods_cost").agg(
        *[F.sum(money.repeated(amount, once, scale)).alias(name) for name, (amount, scale) in sums.items()],
        F.count("sale_item_id").alias("line_count"),
    )
    # Products of one name are one line of each of the sale's rows. They meet once dealt by the sale.
    lines = lines.join(_product_rows(tables), "product_id").join(sales, "sale_id")
    grouped = lines.groupBy("goods_cost", *_PRODUCT_KEYS, *sales.columns).agg(
        *[F.sum(money.repeated(F.col(n), F.col("product_rows"), scale)).alias(n) for n, (_, scale) in sums.items()],
        F.sum(F.col("line_count") * F.col("product_rows")).alias("line_count"),
    ).withColumns(
        {
            **{n: money.repeated(F.col(n), F.col("sale_rows"), scale) for n, (_, scale) in sums.items()},
            "line_count": F.col("line_count") * F.col("sale_rows"),
        }
    )
    return grouped.withColumns(
        {
            **_shown_labels(params),
            "billing_date": F.col("sale_date"),
            "document_number": F.col("sale_id").cast("string"),
            "sold_quantity": F.lit(None).cast("bigint"),
            "freight": money.in_units(F.col("sale_freight")),
            "destination": F.lit(None).cast("string"),
            "tax_difference": F.lit(None).cast("decimal(22,8)"),
            "term_value": F.lit(0).cast("decimal(22,8)"),
        }
    ).select(*shown)


def billing(
    tables: Tables,
    params: RunParams,
    mark: date | Column | None = None,
    cut: Cut = keep_lazy,
    day: date | None = None,
    shown: Sequence[str] = _SHOWN,
) -> DataFrame:
    """Invoice and direct-sale lines together, numbers filled with 0.

    Without a given mark the sales' own high-water mark is used. With ``day`` only that billing day's lines are made: the
    documents and sales of other days are left out before ``cut``, past which no filter on the lines reaches. ``shown``
    names the columns wanted; the lines are the same rows, told apart by all their values, whichever are shown.
    """
    if mark is None:
        mark = mark_value(tables["sale"], params)
    lines = union_by_name(
        invoice_lines(tables, params, mark, cut, day, shown), direct_sale_lines(tables, params, mark, cut, day, shown)
    )
    return coerce_numbers(lower_names(lines), NUMERIC_COLUMNS)
