"""Return lines of one day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.fixed_values import NO_INTERMEDIARY, UNKNOWN_INTERMEDIARY
from ledgerline.functions import money
from ledgerline.functions.labels import code_label, code_or_name
from ledgerline.functions.texts import parse_locale_decimal
from ledgerline.operators.attributes import attribute_values
from ledgerline.operators.filters import listed, other_than
from ledgerline.operators.joins import lookup, role, times
from ledgerline.operators.tables import coerce_numbers, lower_names
from ledgerline.operators.windows import of_keys, within_keys
from ledgerline.params import RunParams
from ledgerline.plans import parts
from ledgerline.sources.readers import Cut, Tables, keep_lazy

NUMERIC_COLUMNS = (
    "goods_cost", "net_value", "unit_value", "freight", "extra_freight", "list_cost", "other_expenses",
)


def returned_documents(tables: Tables, params: RunParams) -> DataFrame:
    """Return documents of the run date without a project or outside the excluded one.

    The two kinds are read in one pass; ``without_project`` keeps them apart later.
    """
    codes = params.codes
    project = F.col("project_id")
    documents = tables["document"].where(
        (F.col("issue_date") == F.lit(params.run_date))
        & listed(F.col("status"), codes.document_status)
        & (project.isNull() | other_than(project, codes.return_excluded_project))
    )
    ids = documents.select("document_id")
    fiscal = within_keys(tables["document_fiscal"], "document_id", ids)
    fiscal = fiscal.where(F.col("operation_nature") == codes.return_nature).drop("operation_nature")
    sales = tables["sale"].select(
        "sale_id", "order_id", "payment_form_id", "payment_term_id", "discount_pct",
        F.col("sale_id").alias("known_sale_id"),
    )
    found = documents.withColumn("without_project", project.isNull()).join(fiscal, "document_id")
    found = lookup(found, within_keys(tables["document_sale"], "document_id", ids), "document_id")
    found = lookup(found, sales, "sale_id", spread_by=["document_id"])
    return found.drop("sale_id").withColumnRenamed("known_sale_id", "sale_id")


def freight_fields_per_sale(tables: Tables, params: RunParams, sales: DataFrame) -> DataFrame:
    """Per sale: how many freight field values it has, and their sum as a number."""
    pattern = params.codes.return_freight_pattern
    values = of_keys(tables["attribute_value"], "sale_id", sales, few=True)
    return (
        attribute_values(tables["attribute_type"], values, pattern, "freight")
        .groupBy("sale_id")
        .agg(
            F.count(F.lit(1)).alias("freight_fields"),
            F.sum(parse_locale_decimal(F.col("freight"))).alias("sale_freight"),
        )
    )


def exits_per_document(tables: Tables, documents: DataFrame) -> DataFrame:
    """Per document: how many fiscal exits it has, and the sums of their freight rates and goods shares.

    A line's parts are linear in both, so lines need not be joined to the single exits.
    """
    values = documents.select("document_id", "document_value").distinct()
    return (
        within_keys(tables["document_exit"], "document_id", values)
        .join(values, "document_id")
        .groupBy("document_id")
        .agg(
            F.count(F.lit(1)).alias("exits"),
            F.sum(money.freight_rate(F.col("exit_freight"), F.col("product_total"))).alias("freight_rate"),
            F.sum(money.goods_share(F.col("document_value"), F.col("exit_freight"))).alias("goods_share"),
        )
    )


def return_lines(tables: Tables, params: RunParams, cut: Cut = keep_lazy) -> DataFrame:
    """Return lines: summed value, freight share and extra freight by document and product names."""
    base = cut(returned_documents(tables, params))
    sale_ids = base.select("sale_id").where(F.col("sale_id").isNotNull())
    spread_by = ["document_id"]

    documents = base.join(exits_per_document(tables, base), "document_id")
    documents = lookup(documents, freight_fields_per_sale(tables, params, sale_ids), "sale_id", spread_by=spread_by)
    documents = documents.join(role(tables["party"], "party_id", "customer_id", customer="name"), "customer_id")
    documents = documents.join(parts.places(tables), "address_id")
    orders = tables["order"].select("order_id", "order_date")
    documents = lookup(documents, orders, "order_id", spread_by=spread_by)
    documents = parts.with_name(documents, tables["payment_form_returns"], "payment_form_id", "payment_form")
    documents = parts.with_name(documents, tables["payment_term"], "payment_term_id", "payment_term")
    documents = parts.with_name(documents, tables["party"], "carrier_id", "carrier", spread_by)
    documents = parts.with_name(documents, tables["party"], "intermediary_id", "intermediary", spread_by)

    products = parts.products_with_maker(tables).select(
        "product_id", "sku", "product_name", "list_cost", "cost", "product_group", "maker"
    )
    # Items are reduced to sums per document and product first: all shares are linear in these.
    line = (F.col("quantity"), F.col("unit_price"), F.col("discount"))
    items = of_keys(tables["document_item"].where(F.col("unit_price") > 0), "document_id", base.select("document_id"), few=True)
    items = items.groupBy("document_id", "product_id").agg(
        F.sum(money.net_line(*line)).alias("net"),
        F.sum(money.net_unit(*line)).alias("unit"),
        F.sum("quantity").alias("quantity"),
        F.sum(money.goods_before_discount_pct(*line)).alias("goods"),
        F.count(F.lit(1)).alias("items"),
    )
    lines = items.join(products, "product_id").join(documents, "document_id")
    # A line repeats for every exit and every freight field value; the freight shares depend on
    # these rows only through the sums made before.
    fields = times(F.col("freight_fields"))
    repeats = times(F.col("exits")) * fields
    share = money.freight_share(F.col("net"), F.col("freight_rate"), fields)
    extra = money.extra_freight_share(
        F.col("goods"), F.col("discount_pct"), F.col("goods_share"), F.coalesce(F.col("sale_freight"), F.lit(0))
    )
    grouped = lines.groupBy(
        "issue_date", "order_date", "intermediary_code", "intermediary", "product_group", "sku", "product_name",
        "document_expenses", "cost", "list_cost", "document_number", "carrier", "state", "city", "neighbourhood",
        "customer", "maker", "payment_form", "payment_term", "order_number", "company_id", "without_project",
    ).agg(
        F.sum(money.repeated(F.col("net"), repeats)).alias("net_value"),
        F.sum(money.repeated(F.col("unit"), repeats, 10)).alias("unit_value"),
        F.sum(repeats * F.col("items")).alias("orders"),
        money.rounded_count(F.sum(money.repeated(F.col("quantity"), repeats, 4))).alias("sold_quantity"),
        F.sum(share).alias("freight"),
        F.sum(extra).alias("extra_freight"),
    )
    return grouped.select(
        "issue_date",
        "order_date",
        code_or_name(
            F.col("intermediary_code"), F.col("intermediary"), NO_INTERMEDIARY, UNKNOWN_INTERMEDIARY
        ).alias("partner"),
        "product_group",
        "sku",
        "product_name",
        "net_value",
        "unit_value",
        money.in_units(F.col("document_expenses")).alias("other_expenses"),
        F.col("cost").alias("goods_cost"),
        "list_cost",
        "orders",
        "sold_quantity",
        "document_number",
        "carrier",
        "freight",
        "extra_freight",
        "state",
        "city",
        "neighbourhood",
        "customer",
        "maker",
        "payment_form",
        "payment_term",
        F.col("order_number").alias("order_identifier"),
        code_label(F.col("company_id"), params.codes.company_labels).alias("company"),
    )


def returns(tables: Tables, params: RunParams, cut: Cut = keep_lazy) -> DataFrame:
    """Return lines ready to load, numbers filled with 0."""
    return coerce_numbers(lower_names(return_lines(tables, params, cut)), NUMERIC_COLUMNS)
