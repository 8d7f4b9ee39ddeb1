from __future__ import annotations

import os
import sys
from datetime import date, datetime

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.session import configure  # noqa: E402
from ledgerline.sources import catalog  # noqa: E402

DATA_ROOT = "/root/testdata"
RUN = date(2024, 3, 15)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("ledgerline-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("FATAL")
    yield configure(session)
    session.stop()


def _literal(value, kind: str) -> str:
    if value is None:
        return f"CAST(NULL AS {kind})"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"CAST('{text}' AS {kind})"


def table(spark, name: str, rows: list[dict]):
    """A source table from literal rows, kept in the plan; columns not mentioned are null."""
    kinds = {column.name: column.data_type for column in catalog.columns(name)}
    unknown = {key for row in rows for key in row} - set(kinds)
    assert not unknown, unknown
    if not rows:
        return spark.sql("SELECT " + ", ".join(f"{_literal(None, kinds[c])} AS {c}" for c in kinds) + " WHERE FALSE")
    values = ", ".join("(" + ", ".join(_literal(row.get(c), kinds[c]) for c in kinds) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(kinds)})")


def retail_rows() -> dict[str, list[dict]]:
    """One product, one customer, one invoice with a sale and an order; tests change it."""
    return {
        "product": [
            {"product_id": 1, "sku": "A", "product_name": "Oven", "group_id": 5, "list_cost": 7, "cost": 6,
             "is_product": True, "is_active": True},
        ],
        "product_group": [{"group_id": 5, "name": "Ovens"}],
        "product_supplier": [
            {"product_id": 1, "party_id": 50, "principal": True},
            {"product_id": 1, "party_id": 51, "principal": False},
            {"product_id": 1, "party_id": 52, "principal": None},
        ],
        "party": [
            {"party_id": 10, "name": "Customer"}, {"party_id": 50, "name": "Maker"}, {"party_id": 51, "name": "Other"},
            {"party_id": 52, "name": "Third"}, {"party_id": 60, "name": "Seller"}, {"party_id": 70, "name": "Carrier"},
            {"party_id": 80, "name": "Partner"}, {"party_id": 90, "name": "Broker"},
        ],
        "customer_tax": [{"customer_id": 10, "taxpayer_code": 2}],
        "customer_seller": [{"customer_id": 10, "seller_id": 60, "principal": True}],
        "company": [{"company_id": 3, "trade_name": "Company"}],
        "document": [
            {"document_id": 100, "customer_id": 10, "company_id": 3, "address_id": 20, "status": 10,
             "issue_date": RUN, "document_number": 1000},
        ],
        "document_fiscal": [
            {"document_id": 100, "operation_nature": 15, "carrier_id": 70, "intermediary_id": 90,
             "intermediary_code": 1, "destination_code": 0, "document_expenses": 300, "document_value": 100,
             "order_number": "N-1"},
        ],
        "document_item": [
            {"item_id": 1, "document_id": 100, "product_id": 1, "sale_item_id": 500, "quantity": 2, "unit_price": 10,
             "discount": 150, "item_freight": 250, "recipient_tax": 40},
        ],
        "document_exit": [{"document_id": 100, "exit_freight": 400, "product_total": 20}],
        "document_sale": [{"document_id": 100, "sale_id": 200}],
        "sale": [
            {"sale_id": 200, "customer_id": 10, "company_id": 3, "address_id": 20, "order_id": 300,
             "order_type_id": 100, "payment_form_id": 1, "payment_term_id": 1, "carrier_id": 70, "situation": 5,
             "project_id": 67, "sale_date": RUN, "modified_at": datetime(2024, 3, 14, 9), "sale_freight": 900,
             "discount_pct": 0},
        ],
        "sale_item": [
            {"sale_item_id": 500, "sale_id": 200, "product_id": 1, "quantity": 2, "unit_price": 10, "discount": 150,
             "item_expenses": 100, "goods_cost": 8},
        ],
        "sale_payment": [{"sale_id": 200, "payment_document_id": 1}],
        "payment_document": [{"payment_document_id": 1, "term_value": 1850}],
        "sale_total": [{"sale_id": 200, "sale_document_total": 1850}],
        "order_total": [{"order_id": 300}],
        "order": [
            {"order_id": 300, "partner_id": 80, "order_type_id": 100, "location_id": 34, "order_date": RUN,
             "identifier": "ID-300", "situation": 2, "order_freight": 500},
        ],
        "order_type": [{"order_type_id": 100, "description": "Marketplace"}],
        "order_item": [{"order_id": 300, "product_id": 1, "quantity": 3, "unit_price": 10, "discount": 200}],
        "attribute_type": [
            {"attribute_type_id": 1, "name": "Frete especial"}, {"attribute_type_id": 2, "name": "Via Trafego?"},
            {"attribute_type_id": 3, "name": "Cliente prospectado?"},
        ],
        "attribute_value": [
            {"sale_id": 200, "attribute_type_id": 1, "value": "1.234,56"},
            {"sale_id": 200, "attribute_type_id": 2, "value": "yes"},
        ],
        "address": [{"address_id": 20, "city_id": 30, "neighbourhood": "Centre"}],
        "city": [{"city_id": 30, "state_id": 40, "name": "Town"}],
        "state": [{"state_id": 40, "code": "RJ"}],
        "payment_form_sales": [{"payment_form_id": 1, "name": "Card"}],
        "payment_form_returns": [{"payment_form_id": 1, "name": "Refund"}],
        "payment_term": [{"payment_term_id": 1, "name": "30 days"}],
        "stock_by_product": [
            {"product_id": 1, "group_id": 5, "location_id": 34, "company_id": 3, "sku": "A", "product_name": "Oven",
             "available_quantity": 4, "unit_cost": 1050},
        ],
        "stock_location": [{"location_id": 34, "name": "CD RJ - JD OLIMPO"}],
    }


@pytest.fixture
def rows():
    return retail_rows()


@pytest.fixture
def retail(spark):
    """Build all source tables from literal rows."""

    def build(rows: dict[str, list[dict]]):
        return {name: table(spark, name, rows.get(name, [])) for name in catalog.SOURCE_TABLES}

    return build
