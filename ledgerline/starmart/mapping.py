"""The retail source tables as views over the star schema of the test data.

Each view is one SELECT that Spark and the checking database both read, so that a query
and its checking SQL start from the same rows. Spark runs them lazily, over whole tables.
``{table}`` is a table of the star schema.

Nulls, repeated keys, unknown keys and codes outside every list occur on purpose.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from functools import cache

from pyspark.sql import DataFrame, SparkSession

STAR_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
}

# Offsets that keep the parties' id ranges apart.
MAKER_BASE = 1_000_000_000_000
NATION_BASE = 2_000_000_000_000

_ITEM_ID = "l_orderkey * 100 + l_linenumber"
_DISCOUNT_CENTS = (
    "CASE WHEN l_discount = 0 THEN NULL"
    " ELSE CAST(CAST(FLOOR(l_discount * 10000 + 0.5) AS BIGINT) AS DECIMAL(18,4)) END"
)
# Line price in units, two decimals; one kind of line is unpriced.
_PRICE = "CASE WHEN l_linenumber = 7 AND l_linestatus = 'O' THEN 0 ELSE CAST(l_extendedprice AS DECIMAL(18,4)) END"
# Odd whole quantities: a value per unit then never lies half-way between two roundings.
_QUANTITY = "CAST(CAST(l_quantity AS BIGINT) * 2 + 1 AS DECIMAL(18,4))"
_PRIORITY = "CAST(SUBSTR(o_orderpriority, 1, 1) AS BIGINT)"
# An amount written as text with "." for thousands and "," for decimals.
_LOCALE_AMOUNT = (
    "REPLACE(REPLACE(CASE WHEN o_totalprice >= 1000"
    " THEN CAST(CAST(FLOOR(o_totalprice / 1000) AS BIGINT) AS STRING) || '#'"
    " || LPAD(CAST(CAST(o_totalprice - FLOOR(o_totalprice / 1000) * 1000 AS DECIMAL(18,2)) AS STRING), 6, '0')"
    " ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) END, '.', ','), '#', '.')"
)

VIEWS = {
    "product": """
        SELECT p_partkey AS product_id, 'SKU-' || CAST(p_partkey AS STRING) AS sku, p_name AS product_name,
               CAST(SUBSTR(p_brand, 7) AS BIGINT) AS group_id, CAST(p_retailprice AS DECIMAL(18,4)) AS list_cost,
               CAST(p_size AS DECIMAL(18,4)) AS cost,
               CASE WHEN p_size = 50 THEN NULL ELSE p_size <> 49 END AS is_product,
               p_type <> 'SMALL' AS is_active
        FROM {part}""",
    "product_group": """
        SELECT DISTINCT CAST(SUBSTR(p_brand, 7) AS BIGINT) AS group_id, p_brand AS name
        FROM {part} WHERE p_brand <> 'Brand#25'""",
    "product_supplier": f"""
        SELECT p_partkey AS product_id, {MAKER_BASE} + p_size % 10 AS party_id,
               CASE WHEN p_type = 'LARGE' AND p_size < 5 THEN NULL ELSE TRUE END AS principal FROM {{part}}
        UNION ALL
        SELECT p_partkey, {MAKER_BASE} + (p_size + 1) % 10, p_type = 'PROMO' AND p_size < 20 FROM {{part}}""",
    "party": f"""
        SELECT c_custkey AS party_id, c_name AS name FROM {{customer}}
        UNION ALL SELECT {MAKER_BASE} + s_suppkey, s_name FROM {{supplier}}
        UNION ALL SELECT {NATION_BASE} + n_nationkey, n_name FROM {{nation}}""",
    "customer_tax": """
        SELECT c_custkey AS customer_id,
               CASE c_mktsegment WHEN 'BUILDING' THEN 0 WHEN 'MACHINERY' THEN 1 WHEN 'HOUSEHOLD' THEN 2
                    WHEN 'FURNITURE' THEN 7 END AS taxpayer_code
        FROM {customer}""",
    "customer_seller": f"""
        SELECT c_custkey AS customer_id, {NATION_BASE} + c_nationkey AS seller_id,
               CASE WHEN c_acctbal > 0 THEN TRUE WHEN c_acctbal < -500 THEN NULL ELSE FALSE END AS principal
        FROM {{customer}}
        UNION ALL
        SELECT c_custkey, {NATION_BASE} + c_nationkey + 10, TRUE FROM {{customer}}
        WHERE c_mktsegment = 'AUTOMOBILE'""",
    "company": "SELECT CAST(r_regionkey + 1 AS BIGINT) AS company_id, r_name AS trade_name FROM {region}",
    "document": f"""
        SELECT o_orderkey AS document_id, o_custkey AS customer_id, {_PRIORITY} AS company_id,
               o_custkey AS address_id,
               CASE o_orderstatus WHEN 'F' THEN 10 WHEN 'O' THEN 11 ELSE 12 END AS status,
               CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '2-HIGH' THEN 34 ELSE 67 END AS project_id,
               CAST(o_orderdate AS DATE) AS issue_date, o_orderkey + 500000 AS document_number
        FROM {{orders}}""",
    "document_fiscal": f"""
        SELECT o_orderkey AS document_id,
               CASE o_custkey % 5 WHEN 0 THEN 15 WHEN 1 THEN 29 WHEN 2 THEN 19 WHEN 4 THEN 999 END AS operation_nature,
               CASE WHEN o_custkey % 7 <> 0 THEN {NATION_BASE} + o_custkey % 25 END AS carrier_id,
               {NATION_BASE} + o_custkey % 30 AS intermediary_id,
               CASE o_custkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 5 END AS intermediary_code,
               CASE o_custkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 2 ELSE 9 END AS destination_code,
               CAST(ROUND(o_totalprice) AS DECIMAL(18,4)) AS document_expenses,
               CAST(o_totalprice AS DECIMAL(18,4)) AS document_value,
               'P' || CAST(o_orderkey AS STRING) AS order_number
        FROM {{orders}}""",
    "document_item": f"""
        SELECT {_ITEM_ID} AS item_id, l_orderkey AS document_id, l_partkey AS product_id,
               CASE WHEN l_returnflag <> 'N' THEN {_ITEM_ID} END AS sale_item_id, {_QUANTITY} AS quantity,
               {_PRICE} AS unit_price, {_DISCOUNT_CENTS} AS discount,
               CAST(l_suppkey AS DECIMAL(18,4)) AS item_freight,
               CASE WHEN l_tax = 0 THEN NULL
                    ELSE CAST(CAST(FLOOR(l_tax * 100 + 0.5) AS BIGINT) AS DECIMAL(18,4)) END AS recipient_tax
        FROM {{lineitem}}""",
    "document_exit": """
        SELECT o_orderkey AS document_id, CAST(ROUND(o_totalprice / 50) AS DECIMAL(18,4)) AS exit_freight,
               CAST(o_totalprice AS DECIMAL(18,4)) AS product_total
        FROM {orders} WHERE o_totalprice > 5000
        UNION ALL
        SELECT o_orderkey, CAST(ROUND(o_totalprice / 100) AS DECIMAL(18,4)), CAST(o_totalprice AS DECIMAL(18,4))
        FROM {orders} WHERE o_orderpriority = '5-LOW'""",
    "document_sale": """
        SELECT o_orderkey AS document_id, o_orderkey AS sale_id FROM {orders}
        WHERE o_orderpriority <> '4-NOT SPECIFIED'
        UNION ALL
        SELECT o_orderkey, o_orderkey + 1 FROM {orders} WHERE o_orderpriority = '3-MEDIUM'""",
    "sale": f"""
        SELECT o_orderkey AS sale_id, o_custkey AS customer_id, {_PRIORITY} AS company_id, o_custkey AS address_id,
               CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderkey END AS order_id,
               CASE o_orderstatus WHEN 'F' THEN 100 WHEN 'O' THEN 101 END AS order_type_id,
               CASE WHEN o_custkey % 6 <> 0 THEN o_custkey % 6 END AS payment_form_id, {_PRIORITY} AS payment_term_id,
               {NATION_BASE} + o_custkey % 27 AS carrier_id,
               CASE o_orderstatus WHEN 'P' THEN 1 ELSE 5 END AS situation,
               CASE WHEN o_custkey % 2 = 0 THEN 67 ELSE 34 END AS project_id,
               CAST(o_orderdate AS DATE) AS sale_date,
               CASE WHEN o_orderpriority <> '2-HIGH' THEN o_orderdate + INTERVAL '36' HOUR END AS modified_at,
               CASE WHEN o_custkey % 8 <> 0 THEN CAST(ROUND(o_totalprice / 20) AS DECIMAL(18,4)) END AS sale_freight,
               CASE WHEN o_custkey % 9 <> 0 THEN CAST(o_custkey % 9 AS DECIMAL(18,4)) END AS discount_pct
        FROM {{orders}}""",
    "sale_item": f"""
        SELECT {_ITEM_ID} AS sale_item_id, MIN(l_orderkey) AS sale_id, MIN(l_partkey) AS product_id,
               MAX({_QUANTITY}) AS quantity, MAX({_PRICE}) AS unit_price, MAX({_DISCOUNT_CENTS}) AS discount,
               MAX(CASE WHEN l_returnflag = 'R' THEN CAST(l_suppkey * 10 AS DECIMAL(18,4)) END) AS item_expenses,
               MAX(CAST(l_suppkey AS DECIMAL(18,4))) AS goods_cost
        FROM {{lineitem}} GROUP BY {_ITEM_ID}""",
    "sale_payment": f"""
        SELECT l_orderkey AS sale_id, CASE WHEN l_tax > 0 THEN {_ITEM_ID} END AS payment_document_id
        FROM {{lineitem}} WHERE l_returnflag = 'A'""",
    "payment_document": f"""
        SELECT {_ITEM_ID} AS payment_document_id, CAST(CAST(FLOOR(l_extendedprice) AS BIGINT) AS DECIMAL(18,4)) AS term_value
        FROM {{lineitem}} WHERE l_linestatus = 'F'""",
    "sale_total": """
        SELECT o_orderkey AS sale_id, CAST(ROUND(o_totalprice) AS DECIMAL(18,4)) AS sale_document_total
        FROM {orders} WHERE o_orderstatus <> 'P'""",
    "order_total": """
        SELECT o_orderkey AS order_id FROM {orders}
        UNION ALL SELECT o_orderkey FROM {orders} WHERE o_orderstatus = 'F'""",
    "order": f"""
        SELECT o_orderkey AS order_id,
               CASE WHEN o_custkey % 3 <> 0 THEN {NATION_BASE} + o_custkey % 28 END AS partner_id,
               CAST(100 + o_custkey % 6 AS BIGINT) AS order_type_id, o_custkey % 26 AS location_id,
               CAST(o_orderdate AS DATE) AS order_date,
               CASE WHEN o_custkey % 10 <> 0 THEN 'ID-' || CAST(o_orderkey AS STRING) END AS identifier,
               CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'O' THEN 2 ELSE 5 END AS situation,
               CASE WHEN o_custkey % 4 <> 0 THEN CAST(ROUND(o_totalprice / 20) AS DECIMAL(18,4)) END AS order_freight
        FROM {{orders}}""",
    "order_type": "SELECT CAST(100 + r_regionkey AS BIGINT) AS order_type_id, r_name AS description FROM {region}",
    "order_item": f"""
        SELECT l_orderkey AS order_id, l_partkey AS product_id, {_QUANTITY} AS quantity, {_PRICE} AS unit_price,
               {_DISCOUNT_CENTS} AS discount
        FROM {{lineitem}}""",
    "attribute_type": """
        SELECT c_custkey AS attribute_type_id,
               CASE c_custkey WHEN 3 THEN 'Frete especial' WHEN 7 THEN 'FRETE ESPECIAL do pedido'
                    WHEN 11 THEN 'via trafego?' WHEN 12 THEN 'via trafego'
                    WHEN 13 THEN 'Cliente prospectado?' ELSE c_name END AS name
        FROM {customer}""",
    "attribute_value": f"""
        SELECT o_orderkey AS sale_id,
               CAST(CASE o_orderpriority WHEN '3-MEDIUM' THEN 3 ELSE 7 END AS BIGINT) AS attribute_type_id,
               CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'unused'
                    WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'O' THEN NULL ELSE {_LOCALE_AMOUNT} END AS value
        FROM {{orders}}
        UNION ALL
        SELECT o_orderkey,
               CAST(CASE WHEN o_orderstatus = 'F' THEN 11 WHEN o_orderpriority = '1-URGENT' THEN 7 ELSE 12 END AS BIGINT),
               CASE WHEN o_orderstatus = 'F' THEN o_orderpriority WHEN o_orderpriority = '1-URGENT' THEN '1.000,50'
                    ELSE 'unused' END
        FROM {{orders}} WHERE o_orderstatus <> 'P'
        UNION ALL
        SELECT o_orderkey, CAST(13 AS BIGINT), CASE o_custkey % 3 WHEN 0 THEN 'Sim' WHEN 1 THEN 'Nao' END
        FROM {{orders}} WHERE o_custkey % 4 = 1""",
    "address": """
        SELECT c_custkey AS address_id,
               CASE WHEN c_mktsegment <> 'MACHINERY' THEN CAST(c_nationkey AS BIGINT) END AS city_id,
               c_mktsegment AS neighbourhood
        FROM {customer}""",
    "city": """
        SELECT CAST(n_nationkey AS BIGINT) AS city_id, CAST(n_regionkey + 1 AS BIGINT) AS state_id, n_name AS name
        FROM {nation}""",
    "state": "SELECT CAST(r_regionkey AS BIGINT) AS state_id, SUBSTR(r_name, 1, 2) AS code FROM {region}",
    "payment_form_sales": """
        SELECT CAST(r_regionkey + 1 AS BIGINT) AS payment_form_id, 'form ' || r_name AS name FROM {region}""",
    "payment_form_returns": """
        SELECT CAST(r_regionkey + 1 AS BIGINT) AS payment_form_id, 'refund ' || r_name AS name FROM {region}""",
    "payment_term": """
        SELECT CAST(r_regionkey + 1 AS BIGINT) AS payment_term_id, 'term ' || r_name AS name FROM {region}""",
    "stock_by_product": """
        SELECT p_partkey AS product_id,
               CASE WHEN p_size = 25 THEN NULL ELSE CAST(SUBSTR(p_brand, 7) AS BIGINT) END AS group_id,
               CAST(s_nationkey AS BIGINT) AS location_id, l_suppkey AS company_id,
               'SKU-' || CAST(p_partkey AS STRING) AS sku, p_name AS product_name,
               CAST(CASE WHEN l_returnflag = 'R' THEN -CAST(l_quantity AS BIGINT) ELSE CAST(l_quantity AS BIGINT) END
                    AS DECIMAL(18,4)) AS available_quantity,
               CAST(CAST(FLOOR(p_retailprice * 100 + 0.5) AS BIGINT) AS DECIMAL(18,4)) AS unit_cost
        FROM {lineitem} JOIN {part} ON l_partkey = p_partkey JOIN {supplier} ON l_suppkey = s_suppkey""",
    "stock_location": """
        SELECT CAST(n_nationkey AS BIGINT) AS location_id, n_name AS name FROM {nation}""",
}


class Views(Mapping[str, DataFrame]):
    """Named DataFrames, each built when it is first asked for."""

    def __init__(self, names: Iterable[str], build: Callable[[str], DataFrame]):
        self._names = tuple(names)
        self._build = cache(build)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        return self._build(name)

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def star_tables(spark: SparkSession, sf_dir: str) -> Views:
    """The star schema's tables; their schema is given, so that reading starts no job."""
    return Views(
        STAR_SCHEMAS, lambda name: spark.read.schema(STAR_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")
    )


def retail_tables(spark: SparkSession, sf_dir: str) -> Views:
    """The 31 source tables as lazy views over the star schema in a folder."""
    star = star_tables(spark, sf_dir)

    def view(name: str) -> DataFrame:
        text = VIEWS[name]
        return spark.sql(text, **{table: star[table] for table in STAR_SCHEMAS if f"{{{table}}}" in text})

    return Views(VIEWS, view)


def view_sql(view: str) -> str:
    """A view's SELECT for the checking database, where the tables have their plain names."""
    return VIEWS[view].format(**{name: name for name in STAR_SCHEMAS})
