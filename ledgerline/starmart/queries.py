"""The library's operators and datasets as queries over the star schema's tables.

Every query reads whole tables and ends in plain column types: amounts as double rounded to
four places, moments as dates. Rows that several branches of a query need are cut once, as in
the jobs; everything else is lazy.
"""

from __future__ import annotations

import uuid
from collections import ChainMap
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions import labels, money, texts
from ledgerline.operators import attributes, day_states, delta, digests, filters, joins, loads, tables, windows
from ledgerline.params import Codes, RunParams
from ledgerline.plans import alert, billing, orders, parts, returns, stock, summary
from ledgerline.session import configure
from ledgerline.sinks.bucketed import write_bucketed
from ledgerline.sinks.tables import PartitionedTable, SnapshotTable
from ledgerline.sources.marks import high_water_mark
from ledgerline.sources.readers import Tables, catalog_tables, checkpointed, read_sql, target_window
from ledgerline.sources.splits import plan_splits
from ledgerline.starmart.mapping import retail_tables, star_tables

Query = Callable[[SparkSession, str], DataFrame]

RUN_DATE = date(2001, 8, 1)
# Reaches back to the first order of the data, 1995-01-01.
ALL_DAYS = 2404
MARK = date(1996, 1, 1)
YEAR_DAY = date(1997, 1, 1)
TARGET_END = date(2000, 1, 1)
BATCH_START = date(2001, 5, 1)
REPLACED_END = date(2001, 6, 1)
UNKNOWN_PROJECT = -1
ALERT_MOMENT = datetime(2001, 8, 1, 9, 5, 7)

PATTERNS = {
    "freight": "%FRETE ESPECIAL%", "traffic": "%VIA TRAFEGO?%", "prospect": "%CLIENTE PROSPECTADO?%",
}
CODES = Codes(
    sale_freight_pattern=PATTERNS["freight"],
    company_labels={1: "first", 2: "second", 4: "fourth"},
    stock_locations=tuple(range(24)),
    order_excluded_location=20,
)
PARAMS = RunParams(RUN_DATE, codes=CODES)
WHOLE = replace(PARAMS, billing_days=ALL_DAYS, order_days=ALL_DAYS)
YEAR = replace(WHOLE, run_date=YEAR_DAY, billing_days=ALL_DAYS)

WATCHED_NAMES = ("red plate", "small widget", "hot ring", "hot plate", "old rod")
WATCHED_NATIONS = (2, 5, 8, 11, 14, 17)
ALERT_CRITICAL_AT = 150
ALERT_LOW_AT = 250

_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query under its function name, without the ``q_`` of names the library uses itself."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(function(configure(spark), sf_dir))

    _QUERIES[function.__name__.removeprefix("q_")] = run
    return function


def plain(df: DataFrame) -> DataFrame:
    """Amounts as double to four places, moments as dates; other types as they are."""
    columns = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DecimalType, T.DoubleType)):
            value = F.round(value, 4).cast("double")
        elif isinstance(field.dataType, (T.TimestampNTZType, T.TimestampType)):
            value = value.cast("date")
        columns.append(value.alias(field.name))
    return df.select(*columns)


def cut(df: DataFrame) -> DataFrame:
    """The rows, computed once into the shared checkpoint folder.

    Where ``spark.checkpoint.dir`` is unset, as in tests, the folder is in the warehouse, which is shared too.
    """
    shared_folder(df.sparkSession)
    return checkpointed(df)


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, set where it is not yet."""
    if spark.sparkContext.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        spark.sparkContext.setCheckpointDir(shared or f"{warehouse}/_checkpoints")
    return spark.sparkContext.getCheckpointDir()


def star(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return star_tables(spark, sf_dir)[name]


def yearly_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The source tables with documents and sales dated to the first day of their year."""
    source = retail_tables(spark, sf_dir)

    def dated(table: str, column: str) -> DataFrame:
        return source[table].withColumn(column, F.trunc(F.col(column), "year"))

    return ChainMap({"document": dated("document", "issue_date"), "sale": dated("sale", "sale_date")}, source)


# --- sources ------------------------------------------------------------------


@query
def scan_param_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """
        SELECT l_orderkey, l_linenumber, l_partkey, CAST(o_orderdate AS DATE) AS order_day, l_quantity AS quantity
        FROM {orders} JOIN {lineitem} ON l_orderkey = o_orderkey WHERE o_orderdate >= :since"""
    source = star_tables(spark, sf_dir)
    return read_sql(
        spark, text, {name: source[name] for name in ("orders", "lineitem")}, {"since": PARAMS.billing_start}
    )


@query
def q_target_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return target_window(
        star(spark, sf_dir, "orders"), "o_orderdate", PARAMS.billing_start, ["o_orderpriority", "created_at"]
    )


@query
def q_high_water_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return high_water_mark(retail_tables(spark, sf_dir)["sale"], PARAMS)


@query
def high_water_mark_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mark of a project that no sale has: it depends on the data, and is the fallback day."""
    codes = replace(CODES, sale_project=UNKNOWN_PROJECT)
    return high_water_mark(retail_tables(spark, sf_dir)["sale"], replace(PARAMS, codes=codes))


# --- filters ------------------------------------------------------------------


@query
def incremental_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = star(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.expr("CASE WHEN l_returnflag <> 'N' THEN l_shipdate END").alias("modified")
    )
    found = joins.lookup(star(spark, sf_dir, "orders"), items, {"o_orderkey": "l_orderkey"})
    return found.where(
        filters.since(F.col("o_orderdate"), PARAMS.billing_start)
        & filters.recent_or_modified(F.col("o_orderdate"), F.col("modified"), PARAMS.recent_start, date(2001, 8, 1))
    ).select("o_orderkey", "l_linenumber", F.to_date("o_orderdate").alias("order_day"), "modified")


def _coded_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", F.nullif(F.col("l_linenumber"), F.lit(7)).alias("code")
    )


@query
def filter_in_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coded_lines(spark, sf_dir).where(filters.listed(F.col("code"), (1, 3, 3, 7)))


@query
def filter_in_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = star(spark, sf_dir, "supplier").where(F.col("s_acctbal") > 0)
    listed_twice = suppliers.unionByName(suppliers)
    lines = star(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return filters.keep_listed(lines, "l_suppkey", listed_twice, "s_suppkey")


@query
def filter_in_or_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coded_lines(spark, sf_dir).where(filters.listed_or_null(F.col("code"), (1, 3)))


@query
def filter_not_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coded_lines(spark, sf_dir).where(filters.other_than(F.col("code"), 3))


@query
def filter_flag_true(spark: SparkSession, sf_dir: str) -> DataFrame:
    product = retail_tables(spark, sf_dir)["product"]
    return product.where(filters.is_true(F.col("is_product")) & filters.is_true(F.col("is_active"))).select(
        "product_id", "sku"
    )


# --- extra fields -----------------------------------------------------------------


@query
def attribute_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attributes.attribute_codes(retail_tables(spark, sf_dir)["attribute_type"], PATTERNS)


@query
def attribute_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = retail_tables(spark, sf_dir)
    sales = source["sale"].select("sale_id")
    for role, pattern in PATTERNS.items():
        values = attributes.attribute_values(source["attribute_type"], source["attribute_value"], pattern, role)
        sales = joins.lookup(sales, values, "sale_id")
    return sales


@query
def fields_in_one_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = retail_tables(spark, sf_dir)
    shown = {name: PATTERNS[name] for name in ("traffic", "prospect")}
    counted = {"freight": PATTERNS["freight"], "unknown": None}
    fields = attributes.fields_per_sale(source["attribute_type"], source["attribute_value"], shown, counted)
    for name in shown:
        fields = fields.withColumn(name, F.explode_outer(name))
    values = [F.col(f"{name}.value").alias(name) for name in shown] + [F.col(f"{name}.n").alias(f"{name}_n") for name in shown]
    return fields.select("sale_id", *values, "freight_rows", "unknown_rows")


@query
def window_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = retail_tables(spark, sf_dir)
    documents = source["document"].where(filters.since(F.col("issue_date"), PARAMS.billing_start)).select("document_id")
    return _items_of(source["document_item"], documents)


def _items_of(items: DataFrame, documents: DataFrame) -> DataFrame:
    found = windows.of_keys(items, "document_id", documents).groupBy("document_id")
    return found.agg(F.count(F.lit(1)).alias("items"), F.sum("quantity").alias("quantity"))


@query
def bucketed_window_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``window_items`` over documents and items kept bucketed by the document."""
    name = f"bucketed_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_folder(spark)}/{name}'")
    wanted = ("document", "document_item")
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8)
    write_bucketed(spark, retail_tables(spark, sf_dir), name, buckets, f"{shared_folder(spark)}/{name}", wanted)
    kept = catalog_tables(spark, name, wanted)
    documents = kept["document"].where(filters.since(F.col("issue_date"), PARAMS.billing_start)).select("document_id")
    return _items_of(kept["document_item"], documents)


@query
def equal_depth_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items by sale item, an often-null column, read split by split: each value's rows, and in how many splits they are."""
    items = retail_tables(spark, sf_dir)["document_item"].select("sale_item_id", "item_id")
    parts = [items.where(split.predicate).withColumn("split", F.lit(i)) for i, split in enumerate(plan_splits(items, "sale_item_id", 8))]
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    return together.groupBy("sale_item_id").agg(F.count_distinct("split").alias("splits"), F.count(F.lit(1)).alias("row_count"))


# --- datasets -----------------------------------------------------------------------


@query
def invoice_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return billing.invoice_lines(retail_tables(spark, sf_dir), WHOLE, MARK, cut)


@query
def direct_sale_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return billing.direct_sale_lines(retail_tables(spark, sf_dir), WHOLE, MARK, cut)


@query
def billing_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both kinds of lines in the real window, with the sales' own mark."""
    return billing.billing(retail_tables(spark, sf_dir), PARAMS, cut=cut)


@query
def returns_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return returns.returns(yearly_tables(spark, sf_dir), YEAR, cut)


@query
def snapshot_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The new position in place of an old snapshot that has a column of its own."""
    source = retail_tables(spark, sf_dir)
    position = cut(stock.stock(source, PARAMS))
    old = position.where(F.col("available_quantity") < 0).withColumn("created_on", F.lit(RUN_DATE))
    return loads.replace_snapshot(old, position, {"created_on": F.lit(date(2001, 8, 2))})


@query
def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.order_lines(retail_tables(spark, sf_dir), WHOLE)


# --- expressions ----------------------------------------------------------------------


def _priced_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = retail_tables(spark, sf_dir)
    documents = source["document_fiscal"].select("document_id", "document_value")
    sales = source["sale"].select("sale_id", "discount_pct", "sale_freight")
    items = joins.lookup(source["document_item"], documents, "document_id")
    return joins.lookup(items, sales, {"document_id": "sale_id"})


_LINE = ("quantity", "unit_price", "discount")


@query
def net_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = [F.col(name) for name in _LINE]
    items = retail_tables(spark, sf_dir)["document_item"]
    return items.select(
        "item_id",
        "product_id",
        money.net_line(*line).alias("net_value"),
        money.net_unit(*line).alias("unit_value"),
    )


@query
def freight_proration(spark: SparkSession, sf_dir: str) -> DataFrame:
    net = money.net_line(*[F.col(name) for name in _LINE])
    rate = money.freight_rate(F.coalesce(F.col("sale_freight"), F.lit(0)), F.col("document_value"))
    share = money.freight_share(net, rate)
    return _priced_items(spark, sf_dir).groupBy("document_id").agg(F.sum(share).alias("freight"))


@query
def extra_freight(spark: SparkSession, sf_dir: str) -> DataFrame:
    share = money.extra_freight_share(
        money.goods_before_discount_pct(*[F.col(name) for name in _LINE]),
        F.col("discount_pct"),
        money.goods_share(F.col("document_value"), F.coalesce(F.col("sale_freight"), F.lit(0))),
        texts.parse_locale_decimal(F.lit("1.234,56")),
    )
    return _priced_items(spark, sf_dir).groupBy("document_id").agg(F.sum(share).alias("extra_freight"))


@query
def parse_locale_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = retail_tables(spark, sf_dir)
    values = attributes.attribute_values(
        source["attribute_type"], source["attribute_value"], CODES.return_freight_pattern, "value"
    )
    return values.select("sale_id", "value", texts.parse_locale_decimal(F.col("value")).alias("number"))


@query
def parse_locale_decimal_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = retail_tables(spark, sf_dir)["attribute_value"]
    return values.select(
        "sale_id", "attribute_type_id", texts.parse_locale_decimal(F.col("value"), strict=False).alias("number")
    )


@query
def coerce_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = star(spark, sf_dir, "part").select(
        "p_partkey",
        "p_brand",
        F.col("p_size").cast("string").alias("size"),
        F.expr(
            "CASE p_type WHEN 'SMALL' THEN '' WHEN 'LARGE' THEN 'NaN' WHEN 'PROMO' THEN NULL WHEN 'ECONOMY' THEN '12.5'"
            " ELSE CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS STRING) END"
        ).alias("price"),
    )
    return tables.coerce_numbers(part, ["p_brand", "size", "price", "absent"])


@query
def cents_to_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = F.expr("CASE WHEN o_orderstatus <> 'P' THEN CAST(ROUND(o_totalprice * 100) AS DECIMAL(18,4)) END")
    return star(spark, sf_dir, "orders").select(
        "o_orderkey", money.cents_to_units(cents).alias("units"), money.in_units(cents).alias("units_or_null")
    )


@query
def code_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = retail_tables(spark, sf_dir)
    documents = source["document"].select("document_id", "customer_id", "company_id")
    fiscal = source["document_fiscal"].select(
        "document_id", "intermediary_id", "intermediary_code", "destination_code"
    )
    rows = documents.join(fiscal, "document_id").join(source["customer_tax"], "customer_id")
    rows = parts.with_name(rows, source["party"], "intermediary_id", "intermediary")
    return rows.select(
        "document_id",
        labels.code_label(F.col("taxpayer_code"), CODES.taxpayer_labels, "CONTRIBUINTE").alias("taxpayer_kind"),
        labels.code_label(F.col("destination_code"), CODES.destination_labels).alias("destination"),
        labels.code_label(F.col("company_id"), CODES.company_labels).alias("company"),
        labels.code_or_name(F.col("intermediary_code"), F.col("intermediary"), "none", "not stated").alias("partner"),
    )


@query
def format_brl(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = F.expr("CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS DECIMAL(18,2)) END")
    cents = F.expr("CAST(ROUND(o_totalprice * 100) AS DECIMAL(18,2))")
    return star(spark, sf_dir, "orders").select(
        "o_orderkey",
        texts.format_brl(amount).alias("from_units"),
        texts.format_brl_cents(cents).alias("from_cents"),
        texts.format_quantity(amount).alias("rounded"),
        texts.format_units(amount, "UND").alias("whole"),
        texts.format_day(F.to_date("o_orderdate")).alias("day"),
    )


@query
def count_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _coded_lines(spark, sf_dir).join(
        star(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority"), "l_orderkey"
    )
    return lines.groupBy("o_orderpriority").agg(
        F.count("code").alias("codes"),
        F.count(F.lit(1)).alias("line_count"),
        F.count_distinct("l_partkey").alias("products"),
        F.sum(F.coalesce(F.col("code"), F.lit(0))).alias("sum_of_filled"),
        F.coalesce(F.sum("code"), F.lit(0)).alias("filled_sum"),
    )


# --- joins ---------------------------------------------------------------------------------


@query
def total_qty_per_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = retail_tables(spark, sf_dir)["document_item"].select("item_id", "document_id", "product_id", "quantity")
    totals = joins.with_group_total(items, ["document_id", "product_id"], "quantity", "total")
    return totals.withColumn("total", money.rounded_count(F.col("total")))


@query
def role_playing_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = star_tables(spark, sf_dir)
    sold_in = joins.role(source["nation"], "n_nationkey", "c_nationkey", customer_place="n_name")
    made_in = joins.role(source["nation"], "n_nationkey", "s_nationkey", supplier_place="n_name")
    customers = source["customer"].join(sold_in, "c_nationkey").select("c_custkey", "customer_place")
    suppliers = source["supplier"].join(made_in, "s_nationkey").select("s_suppkey", "supplier_place")
    ordered = joins.lookup(
        source["orders"].select("o_orderkey", "o_custkey"), customers, {"o_custkey": "c_custkey"}, "inner"
    )
    lines = source["lineitem"].select("l_orderkey", "l_suppkey", F.col("l_quantity").cast("decimal(18,2)").alias("q"))
    lines = joins.lookup(lines, suppliers, {"l_suppkey": "s_suppkey"}, "inner")
    placed = joins.lookup(lines, ordered, {"l_orderkey": "o_orderkey"}, "inner")
    return placed.groupBy("customer_place", "supplier_place").agg(
        F.count(F.lit(1)).alias("line_count"), F.sum("q").alias("quantity")
    )


@query
def conditional_label_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = retail_tables(spark, sf_dir)
    types = parts.labelled_order_types(source, CODES.labelled_order_type)
    return joins.lookup(source["sale"].select("sale_id", "order_type_id"), types, "order_type_id")


@query
def composite_key_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = retail_tables(spark, sf_dir)
    items = source["document_item"].select("document_id", "sale_item_id", "product_id", "quantity")
    sold = source["sale_item"].select("sale_id", "sale_item_id", F.col("goods_cost"))
    return joins.lookup(
        items, sold, {"document_id": "sale_id", "sale_item_id": "sale_item_id"}, spread_by=["document_id", "product_id"]
    )


@query
def main_supplier_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parts.products_with_maker(retail_tables(spark, sf_dir)).select(
        "product_id", "sku", "product_group", "maker"
    )


@query
def existence_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that have an exit, and how often the join repeats them."""
    source = retail_tables(spark, sf_dir)
    exits = joins.matches_per_key(source["document_exit"], "document_id", "exits")
    return source["document"].select("document_id", "document_number").join(exits, "document_id")


@query
def existence_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = star_tables(spark, sf_dir)
    items = source["lineitem"].select(F.col("l_orderkey").alias("o_orderkey"))
    return source["orders"].select("o_orderkey", "o_custkey").join(items, "o_orderkey", "left_semi")


@query
def outer_then_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An outer lookup whose column a later inner join needs."""
    source = retail_tables(spark, sf_dir)
    principal = source["product_supplier"].where(filters.is_true(F.col("principal"))).drop("principal")
    products = joins.lookup(source["product"].select("product_id", "sku"), principal, "product_id")
    makers = joins.role(source["party"], "party_id", "party_id", maker="name")
    return products.join(makers, "party_id")


@query
def payment_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums and counts of sale items repeated for every payment of their sale."""
    source = retail_tables(spark, sf_dir)
    sales = source["sale"].select("sale_id")
    items = source["sale_item"].groupBy("sale_id").agg(
        F.sum("item_expenses").alias("expenses"), F.count("sale_item_id").alias("items")
    )
    rows = joins.lookup(items, billing.payments_per_sale(source, sales), "sale_id")
    repeats = joins.times(F.col("payment_rows"))
    return rows.select(
        "sale_id",
        money.repeated(F.coalesce(F.col("expenses"), F.lit(0)), repeats).alias("expenses"),
        (F.col("items") * repeats).alias("line_count"),
        F.coalesce(money.repeated(F.col("sale_terms"), F.col("items"), 4), F.lit(0)).alias("terms"),
    )


# --- loads ----------------------------------------------------------------------------------


def _dated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star(spark, sf_dir, "lineitem").select(
        F.expr("CASE WHEN l_linenumber < 7 OR l_returnflag <> 'N' THEN l_orderkey END").alias("order_code"),
        "l_partkey",
        "l_linenumber",
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
        F.to_date("l_shipdate").alias("ship_day"),
    )


def _target_and_batch(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    lines = _dated_lines(spark, sf_dir)
    target = lines.where(F.col("ship_day") < F.lit(REPLACED_END)).withColumn("origin", F.lit("target"))
    batch = lines.where(F.col("ship_day") >= F.lit(BATCH_START)).withColumn("origin", F.lit("batch"))
    return target, batch


@query
def replace_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = _target_and_batch(spark, sf_dir)
    return loads.replace_by_key(target, batch, ["order_code", "l_partkey"])


@query
def replace_by_key_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = _target_and_batch(spark, sf_dir)
    return loads.replace_by_key(target, batch, ["order_code", "l_partkey"], null_safe_keys=True)


@query
def replace_by_typed_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch holds its keys as text."""
    target, batch = _target_and_batch(spark, sf_dir)
    batch = batch.withColumns({name: F.col(name).cast("string") for name in ("order_code", "l_partkey")})
    return loads.replace_by_key(
        target, batch, ["order_code", "l_partkey"], {"order_code": "bigint", "l_partkey": "bigint"}, ["l_partkey"]
    )


@query
def empty_batch_noop(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = _target_and_batch(spark, sf_dir)
    nothing = batch.where(F.col("ship_day") > F.lit(date(2100, 1, 1)))
    replaced = loads.replace_by_key(target, nothing, ["order_code", "l_partkey"])
    return loads.replace_snapshot(replaced, nothing)


@query
def lower_case_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns named in mixed case in the source."""
    part = star(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("P_PartKey"), F.col("p_name").alias("P_NAME"), F.col("p_size").alias("p_Size")
    )
    return tables.lower_names(part)


@query
def project_allowlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    allowed = (
        ("p_name", "string"), ("absent", "string"), ("p_partkey", "int"), ("p_retailprice", "decimal(38,10)"),
        ("p_size", "bigint"),
    )
    return tables.project_allowlist(star(spark, sf_dir, "part"), allowed)


def _order_source_and_target(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All order lines, and an older target: some lines missing, some different, some texts null."""
    source = cut(orders.order_lines(retail_tables(spark, sf_dir), WHOLE))
    known = loads.last_per_key(source, orders.ORDER_KEY, [orders.ORDER_DATE])
    target = known.where(F.col("order_date") < F.lit(TARGET_END)).withColumns(
        {
            "quantity": F.expr("CASE WHEN channel = 'NATION_3' THEN quantity + 1 ELSE quantity END"),
            "order_date": F.expr("CASE WHEN channel = 'NATION_4' THEN date_sub(order_date, 1) ELSE order_date END"),
            "identifier": F.nullif(F.col("identifier"), F.lit("")),
            "created_at": F.lit(date(2001, 1, 1)),
        }
    )
    return source, target


@query
def delta_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = _order_source_and_target(spark, sf_dir)
    return delta.new_or_changed(source, target, orders.ORDER_KEY, orders.ORDER_DATE)


@query
def delta_detect_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``delta_detect`` against a target that keeps row digests: keys and digests of it are read."""
    source, target = _order_source_and_target(spark, sf_dir)
    kinds = digests.compared_kinds(_columns_of(source), orders.ORDER_KEY, orders.ORDER_DATE)
    kept = cut(digests.with_digest(target, kinds))
    return digests.new_or_changed(source, kept, orders.ORDER_KEY, orders.ORDER_DATE, kinds).drop(digests.DIGEST)


@query
def delta_empty_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = _order_source_and_target(spark, sf_dir)
    nothing = target.where(F.col("order_date") > F.lit(date(2100, 1, 1)))
    return delta.new_or_changed(source, nothing, orders.ORDER_KEY, orders.ORDER_DATE)


@query
def delta_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = _order_source_and_target(spark, sf_dir)
    changes = cut(delta.new_or_changed(source, target, orders.ORDER_KEY, orders.ORDER_DATE))
    return loads.apply_latest(target, changes, orders.ORDER_KEY, {"created_at": F.lit(date(2001, 8, 1))})


def _columns_of(df: DataFrame) -> tuple[tuple[str, str], ...]:
    return tuple((field.name, field.dataType.simpleString()) for field in df.schema.fields)


def _written(df: DataFrame, day: str) -> PartitionedTable:
    """An empty table of such rows, by month, in a folder of its own."""
    path = f"{shared_folder(df.sparkSession)}/written-{uuid.uuid4()}"
    month = F.date_format(F.col(day), "yyyy-MM")
    return PartitionedTable(df.sparkSession, path, _columns_of(df), "month", month)


@query
def written_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``replace_by_key`` through the writer: two loads, read back."""
    target, batch = _target_and_batch(spark, sf_dir)
    table = _written(target, "ship_day")
    table.replace_by_key(target, "first", ["order_code", "l_partkey"])
    table.replace_by_key(batch, "second", ["order_code", "l_partkey"])
    return table.read()


@query
def written_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``delta_upsert`` through the writer."""
    source, target = _order_source_and_target(spark, sf_dir)
    table = _written(target, orders.ORDER_DATE)
    table.replace_by_key(target, "first", orders.ORDER_KEY)
    changes = delta.new_or_changed(source, table.read(), orders.ORDER_KEY, orders.ORDER_DATE)
    table.upsert(changes, "second", orders.ORDER_KEY, defaults={"created_at": F.lit(date(2001, 8, 1))})
    return table.read()


@query
def written_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``snapshot_stock`` through the writer."""
    position = cut(stock.stock(retail_tables(spark, sf_dir), PARAMS))
    old = position.where(F.col("available_quantity") < 0).withColumn("created_on", F.lit(RUN_DATE))
    table = SnapshotTable(spark, f"{shared_folder(spark)}/written-{uuid.uuid4()}", _columns_of(old))
    table.write_unless_empty(old)
    table.write_unless_empty(position.withColumn("created_on", F.lit(date(2001, 8, 2))))
    table.write_unless_empty(old.limit(0))
    return table.read()


@query
def last_line_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loads.last_per_key(_dated_lines(spark, sf_dir), ["order_code", "l_partkey"], ["ship_day"])


@query
def load_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = _target_and_batch(spark, sf_dir)
    return loads.load_counts(loads.counts_by_kind(target, batch, ["order_code", "l_partkey"]))


@query
def written_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by kind of a load through the writer, as counted while it wrote, and the target's rows after it."""
    target, batch = _target_and_batch(spark, sf_dir)
    table = _written(target, "ship_day")
    for run_id, rows in (("first", target), ("second", batch)):
        table.replace_by_key(rows, run_id, ["order_code", "l_partkey"])
    counts = F.explode(F.create_map(*[F.lit(x) for pair in sorted(table.counts("second").items()) for x in pair]))
    after = table.read().agg(F.count(F.lit(1)).alias("rows_after"))
    return after.select("rows_after", counts.alias("kind", "row_count"))


# --- reports ----------------------------------------------------------------------------------


def _report_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as report locations, bucketed by region, and one location without stock."""
    nations = star(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("position"),
        F.concat(F.lit("K"), F.col("n_nationkey").cast("string")).alias("key"),
        F.col("n_name").alias("location_name"),
        F.expr("CASE n_regionkey WHEN 0 THEN 'regular' WHEN 1 THEN 'fulfilment' WHEN 4 THEN NULL ELSE 'irregular' END")
        .alias("bucket"),
        F.expr("CASE n_regionkey WHEN 0 THEN 'available' WHEN 1 THEN 'available' WHEN 4 THEN NULL ELSE 'irregular' END")
        .alias("side"),
    )
    empty = spark.createDataFrame([(25, "K25", "NOWHERE", "regular", "available")], summary.LOCATION_SCHEMA)
    return nations.unionByName(empty)


@query
def daily_billing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.billing_totals(billing.billing(yearly_tables(spark, sf_dir), WHOLE, MARK, cut, YEAR_DAY), YEAR_DAY)


@query
def daily_billing_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``daily_billing_summary`` from the day states that loads keep: a first load of some keys with other amounts, one that
    replaces them and inserts the rest, and a repeated run of it."""
    what = summary.BILLING_STATES
    lines = cut(billing.billing(yearly_tables(spark, sf_dir), WHOLE, MARK, cut, shown=("order_identifier", "sku", *what.columns)))
    path = f"{shared_folder(spark)}/written-{uuid.uuid4()}"
    month = F.date_format(F.col(what.day), "yyyy-MM")
    table = PartitionedTable(spark, path, _columns_of(lines), "month", month, day_states=what)
    keys = ["order_identifier", "sku"]
    known = F.col("order_identifier").isNotNull() & F.col("sku").isNotNull()
    table.replace_by_key(lines.where(known).withColumn("net_value", F.col("net_value") + 1), "first", keys)
    for _ in range(2):
        table.replace_by_key(lines, "second", keys)
    return day_states.day_totals(table.states(), YEAR_DAY)


@query
def daily_returns_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.return_totals(returns.returns(yearly_tables(spark, sf_dir), YEAR, cut), YEAR_DAY)


@query
def stock_by_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    position = stock.stock(retail_tables(spark, sf_dir), PARAMS)
    return summary.stock_by_location(position, _report_locations(spark, sf_dir))


@query
def stock_bucket_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    position = stock.stock(retail_tables(spark, sf_dir), PARAMS)
    return summary.stock_bucket_totals(summary.stock_by_location(position, _report_locations(spark, sf_dir)))


@query
def daily_summary_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = yearly_tables(spark, sf_dir)
    return summary.summary_lines(
        billing.billing(source, WHOLE, MARK, cut, YEAR_DAY),
        returns.returns(source, YEAR, cut),
        stock.stock(source, PARAMS),
        _report_locations(spark, sf_dir),
        YEAR_DAY,
    )


@query
def daily_report_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles and section headings that ``report_lines`` puts above the lines."""
    return summary.headings(_report_locations(spark, sf_dir), YEAR_DAY)


def _alert_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alert.alert_items(
        retail_tables(spark, sf_dir),
        WATCHED_NAMES,
        WATCHED_NATIONS,
        ALERT_CRITICAL_AT,
        ALERT_LOW_AT,
        product_column="product_name",
    )


@query
def stock_alert_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alert_items(spark, sf_dir)


@query
def stock_alert_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    styles = alert.location_styles(spark, {"NATION_2": "#1e88e5", "NATION_5": "#43a047"})
    return alert.alert_groups(_alert_items(spark, sf_dir), styles)


@query
def stock_alert_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alert.alert_header(_alert_items(spark, sf_dir), moment=ALERT_MOMENT)


def queries() -> dict[str, Query]:
    return dict(_QUERIES)
