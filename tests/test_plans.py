"""What the physical plans must and must not hold."""

from __future__ import annotations

import os
import re
from contextlib import contextmanager

import pytest
from checking import QUERIES
from conftest import DATA_ROOT
from pyspark.sql import functions as F

from ledgerline.operators import joins, loads
from ledgerline.plans import orders
from ledgerline.sources.readers import keep_lazy
from ledgerline.starmart import queries as registered

FOLDER = f"{DATA_ROOT}/sf0.001"
NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@contextmanager
def settings(spark, **values):
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@needs_data
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pair_joins_and_no_python(spark, name):
    with settings(spark, **NO_BROADCAST):
        text = plan(QUERIES[name](spark, FOLDER))
    assert not re.search(r"CartesianProduct|NestedLoop|EvalPython|InPandas|InArrow", text)


@needs_data
@pytest.mark.parametrize("name", ["invoice_lines", "returns_lines", "snapshot_stock", "delta_upsert"])
def test_no_join_is_forced_to_broadcast(spark, name):
    with settings(spark, **NO_BROADCAST):
        assert "Broadcast" not in plan(QUERIES[name](spark, FOLDER))


@needs_data
@pytest.mark.parametrize(
    "name", ["invoice_lines", "direct_sale_lines", "order_lines", "target_window", "scan_param_window"]
)
def test_windows_reach_the_scan(spark, monkeypatch, name):
    monkeypatch.setattr(registered, "cut", keep_lazy)
    assert "GreaterThanOrEqual(o_orderdate," in plan(QUERIES[name](spark, FOLDER))


@needs_data
def test_scans_read_only_needed_columns(spark):
    text = plan(QUERIES["total_qty_per_item"](spark, FOLDER))
    schemas = set(re.findall(r"ReadSchema: struct<([^>]*)>", text))
    assert all("l_extendedprice" not in schema and "l_shipdate" not in schema for schema in schemas)


def test_null_keys_are_spread_over_the_shuffle(spark):
    left = spark.range(20000).select(
        "id", F.when(F.col("id") % 3 == 0, F.col("id")).alias("key"), F.lit("x").alias("more")
    )
    right = spark.range(0, 20000, 6).select(F.col("id").alias("key"), F.col("id").alias("found"))
    with settings(spark, **NO_BROADCAST, **{"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        joined = joins.lookup(left, right, "key", spread_by=["id"])
        rows = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert joined.count() == 20000
        assert joined.where("found IS NOT NULL").count() == 20000 // 6 + 1
        plain = left.join(right, "key", "left").groupBy(F.spark_partition_id().alias("p")).count().collect()
    # Two thirds of the rows have no key: together in one partition by a plain join, spread by ours.
    assert max(row["count"] for row in plain) > 13000
    assert max(row["count"] for row in rows) < 8000


def test_hot_keys_are_split_by_aqe(spark):
    left = spark.range(400_000).select("id", F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("key"))
    right = spark.range(400_000).select(F.col("id").alias("key"), F.col("id").alias("found"))
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "32",
    }
    with settings(spark, **NO_BROADCAST, **small):
        # Grouping by the join's own key: without the forced split the hot partition would stay whole.
        grouped = joins.lookup(left, right, "key").groupBy("key").agg(
            F.count("found").alias("n"), F.sum(F.xxhash64("id") % 1000).alias("s")
        )
        assert grouped.agg(F.max("n")).first()[0] == 400_000 // 3 + 2
        grouped.collect()
        assert "skew=true" in plan(grouped)
        kept = loads.rows_outside(left, right.select("key").where("key > 10"), ["key"])
        kept.collect()
        assert "skew=true" in plan(kept)


def test_grouped_rows_are_combined_before_the_shuffle(spark):
    rows = spark.range(1000).select((F.col("id") % 2).alias("key"), F.col("id").alias("day"), F.lit("x").alias("text"))
    text = plan(loads.last_per_key(rows, ["key"], ["day"]))
    assert text.index("partial_max") > text.index("Exchange hashpartitioning")
    assert "Window" not in text


def test_last_rows_of_keys_that_are_never_null_meet_on_them_without_another_exchange(spark):
    rows = spark.range(0, 100, 1, 4).select(F.col("id").alias("order_id"), F.lit("x").alias("order_date"))
    with settings(spark, **NO_BROADCAST, **{"spark.sql.adaptive.enabled": "false"}):
        latest = loads.last_per_key(rows, ["order_id"], ["order_date"])
        met = joins.lookup(latest, latest.withColumnRenamed("order_date", "before"), ["order_id"])
        found = plan(met)
        assert met.count() == 100
    assert "Union" not in found and found.count("Exchange hashpartitioning") <= 2


def test_the_key_of_an_order_line_is_never_null(spark):
    lines = orders.order_lines(registered.retail_tables(spark, FOLDER), registered.WHOLE)
    assert not any(lines.schema[key].nullable for key in orders.ORDER_KEY)


def test_a_side_dealt_by_its_key_is_not_dealt_again_where_null_keys_are_spread(spark):
    left = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, F.col("id")).alias("key"))
    right = spark.range(1000).groupBy((F.col("id") % 400).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    with settings(spark, **NO_BROADCAST, **{"spark.sql.adaptive.enabled": "false"}):
        joined = joins.lookup(left, right, "key", spread_by=["id"])
        assert plan(joined).count("Exchange hashpartitioning") == 2
        assert joined.count() == 1000 and joined.where("n IS NOT NULL").count() == 134


@pytest.mark.parametrize("kind", ["bigint", "string", "decimal(20,0)"])
def test_a_null_key_matches_nothing_not_even_what_stands_in_for_it(spark, kind):
    left = spark.range(50).select("id", F.lit(None).cast(kind).alias("key"), F.lit(1).cast("bigint").alias("other"))
    right = spark.range(50).select(F.xxhash64("id").cast(kind).alias("key"), F.lit(1).cast("bigint").alias("other"), F.lit("x").alias("found"))
    for keys in (["key"], ["key", "other"], ["other", "key"]):
        kept = right.select(*keys, "found") if len(keys) > 1 else right.select("key", "found")
        assert joins.lookup(left, kept, keys, spread_by=["id"]).where("found IS NOT NULL").count() == 0
        assert joins.lookup(left, kept.drop("found"), keys, "left_anti", spread_by=["id"]).count() == 50


def test_the_days_states_keep_only_the_columns_they_need(spark, monkeypatch):
    made = []
    monkeypatch.setattr(registered, "cut", lambda df: (made.append(df.columns), df)[1])
    with pytest.MonkeyPatch.context() as patched:
        patched.setattr(registered.PartitionedTable, "replace_by_key", lambda *_: 0)
        patched.setattr(registered.PartitionedTable, "states", lambda *_: spark.createDataFrame([], registered.day_states.STATE_SCHEMA))
        QUERIES["daily_billing_states"](spark, FOLDER)
    assert set(made[-1]) == {"order_identifier", "sku", *registered.summary.BILLING_STATES.columns}
