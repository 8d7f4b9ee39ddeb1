"""The same checks on data in which one order, part, supplier and customer hold a third of all rows.

The hot order keeps only some of its payments: the checking SQL joins every item of a sale with
every payment of it, which the Spark queries do not do.
"""

from __future__ import annotations

import os

import pytest
from checking import QUERIES, connect, differences
from conftest import DATA_ROOT
from pyspark.sql import functions as F

from ledgerline.starmart.mapping import star_tables

SOURCE = f"{DATA_ROOT}/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    if not os.path.isdir(SOURCE):
        pytest.skip("no test data")
    target = str(tmp_path_factory.mktemp("skewed"))
    tables = dict(star_tables(spark, SOURCE))
    # An order that every dataset accepts, and the customer, part and supplier given to a third of the rows.
    hot = tables["orders"].where("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AND o_custkey % 10 = 0").first()
    third = F.pmod(F.xxhash64("l_orderkey", "l_partkey", "l_extendedprice"), F.lit(3)) == 0
    lineitem = tables["lineitem"]
    for column, value in (("l_orderkey", hot.o_orderkey), ("l_partkey", 7), ("l_suppkey", 3)):
        lineitem = lineitem.withColumn(f"hot_{column}", F.when(third, F.lit(value)).otherwise(F.col(column)))
    paying = "(l_linenumber = 1 AND l_tax = 0) OR (l_linenumber = 2 AND l_discount = 0)"
    lineitem = lineitem.withColumns(
        {
            "hot_l_returnflag": F.when(
                third & (F.col("l_returnflag") == "A") & ~F.expr(paying), F.lit("R")
            ).otherwise(F.col("l_returnflag")),
            "hot_l_linestatus": F.when(
                third & F.expr("l_linenumber = 2 AND l_tax <> 0.01"), F.lit("O")
            ).otherwise(F.col("l_linestatus")),
        }
    )
    tables["lineitem"] = lineitem.select(
        *[
            F.col(f"hot_{field.name}" if f"hot_{field.name}" in lineitem.columns else field.name)
            .cast(field.dataType)
            .alias(field.name)
            for field in tables["lineitem"].schema.fields
        ]
    )
    crowd = F.pmod(F.xxhash64("o_orderkey"), F.lit(3)) == 0
    tables["orders"] = tables["orders"].withColumn(
        "o_custkey", F.when(crowd, F.lit(hot.o_custkey)).otherwise(F.col("o_custkey"))
    )
    for name, df in tables.items():
        df.write.parquet(f"{target}/{name}.parquet")
    return target


@pytest.fixture(scope="module")
def connection(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_on_skewed_data(spark, connection, folder, name):
    _, only_spark, only_sql = differences(spark, connection, folder, name)
    assert (only_spark, only_sql) == ([], [])
