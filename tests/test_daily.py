"""One billing day of a longer window: the same lines, made from that day's documents only."""

from __future__ import annotations

from datetime import timedelta

from conftest import RUN
from pyspark.sql import functions as F
from test_billing import MARK, PARAMS

from ledgerline.operators.windows import near_keys, of_keys
from ledgerline.plans.billing import billing


def test_a_day_is_made_from_its_own_documents(retail, rows):
    earlier = RUN - timedelta(days=1)
    rows["document"].append(rows["document"][0] | {"document_id": 101, "issue_date": earlier, "document_number": 1001})
    for name in ("document_fiscal", "document_exit", "document_sale"):
        rows[name].append(rows[name][0] | {"document_id": 101})
    rows["document_item"].append(rows["document_item"][0] | {"item_id": 2, "document_id": 101})
    rows["sale"].append(rows["sale"][0] | {"sale_id": 201, "sale_date": earlier})
    rows["sale_item"].append(rows["sale_item"][0] | {"sale_item_id": 501, "sale_id": 201})
    tables, made = retail(rows), []

    def cut(df):
        made.append(df.count())
        return df

    whole = billing(tables, PARAMS, MARK)
    of_day = billing(tables, PARAMS, MARK, cut, RUN)
    assert made == [1, 1]
    expected = sorted(map(str, whole.where(F.col("billing_date") == F.lit(RUN)).collect()))
    assert sorted(map(str, of_day.collect())) == expected
    assert 0 < len(expected) < whole.count()


def test_near_keys_lose_no_row_and_drop_most_others(spark):
    rows = spark.range(-50_000, 50_000).select(F.when(F.col("id") % 7 != 0, F.col("id")).alias("key"), "id")
    keys = spark.range(-100_000, 100_000, 1000).select(F.col("id").cast("decimal(20,0)").alias("k"))
    keys = keys.unionAll(keys).unionAll(spark.sql("SELECT CAST(NULL AS DECIMAL(20,0))"))
    wanted = {r.id for r in rows.where("key % 1000 = 0").collect()}
    near = [r.id for r in near_keys(rows, "key", keys).collect()]
    assert wanted <= set(near) and len(near) == len(set(near)) < 2 * len(wanted)
    exact = of_keys(rows, "key", keys.where("k IS NOT NULL"), few=True)
    assert sorted(r.id for r in exact.collect()) == sorted(wanted)
    plan = exact._jdf.queryExecution().optimizedPlan().toString()
    assert "bit_or" in plan


def test_shown_columns_are_those_of_the_same_lines(retail, rows):
    """Lines that differ in columns that are not shown stay apart."""
    rows["document_item"].append(rows["document_item"][0] | {"item_id": 2, "recipient_tax": 77})
    rows["customer_seller"].append(rows["customer_seller"][0] | {"seller_id": 31})
    rows["party"].append(rows["party"][0] | {"party_id": 31, "name": "Another"})
    tables = retail(rows)
    shown = ("order_identifier", "sku", "net_value")
    whole = billing(tables, PARAMS, MARK).select(*shown)
    few = billing(tables, PARAMS, MARK, shown=shown)
    assert few.columns == list(shown)
    found = sorted(map(str, few.collect()))
    assert found == sorted(map(str, whole.collect())) and len(set(found)) < len(found)
