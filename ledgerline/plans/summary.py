"""Daily summary as report lines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import fixed_values as fv
from ledgerline.functions.texts import format_brl, format_brl_cents, format_day, format_quantity
from ledgerline.operators.day_states import DayStates
from ledgerline.operators.filters import on_day
from ledgerline.operators.totals import bucket_totals, totals_by_entry

LOCATION_SCHEMA = "position int, key string, location_name string, bucket string, side string"
STOCK_MEASURES = {"quantity": "available_quantity", "amount": "total_value"}


def report_locations(spark: SparkSession, rows: Sequence[tuple] = fv.REPORT_LOCATIONS) -> DataFrame:
    """The configured report locations; ``position`` is the report order."""
    return spark.createDataFrame([(at, *row) for at, row in enumerate(rows)], LOCATION_SCHEMA)


# What the loads of billing and returns keep by day, so that the report reads no line.
BILLING_STATES = DayStates("billing_date", "document_number", ("net_value", "freight", "other_expenses"))
RETURN_STATES = DayStates("issue_date", "document_number", ("net_value", "freight"))


def daily_totals(lines: DataFrame, day_column: str, day: date, amounts: Sequence[str]) -> DataFrame:
    """One row: distinct documents of a day and the sum of their amounts.

    A line with a null in any of the amounts adds nothing.
    """
    per_line = F.col(amounts[0])
    for name in amounts[1:]:
        per_line = per_line + F.col(name)
    return lines.where(on_day(F.col(day_column), day)).agg(
        F.count_distinct("document_number").alias("orders"), F.sum(per_line).alias("total")
    )


def billing_totals(billing: DataFrame, day: date) -> DataFrame:
    return daily_totals(billing, BILLING_STATES.day, day, BILLING_STATES.amounts)


def return_totals(returns: DataFrame, day: date) -> DataFrame:
    return daily_totals(returns, RETURN_STATES.day, day, RETURN_STATES.amounts)


def stock_by_location(stock: DataFrame, locations: DataFrame, measures: Mapping[str, str] = STOCK_MEASURES) -> DataFrame:
    """Every configured location with its stock, 0 where there is none."""
    return totals_by_entry(locations, stock, {"location_name": "location"}, measures)


def stock_bucket_totals(by_location: DataFrame) -> DataFrame:
    """One line per location in a bucket, and one total per side."""
    reported = by_location.where(F.col("side").isNotNull())
    return bucket_totals(
        reported, {"quantity": "quantity", "amount": "amount"}, ["side", "bucket", "position", "key"], ["side"]
    )


def _order_lines(totals: DataFrame, section: str, first: int, labels: tuple[str, str]) -> DataFrame:
    """Two report lines of a one-row total: the order count and the amount, in units."""
    orders = F.coalesce(F.col("orders"), F.lit(0)).cast("double")
    amount = F.coalesce(F.col("total").cast("double"), F.lit(0.0))
    no_number = F.lit(None).cast("double")

    def line(offset: int, key: str, label: str, quantity: Column, money: Column, text: Column) -> Column:
        return F.struct(
            F.lit(first + offset).alias("position"),
            F.lit(section).alias("section"),
            F.lit(key).alias("key"),
            quantity.alias("quantity"),
            money.alias("amount"),
            F.concat(F.lit(f"{label}: "), text).alias("text"),
        )

    return totals.select(
        F.inline(
            F.array(
                line(0, "orders", labels[0], orders, no_number, format_quantity(orders)),
                line(1, "total", labels[1], no_number, amount, format_brl(amount)),
            )
        )
    )


def _stock_lines(by_location: DataFrame, first: int) -> DataFrame:
    """Lines per location in report order, each side followed by its total; amounts in cents."""
    totals = stock_bucket_totals(by_location)
    side_label = F.lit(None).cast("string")
    for side, label in fv.SUMMARY_TOTALS.items():
        side_label = F.when(F.col("side") == side, F.lit(label)).otherwise(side_label)
    label = F.when(F.col("is_total"), F.coalesce(side_label, F.col("side"))).otherwise(F.col("key"))
    # A side's total stands behind the last line of that side.
    last = totals.where(~F.col("is_total")).groupBy("side").agg(F.max("position").alias("last_position"))
    placed = totals.join(last, "side", "left")
    position = F.when(F.col("is_total"), F.col("last_position") * 2 + 1).otherwise(F.col("position") * 2)
    quantity, amount = F.col("quantity").cast("double"), F.col("amount").cast("double")
    return placed.select(
        (position + first).alias("position"),
        F.coalesce(F.col("bucket"), F.col("side")).alias("section"),
        F.when(F.col("is_total"), F.lit("total")).otherwise(F.col("key")).alias("key"),
        quantity.alias("quantity"),
        amount.alias("amount"),
        F.concat(
            label, F.lit(": "), format_quantity(quantity), F.lit(f" {fv.SUMMARY_UNITS} | "), format_brl_cents(amount)
        ).alias("text"),
    )


STOCK_POSITION = 4  # of the first stock line; each location takes two positions


def headings(locations: DataFrame, run_date: date) -> DataFrame:
    """Titles (level 0) and section headings (level 1), at the position of the first line below them."""
    first = F.min("position") * 2 + STOCK_POSITION
    buckets = locations.where(F.col("side").isNotNull()).groupBy(F.col("bucket").alias("section"))
    stock = buckets.agg(first.cast("int").alias("position"))
    day = F.concat(F.lit(" - "), format_day(F.lit(run_date)))

    def title(position: int, key: str) -> Column:
        text = F.concat(F.lit(fv.SUMMARY_TITLES[key]), day)
        return F.struct(
            F.lit(position).alias("position"), F.lit(0).alias("level"), F.lit(key).alias("section"), text.alias("text")
        )

    def heading(position: Column, section: Column) -> Column:
        texts = F.create_map(*[F.lit(x) for item in fv.SUMMARY_SECTIONS.items() for x in item])
        text = F.coalesce(texts[section], section)
        return F.struct(position.alias("position"), F.lit(1).alias("level"), section.alias("section"), text.alias("text"))

    # One row per bucket; the fixed headings come with an aggregate over all of them.
    fixed = F.array(
        title(0, "orders"),
        heading(F.lit(0), F.lit("billing")),
        heading(F.lit(2), F.lit("returns")),
        title(STOCK_POSITION, "stock"),
    )
    always = locations.agg(F.count(F.lit(1)).alias("locations")).select(F.inline(fixed))
    return always.unionByName(stock.select(F.inline(F.array(heading(F.col("position"), F.col("section"))))))


def report_lines(
    billed: DataFrame, returned: DataFrame, stock: DataFrame, locations: DataFrame, run_date: date
) -> DataFrame:
    """``lines_of_totals`` (level 2) with titles and section headings; sort by ``position`` and ``level``."""
    lines = lines_of_totals(billed, returned, stock, locations, run_date).withColumn("level", F.lit(2))
    above = headings(locations, run_date).withColumn("report_day", format_day(F.lit(run_date)))
    return lines.unionByName(above, allowMissingColumns=True)


def summary_lines(
    billing: DataFrame, returns: DataFrame, stock: DataFrame, locations: DataFrame, run_date: date
) -> DataFrame:
    """The daily report of billing and return lines."""
    return lines_of_totals(
        billing_totals(billing, run_date), return_totals(returns, run_date), stock, locations, run_date
    )


def lines_of_totals(
    billed: DataFrame, returned: DataFrame, stock: DataFrame, locations: DataFrame, run_date: date
) -> DataFrame:
    """The daily report of one-row totals: ``position, section, key, quantity, amount, text, report_day``.

    Sort by ``position`` for the report order. Billing amounts are units, stock amounts cents.
    """
    orders = _order_lines(billed, "billing", 0, (fv.SUMMARY_BILLED_ORDERS, fv.SUMMARY_BILLED_TOTAL))
    back = _order_lines(returned, "returns", 2, (fv.SUMMARY_RETURNED_ORDERS, fv.SUMMARY_RETURNED_TOTAL))
    held = _stock_lines(stock_by_location(stock, locations), STOCK_POSITION)
    return orders.unionByName(back).unionByName(held).withColumn("report_day", format_day(F.lit(run_date)))
