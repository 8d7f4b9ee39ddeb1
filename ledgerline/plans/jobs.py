"""The three batch jobs: general load with daily summary, order load, stock alert.

Reports end as DataFrames; delivering them and starting the jobs daily is left to the
platform. The first failing stage ends a job.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import fixed_values as fv
from ledgerline.operators import digests
from ledgerline.operators.day_states import DayStates, day_totals
from ledgerline.operators.tables import conform, project_allowlist
from ledgerline.params import RunParams
from ledgerline.plans.alert import alert_groups, alert_header, alert_items, location_styles
from ledgerline.plans.billing import billing
from ledgerline.plans.orders import ORDER_DATE, ORDER_KEY, order_lines
from ledgerline.plans.returns import returns
from ledgerline.plans.stock import stock
from ledgerline.plans.summary import BILLING_STATES, RETURN_STATES, report_lines, report_locations
from ledgerline.session import ensure_checkpoint_dir
from ledgerline.sinks.tables import PartitionedTable, SnapshotTable, ddl
from ledgerline.sources.readers import Tables, checkpointed, target_window

BILLING_KEY = ("order_identifier", "sku")
RETURN_KEY = ("document_number", "sku")
RETURN_KEY_TYPES = {"document_number": "bigint", "sku": "string"}
# A column of the stock and order targets themselves: when a row was first written, in UTC.
CREATED = (("created_at", "timestamp_ntz"),)
# The order target keeps each row's digest, by which changes are found.
ORDER_TARGET = (*fv.ORDER_COLUMNS, *CREATED, (digests.DIGEST, "binary"))
ORDER_KINDS = digests.compared_kinds(fv.ORDER_COLUMNS, ORDER_KEY, ORDER_DATE)


@dataclass(frozen=True)
class Targets:
    billing: PartitionedTable
    returns: PartitionedTable
    stock: SnapshotTable
    orders: PartitionedTable


def open_targets(spark: SparkSession, root: str) -> Targets:
    """Targets under a shared folder, the growing ones partitioned by month."""

    def monthly(name: str, columns, day: str, states: DayStates | None = None) -> PartitionedTable:
        month = F.date_format(F.col(day), "yyyy-MM")
        return PartitionedTable(spark, f"{root}/{name}", columns, "month", month, day_states=states)

    return Targets(
        billing=monthly("billing", fv.BILLING_COLUMNS, "billing_date", BILLING_STATES),
        returns=monthly("returns", fv.RETURN_COLUMNS, "issue_date", RETURN_STATES),
        stock=SnapshotTable(spark, f"{root}/stock", fv.STOCK_COLUMNS + CREATED),
        orders=monthly("orders", ORDER_TARGET, ORDER_DATE),
    )


def _month(day: date) -> str:
    """Partition name of a day in the monthly targets."""
    return day.strftime("%Y-%m")


def _created() -> dict[str, Column]:
    return {"created_at": F.to_timestamp_ntz(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()))}


def _in_shape(df: DataFrame, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """Allowed columns in the target's types, missing ones as null."""
    empty = df.sparkSession.createDataFrame([], ddl(columns))
    return conform(project_allowlist(df, columns), empty)


def load_billing(spark: SparkSession, tables: Tables, target: PartitionedTable, params: RunParams, run_id: str) -> int:
    ensure_checkpoint_dir(spark)
    batch = _in_shape(billing(tables, params, cut=checkpointed), fv.BILLING_COLUMNS)
    return target.replace_by_key(batch, run_id, BILLING_KEY)


def load_returns(spark: SparkSession, tables: Tables, target: PartitionedTable, params: RunParams, run_id: str) -> int:
    ensure_checkpoint_dir(spark)
    batch = _in_shape(returns(tables, params, cut=checkpointed), fv.RETURN_COLUMNS)
    return target.replace_by_key(batch, run_id, RETURN_KEY, RETURN_KEY_TYPES, required=["document_number"])


def load_stock(tables: Tables, target: SnapshotTable, params: RunParams) -> int:
    """Replace the snapshot; an empty position leaves the old one in place."""
    position = _in_shape(stock(tables, params), fv.STOCK_COLUMNS)
    return target.write_unless_empty(position.withColumns(_created()))


def load_orders(tables: Tables, target: PartitionedTable, params: RunParams, run_id: str) -> int:
    """Load new and changed order lines; returns how many there were."""
    source = _in_shape(order_lines(tables, params), fv.ORDER_COLUMNS)
    window = target_window(target.read(since=_month(params.order_start)), ORDER_DATE, params.order_start)
    delta = digests.new_or_changed(source, window, ORDER_KEY, ORDER_DATE, ORDER_KINDS)
    return target.upsert(delta, run_id, ORDER_KEY, defaults=_created())


def general_job(
    spark: SparkSession, tables: Tables, targets: Targets, params: RunParams, run_id: str
) -> tuple[dict[str, int], DataFrame]:
    """Billing, returns, stock, then the daily summary; returns row counts and report lines.

    The codes must name the sale freight field: invoice lines are repeated for its values.
    """
    if params.codes.sale_freight_pattern is None:
        raise ValueError("the general job needs the code sale_freight_pattern")
    counts = {
        "billing": load_billing(spark, tables, targets.billing, params, run_id),
        "returns": load_returns(spark, tables, targets.returns, params, run_id),
        "stock": load_stock(tables, targets.stock, params),
    }
    month = _month(params.run_date)
    report = report_lines(
        day_totals(targets.billing.states(since=month), params.run_date),
        day_totals(targets.returns.states(since=month), params.run_date),
        targets.stock.read(),
        report_locations(spark),
        params.run_date,
    )
    return counts, report


def alert_job(
    spark: SparkSession,
    tables: Tables,
    moment: datetime,
    products: Sequence[int] = fv.WATCHED_PRODUCTS,
    locations: Sequence[int] = fv.WATCHED_LOCATIONS,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Items, groups per location and header of the stock alert."""
    items = alert_items(tables, products, locations)
    return items, alert_groups(items, location_styles(spark)), alert_header(items, moment=moment)
