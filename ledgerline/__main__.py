"""``spark-submit``-able jobs: ``python -m ledgerline {general,orders,alert} ...``."""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from ledgerline.params import Codes, RunParams
from ledgerline.plans.jobs import alert_job, general_job, load_orders, open_targets
from ledgerline.session import build_session
from ledgerline.sources.readers import JdbcSource, SplitRead, Tables, catalog_tables, jdbc_tables, parquet_tables


def read_codes(path: str | None) -> Codes:
    """Codes with the values of a JSON file in place of the defaults."""
    if path is None:
        return Codes()
    with open(path, encoding="utf-8") as file:
        values = json.load(file)
    for name, value in values.items():
        if isinstance(value, list):
            values[name] = tuple(value)
        elif isinstance(value, dict):
            values[name] = {int(code): label for code, label in value.items()}
    return Codes(**values)


def read_jdbc(url: str, path: str | None) -> JdbcSource:
    """The database with the properties and split reads of a JSON file."""
    if path is None:
        return JdbcSource(url)
    with open(path, encoding="utf-8") as file:
        values = json.load(file)
    splits = {table: SplitRead(**split) for table, split in values.get("splits", {}).items()}
    return JdbcSource(url, values.get("properties", {}), splits)


def open_source(spark: SparkSession, source: str, jdbc: str | None = None) -> Tables:
    """``jdbc:...`` is a database, ``catalog:<database>`` Spark's catalog, else a parquet folder."""
    if source.startswith("jdbc:"):
        return jdbc_tables(spark, read_jdbc(source, jdbc))
    if source.startswith("catalog:"):
        return catalog_tables(spark, source.removeprefix("catalog:") or None)
    return parquet_tables(spark, source)


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="ledgerline", description=__doc__)
    parser.add_argument("job", choices=("general", "orders", "alert"))
    parser.add_argument("--source", required=True, help="parquet folder, jdbc:... or catalog:<database>")
    parser.add_argument("--targets", help="folder of the target tables (general, orders)")
    parser.add_argument("--run-date", type=date.fromisoformat, default=None, help="default: today, UTC")
    parser.add_argument("--run-id", help="names this load; give the same one to finish a broken load")
    parser.add_argument("--codes", help="JSON file with codes that differ from the defaults")
    parser.add_argument("--jdbc", help="JSON file with reader properties and split reads of large tables")
    parser.add_argument("--shuffled-bytes", type=int, default=None, help="size of the largest expected shuffle")
    return parser.parse_args(argv)


def _print_lines(report: DataFrame, order_by: Sequence[str]) -> None:
    """Print a report; it has one row per configured location or watched product."""
    for row in report.orderBy(*order_by).collect():
        print(json.dumps(row.asDict(recursive=True), default=str, ensure_ascii=False))


def main(argv: Sequence[str] | None = None) -> None:
    arguments = _arguments(argv)
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    params = RunParams(arguments.run_date or now.date(), codes=read_codes(arguments.codes))
    run_id = arguments.run_id or f"{arguments.job}-{now:%Y%m%dT%H%M%S}"
    spark = build_session("ledgerline", arguments.shuffled_bytes)
    tables = open_source(spark, arguments.source, arguments.jdbc)
    if arguments.job == "alert":
        items, groups, header = alert_job(spark, tables, now)
        _print_lines(header, ["headline"])
        _print_lines(groups, ["location", "product_name"])
        return
    if arguments.targets is None:
        raise SystemExit("--targets is needed")
    targets = open_targets(spark, arguments.targets)
    if arguments.job == "orders":
        print(json.dumps({"orders": load_orders(tables, targets.orders, params, run_id)}))
        return
    counts, report = general_job(spark, tables, targets, params, run_id)
    print(json.dumps(counts))
    _print_lines(report, ["position", "level"])


if __name__ == "__main__":
    main()
