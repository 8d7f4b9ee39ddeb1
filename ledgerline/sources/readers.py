"""Load source tables by name, lazily, as ``{our table: DataFrame}``."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from datetime import date
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.filters import since
from ledgerline.sources import catalog

Tables = Mapping[str, DataFrame]


def under_our_names(df: DataFrame, table: str) -> DataFrame:
    """The catalogued columns of a source table, renamed and cast; others are never read."""
    return df.select(
        *[F.col(column.source_name).cast(column.data_type).alias(column.name) for column in catalog.columns(table)]
    )


def parquet_tables(spark: SparkSession, root: str, names: Iterable[str] = tuple(catalog.SOURCE_TABLES)) -> Tables:
    """Tables exported as ``<root>/<source table>`` parquet folders under the source's column names."""
    return {name: under_our_names(spark.read.parquet(f"{root}/{catalog.source_table(name)}"), name) for name in names}


def catalog_tables(
    spark: SparkSession, database: str | None = None, names: Iterable[str] = tuple(catalog.SOURCE_TABLES)
) -> Tables:
    """Tables registered in Spark's catalog under the source's names.

    Item and document tables bucketed by their document there are joined without a shuffle.
    """
    prefix = f"{database}." if database else ""
    return {name: under_our_names(spark.table(prefix + catalog.source_table(name)), name) for name in names}


@dataclass(frozen=True)
class SplitRead:
    """How a large table is read in parallel: ranges of a numeric or date column."""

    column: str
    lower: Any
    upper: Any
    partitions: int


@dataclass(frozen=True)
class JdbcSource:
    """A read-only database; ``splits`` names the tables to read in ranges of equal width, ``predicates`` those to read by
    predicates, such as ``splits.plan_splits`` plans for skewed columns."""

    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    splits: Mapping[str, SplitRead] = field(default_factory=dict)
    predicates: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    fetch_size: int = 10_000

    def options(self, table: str) -> dict[str, str]:
        """Reader options. Filters and column choice are pushed to the database by Spark."""
        options = {
            "url": self.url,
            "dbtable": catalog.source_table(table),
            "fetchsize": str(self.fetch_size),
            "preferTimestampNTZ": "true",
            **self.properties,
        }
        split = self.splits.get(table)
        if split is not None:
            options |= {
                "partitionColumn": split.column,
                "lowerBound": str(split.lower),
                "upperBound": str(split.upper),
                "numPartitions": str(split.partitions),
            }
        return options


# Tables that grow with the business: without a split, one task would read each through one connection.
LARGE_TABLES = (
    "document", "document_fiscal", "document_item", "document_exit", "document_sale", "sale", "sale_item",
    "sale_payment", "sale_total", "payment_document", "order", "order_item", "order_total", "attribute_value",
)


def jdbc_tables(
    spark: SparkSession, source: JdbcSource, names: Iterable[str] = tuple(catalog.SOURCE_TABLES)
) -> Tables:
    """Tables of a database; each large one must have a split."""
    names = tuple(names)
    unsplit = [n for n in LARGE_TABLES if n in names and n not in source.splits and n not in source.predicates]
    if unsplit:
        raise ValueError(f"give a split read for the large tables {', '.join(unsplit)}")
    return {name: under_our_names(_jdbc_table(spark, source, name), name) for name in names}


def _jdbc_table(spark: SparkSession, source: JdbcSource, name: str) -> DataFrame:
    options = source.options(name)
    if name not in source.predicates:
        return spark.read.format("jdbc").options(**options).load()
    rest = {key: value for key, value in options.items() if key not in ("url", "dbtable")}
    return spark.read.jdbc(source.url, options["dbtable"], predicates=list(source.predicates[name]), properties=rest)


def read_sql(spark: SparkSession, text: str, tables: Tables, params: Mapping[str, Any]) -> DataFrame:
    """Parameterised SQL over the tables: ``{table}`` names a table, ``:name`` a parameter."""
    return spark.sql(text, args=dict(params), **tables)


def target_window(target: DataFrame, date_column: str, start: date, metadata: Iterable[str] = ("created_at",)) -> DataFrame:
    """The target's rows since a day, without its metadata columns (absent names are ignored)."""
    return target.where(since(F.col(date_column), start)).drop(*metadata)


Cut = Callable[[DataFrame], DataFrame]


def keep_lazy(df: DataFrame) -> DataFrame:
    """Default for the pipelines' ``cut`` argument."""
    return df


def checkpointed(df: DataFrame) -> DataFrame:
    """``cut`` of the jobs: rows several branches need are computed once, into the checkpoint folder."""
    return df.checkpoint()
