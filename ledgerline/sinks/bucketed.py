"""Source tables kept bucketed by the key they are joined on, under the source's names in Spark's catalog.

Documents and their items, exits and sales lie in equal buckets of the document id, sales and what hangs on them in those
of the sale id, orders in those of the order id. Read through ``readers.catalog_tables`` they meet without a shuffle:
for a window, only its documents move to the items' buckets. Small tables are written plainly.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources import catalog
from ledgerline.sources.readers import Tables

# By the key of their buckets.
BUCKETED = {
    "document_id": ("document", "document_fiscal", "document_item", "document_exit", "document_sale"),
    "sale_id": ("sale", "sale_item", "sale_payment", "sale_total", "attribute_value"),
    "order_id": ("order", "order_item", "order_total"),
}
BUCKET_KEY: Mapping[str, str] = {name: key for key, names in BUCKETED.items() for name in names}


def under_source_names(df: DataFrame, table: str) -> DataFrame:
    """The catalogued columns under the source's names."""
    return df.select(*[F.col(column.name).alias(column.source_name) for column in catalog.columns(table)])


def write_bucketed(
    spark: SparkSession, tables: Tables, database: str, buckets: int, root: str, names: Iterable[str] | None = None
) -> None:
    """Write tables to ``root`` and register them in ``database``, replacing older ones.

    ``buckets`` is best a multiple of the cores and at least the session's shuffle partitions, so that the bucketed
    side of a join is the one that stays. A bucket is written by one task, as one sorted file.
    """
    for name in tables if names is None else names:
        rows = under_source_names(tables[name], name)
        writer = rows.write
        if name in BUCKET_KEY:
            key = next(c.source_name for c in catalog.columns(name) if c.name == BUCKET_KEY[name])
            writer = rows.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
        source = catalog.source_table(name)
        writer.format("parquet").mode("overwrite").option("path", f"{root}/{source}").saveAsTable(f"{database}.{source}")
