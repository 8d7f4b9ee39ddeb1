"""What the operators of this package share: reliable checkpoints, and rows carried beside their id and text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

FIRST_ID = -(1 << 63)
BATCH_BYTES = 4 << 20


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use ``spark.checkpoint.dir``; where it is unset, as in tests, a folder in the warehouse, which is shared too."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(shared or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints")


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder, for tables written on the way."""
    ensure_checkpoint_dir(spark)
    return spark.sparkContext.getCheckpointDir()


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared file system that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def small_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Rows go to Python workers some MB at a time, which Spark and the worker each hold in memory, not 64 MB.

    A setting of the session, as a lazy result's plan is made only when it is read.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written once in the shared folder: its lineage is cut, and lost executors lose nothing of it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row`` (all columns, whatever their names), document id (null as the first of all), text, and a hash of the
    text, by which rows that share an id but not the text are told apart. ``uid`` is what rows are dealt by: the id, or
    where it is null, the text's hash."""
    text = F.col(f"`{text_col}`").cast("string")
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(FIRST_ID)).alias("did"),
        F.xxhash64(text).alias("th"),
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.xxhash64(text)).alias("uid"),
        text.alias("text"),
    )


def with_row(prepared: DataFrame, added: str) -> StructType:
    """The schema of ``row`` and the added columns."""
    return StructType([prepared.schema["row"], *StructType.fromDDL(added).fields])


def unpacked(df: DataFrame, columns: list[str], **replaced) -> DataFrame:
    """The columns of ``row`` again, some of them replaced."""
    return df.select(*[replaced[c].alias(c) if c in replaced else F.col(f"row.`{c}`").alias(c) for c in columns])
