"""Session settings for the jobs, and the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime SQL settings the plans count on. Joins are left to Catalyst and AQE: the
# broadcast decision follows measured sizes, and hot partitions of a join are split
# even where the split costs one more exchange.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


# A shuffle partition of this size sorts in memory on a few-GB task share.
SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_partitions_for(shuffled_bytes: int, minimum: int = 200) -> int:
    """Shuffle partitions for the largest expected shuffle; AQE joins the ones that stay small."""
    return max(minimum, -(-shuffled_bytes // SHUFFLE_PARTITION_BYTES))


def build_session(app_name: str = "ledgerline", shuffled_bytes: int | None = None) -> SparkSession:
    """Session for the jobs; master, memory and executors come from spark-submit.

    ``shuffled_bytes`` sizes the shuffles (most often the item table's size under the
    columns read); without it the submitted setting stands.
    """
    spark = configure(
        SparkSession.builder.appName(app_name)
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # The wide pipelines have more generated stages than the default cache of 100 holds.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .getOrCreate()
    )
    if shuffled_bytes is not None:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions_for(shuffled_bytes)))
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` is read from the session. A machine-local folder would
    not survive a lost executor's host, so a missing setting is an error, also in local
    mode.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        context.setCheckpointDir(shared)
    else:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
