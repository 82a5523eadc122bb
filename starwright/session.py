"""Session settings the library relies on. The master is never set here."""

from __future__ import annotations

from pyspark.sql import SparkSession

# ANSI mode stays at Spark's default (on): typed staging must fail loudly.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # Rows reach a task's partition files unsorted, up to so many; beyond that they are sorted.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


SHUFFLE_PARTITION_BYTES = 2 * 1024**3
MOST_SHUFFLE_PARTITIONS = 20_000


def prepare(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Apply the run-time settings above to an existing session.

    UTC matters for results (epoch conversion, calendar parts); the adaptive
    settings matter for skew: joins split hot partitions and rebalanced writes
    split hot partition values. AQE merges small shuffle partitions but does
    not cut large ones in general, so for large inputs ``input_bytes`` sets how
    many to start from: one for each 2 GiB of input, 20,000 at most. With
    50,000 map tasks that is 10^9 blocks, some 150 kB of sizes a map task and
    2 GB before compression on the driver; beyond it, 100 TB make 5 GB
    partitions, of which a shuffle of some columns holds a fraction and spills
    the rest. A cluster that needs more sets the option itself.
    """
    if input_bytes is not None:
        wanted = min(-(-input_bytes // SHUFFLE_PARTITION_BYTES), MOST_SHUFFLE_PARTITIONS)
        partitions = max(wanted, int(spark.conf.get("spark.sql.shuffle.partitions")))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", partitions)
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark
