"""Session helpers: a configured local session for bench and tools, and the settings of a large run."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "recruitflow", warehouse_dir: str | None = None) -> SparkSession:
    """Local session for tests and benchmarks (UI off, UTC, AQE on)."""
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.sql.warehouse.dir", warehouse_dir or tempfile.mkdtemp(prefix="recruitflow-wh-"))
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.driver.memory", "16g")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


TARGET_PARTITION_BYTES = 256 * 1024 * 1024


def shuffle_partitions_for(input_bytes: int, target_bytes: int = TARGET_PARTITION_BYTES,
                           minimum: int = 200) -> int:
    """Shuffle partitions so each holds about ``target_bytes`` of input."""
    return max(minimum, -(-int(input_bytes) // int(target_bytes)))


def apply_cluster_defaults(spark: SparkSession, input_bytes: int, bucketed_sources: bool = False) -> None:
    """Runtime SQL settings for a large run of the marts.

    AQE re-plans joins from measured sizes, coalesces small partitions
    and splits skewed ones (a company or candidate holding a third of
    the rows); the initial shuffle partition count is sized from the
    input so partitions fit executor memory.  With ``bucketed_sources``
    (``sources.layout``) a join on (bucket key, more keys) may reuse the
    bucketing instead of re-shuffling on all its keys: the rows already
    sit in their key's bucket, so nothing new concentrates.
    """
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES // 2),
        "spark.sql.shuffle.partitions": str(shuffle_partitions_for(input_bytes)),
        "spark.sql.files.maxPartitionBytes": str(TARGET_PARTITION_BYTES // 2),
    }
    if bucketed_sources:
        conf["spark.sql.requireAllClusterKeysForCoPartition"] = "false"
    for k, v in conf.items():
        spark.conf.set(k, v)
