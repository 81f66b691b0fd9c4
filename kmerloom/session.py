"""Sessions for local runs; on a cluster, the settings are the cluster's."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with adaptive execution, UTC and a checkpoint folder of its own."""
    scratch = tempfile.mkdtemp(prefix="spark-kmerloom-")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("kmerloom")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", f"file://{scratch}/checkpoints")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.local.dir", f"{scratch}/local")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
