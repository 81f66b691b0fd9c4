"""The folder that driver and executors share, for tables between jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where it is unset, a session of one machine gets a folder of its own; on a cluster that is an error, since no folder
    of the driver is there for the executors.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that the driver and all executors share")
        if context.applicationId not in _LOCAL:
            _LOCAL[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="spark-kmerloom-")
        root = _LOCAL[context.applicationId]
    return root.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark)}/kmerloom/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage, and what was written outlives lost executors. Texts take about half the disk under zstd.
    """
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
