"""Counts stored by k-mer: a bucketed, sorted table whose readers group and join by k-mer without a shuffle.

Rows are dealt once, when they are written, by the hash that Spark's exchanges use. Presence, matrices, annotated tables and
lookups within one store then read each bucket where it lies. New samples are appended to the same buckets.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..storage import scratch

BUCKETS = 64


def store_counts(counts: DataFrame, path: str, table: str, buckets: int = BUCKETS) -> DataFrame:
    """Write ``counts (kmer, ...)`` under ``path`` as the catalog table ``table``, and open it.

    A table that is there gets the rows of new samples; it must have as many buckets. Names of columns and their types are
    those of ``counts``. One task writes one bucket, sorted by k-mer.
    """
    spark = counts.sparkSession
    dealt = counts.repartition(buckets, "kmer")
    mode = "append" if spark.catalog.tableExists(table) else "errorifexists"
    dealt.write.bucketBy(buckets, "kmer").sortBy("kmer").option("path", path).option("compression", "zstd").mode(mode).saveAsTable(table)
    return spark.table(table)


def stored_once(counts: DataFrame, name: str, buckets: int | None = None) -> DataFrame:
    """``counts`` written under the shared folder as a table of their own: what reads them several times counts them once."""
    spark = counts.sparkSession
    own = f"kmerloom_{name}_{uuid.uuid4().hex}"
    return store_counts(counts, scratch(spark, name), own, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))


def open_counts(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)
