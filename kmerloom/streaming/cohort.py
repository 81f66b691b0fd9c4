"""Incremental cohorts: new samples are counted as they arrive and added to the long count table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.counting import packed_counts

SCHEMA = "sample string, grp int, kmer long, cnt long, batch int"


def append_counts(reads: DataFrame, k: int, table: str, checkpoint: str) -> None:
    """Count the canonical k-mers of every new micro-batch of the stream ``reads`` and append them to ``table``.

    k-mers (up to 31 bases) are packed. Each batch writes its partial counts under its own number, so that a repeated batch replaces what it wrote before.
    Returns when all that was there at the start is counted.
    """

    def add(batch: DataFrame, number: int) -> None:
        counts = packed_counts(batch, k, ("sample", "grp"))
        counts.write.mode("overwrite").parquet(f"{table}/batch={number}")

    reads.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def cohort_counts(table: DataFrame, min_count: int = 2) -> DataFrame:
    """Counts of all batches, with at least ``min_count``: partial counts of a sample add up."""
    return table.groupBy("sample", "grp", "kmer").agg(F.sum("cnt").alias("cnt")).where(F.col("cnt") >= min_count)
