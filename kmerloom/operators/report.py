"""Ranking, top groups, FASTA records and depth of tested k-mers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.parsing import six_digits
from ..storage import written
from .matrix import count_arrays

CELLS = ("a", "b", "c", "d")


def top_groups(tested: DataFrame, n: int = 9) -> DataFrame:
    """The ``n`` first groups of k-mers with one p-value and table, by p-value, with their sizes."""
    groups = tested.groupBy("pval", *CELLS).agg(F.count("*").alias("n_kmers"))
    return groups.orderBy("pval", *CELLS).limit(n)


def ranked(tested: DataFrame, feature: str = "kmer") -> DataFrame:
    """``tested`` with ``p6``, the p-value in six digits, and ``rank`` by it, ties in the order of the feature.

    Rows are range-partitioned by p and feature, numbered within partitions where they stand, and partitions by running
    sums of their sizes: however few p-values there are, no task has more than its range of both. Digits are formatted
    once for each distinct p-value.
    """
    digits = tested.select("pval").distinct().withColumn("p6", six_digits("pval"))
    order = [F.col("p6").cast("double"), F.col(feature)]
    # Written once: numbers must not change with a second sampling of the ranges.
    placed = written(tested.join(digits, "pval").repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_at", 33).alias("_part")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition.
    bases = placed.groupBy(part).agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    numbered = placed.withColumn("_part", part).join(bases, "_part")
    return numbered.withColumn("rank", F.col("_base") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1).drop("_at", "_part", "_base")


def fasta_records(ranked_: DataFrame, feature: str = "kmer") -> DataFrame:
    """``(rank, name, seq)`` with names ``kmer<rank>_pval_<p>``."""
    return ranked_.select("rank", F.concat(F.lit("kmer"), F.col("rank"), F.lit("_pval_"), F.col("p6")).alias("name"), F.col(feature).alias("seq"))


def annotated(tested: DataFrame, counts: DataFrame, samples: list[str], missing: int = 0) -> DataFrame:
    """``tested`` with ``counts``, an array of every sample's count in the given order: the input row after its test.

    Only counts of tested k-mers are gathered, one array for each.
    """
    own = counts.join(tested.select("kmer"), "kmer", "left_semi")
    return tested.join(count_arrays(own, samples, missing), "kmer")


def mean_depth(counts: DataFrame) -> DataFrame:
    """Each sample's mean count over its k-mers with counts above 1."""
    return counts.where("cnt > 1").groupBy("sample").agg(F.avg("cnt").alias("mean_depth"))
