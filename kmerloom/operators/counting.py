"""k-mer counting and set operations over long count tables ``(sample, kmer, cnt)``."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.packing import MAX_K, counted_batches
from ..functions.sequences import canonical, is_valid, unpacked, windows
from ..functions.superkmers import MAX_PAIR
from .superkmers import BINS, pair_text, superkmer_counts


#: From this length on few k-mers repeat within a batch, and stretches of reads are smaller than their k-mers.
STRETCH_K = 16


def kmers(reads: DataFrame, k: int, both_strands: bool = True) -> DataFrame:
    """One row per valid window of each read; ``both_strands``: canonical k-mers."""
    valid = windows(reads, k).where(is_valid(F.col("kmer")))
    return valid.withColumn("kmer", canonical(F.col("kmer"))) if both_strands else valid


def packed_counts(reads: DataFrame, k: int, keys: tuple[str, ...] = ("sample",), both_strands: bool = True) -> DataFrame:
    """``(keys ..., kmer, cnt)``: k-mers up to 31 as packed longs, with their numbers of occurrences.

    k-mers are counted within pieces of a batch first, then within a task, then over all tasks: one shuffle of numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return counted_batches(batches, k, both_strands)

    fields = [*(T.StructField(c, reads.schema[c].dataType) for c in keys), T.StructField("kmer", T.LongType()), T.StructField("cnt", T.LongType())]
    pieces = reads.select(*keys, "seq").mapInArrow(run, T.StructType(fields))
    return pieces.groupBy(*keys, "kmer").agg(F.sum("cnt").alias("cnt"))


def count_kmers(
    reads: DataFrame, k: int, min_count: int = 2, count_cap: int | None = None, keys: tuple[str, ...] = ("sample",), both_strands: bool = True, packed: bool = False, times: int = 1, bins: int = BINS
) -> DataFrame:
    """k-mers of each sample with at least ``min_count`` occurrences over all its reads; counts stop at ``count_cap``.

    ``times`` counts each read as often as that (2 is the low-coverage mode, in which k-mers seen once stay). ``packed``
    leaves k-mers as longs, for all that only compares them; ``unpacked`` brings them back. k-mers of 32 to 63 bases are
    counted as two numbers and come as strings, longer ones are strings throughout. ``bins``: see ``superkmer_counts``; more
    of them suit larger samples. Null and short reads have no k-mers; repeated reads count each; an empty table gives none.
    """
    if k > MAX_K:
        if packed:
            raise ValueError(f"k = {k} does not fit a signed 64-bit integer")
        if k <= MAX_PAIR:
            pairs = superkmer_counts(reads, k, 1 if times != 1 else min_count, keys, both_strands, bins=bins)
            counts = pairs.select(*keys, pair_text(k).alias("kmer"), "cnt")
        else:
            counts = kmers(reads, k, both_strands).groupBy(*keys, "kmer").agg(F.count("*").alias("cnt"))
    elif k >= STRETCH_K:
        counts = superkmer_counts(reads, k, 1 if times != 1 else min_count, keys, both_strands, bins=bins)
    else:
        counts = packed_counts(reads, k, keys, both_strands)
    if times != 1:
        counts = counts.withColumn("cnt", F.col("cnt") * times)
    counts = counts.where(F.col("cnt") >= min_count)
    if count_cap is not None:
        counts = counts.withColumn("cnt", F.least("cnt", F.lit(count_cap).cast("long")))
    return counts if packed or k > MAX_K else counts.withColumn("kmer", unpacked(F.col("kmer"), k))


def kmer_text(kmer: Column | str, k: int) -> Column:
    """A packed k-mer as text."""
    return unpacked(F.col(kmer) if isinstance(kmer, str) else kmer, k)


def repeated_rows(counts: DataFrame) -> DataFrame:
    """``(sample, kmer, n)`` of k-mers that a sample's table holds more than once: empty for a sound table."""
    return counts.groupBy("sample", "kmer").agg(F.count("*").alias("n")).where("n > 1")


def universe(counts: DataFrame) -> DataFrame:
    """The distinct k-mers of all samples."""
    return counts.select("kmer").distinct()


def union_sum(counts: DataFrame, cap: int = 1_000_000) -> DataFrame:
    """Counts summed over samples, up to ``cap``."""
    return counts.groupBy("kmer").agg(F.least(F.sum("cnt"), F.lit(cap).cast("long")).alias("cnt"))


def right_counts(everything: DataFrame, sample: DataFrame, missing: int = 1) -> DataFrame:
    """All k-mers of ``everything`` with the count of ``sample``, or ``missing``."""
    return everything.select("kmer").join(sample.select("kmer", "cnt"), "kmer", "left").select("kmer", F.coalesce("cnt", F.lit(missing).cast("long")).alias("cnt"))


def compact(counts: DataFrame) -> DataFrame:
    """k-mers without counts: each reads back as 1."""
    return universe(counts).withColumn("cnt", F.lit(1).cast("long"))


def count_range(counts: DataFrame, low: int | None = None, high: int | None = None) -> DataFrame:
    """k-mers with counts from ``low`` to ``high``, both included."""
    if low is not None:
        counts = counts.where(F.col("cnt") >= low)
    return counts if high is None else counts.where(F.col("cnt") <= high)


def database_info(counts: DataFrame, k: int, both_strands: bool = True) -> DataFrame:
    """One row per sample: k-mer length, smallest and largest count, number of k-mers, strand mode."""
    found = counts.groupBy("sample").agg(F.min("cnt").alias("min_count"), F.max("cnt").alias("max_count"), F.count("*").alias("total_kmers"))
    return found.withColumn("kmer_length", F.lit(k)).withColumn("both_strands", F.lit(both_strands))


class CountRange:
    """The inclusive count range of a database: a bound is set only inside the original range and the other bound."""

    def __init__(self, low: int, high: int) -> None:
        self.original = (low, high)
        self.low, self.high = low, high

    def set_low(self, low: int) -> bool:
        if not self.original[0] <= low <= self.high:
            return False
        self.low = low
        return True

    def set_high(self, high: int) -> bool:
        if not self.low <= high <= self.original[1]:
            return False
        self.high = high
        return True

    def reset(self) -> None:
        self.low, self.high = self.original
