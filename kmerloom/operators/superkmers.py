"""k-mer counting by super-k-mers: packed stretches are shuffled by signature and counted inside their bins."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.packing import MAX_K
from ..functions.sequences import unpacked
from ..functions.superkmers import LOW, MAX_PAIR, counted_stretches, cut_batches
from ..storage import written

SIGNATURE = 7
BINS = 512
#: Bins of a sample with more k-mers than this are counted in parts.
SPLIT = 1 << 24
BROADCAST_ROWS = 50_000


def superkmer_counts(reads: DataFrame, k: int, min_count: int = 1, keys: tuple[str, ...] = ("sample",), both_strands: bool = True, m: int = SIGNATURE, bins: int = BINS, split: int = SPLIT) -> DataFrame:
    """``(keys ..., kmer, cnt)``: packed k-mers with at least ``min_count`` occurrences, as ``packed_counts`` has them.

    k-mers of 32 to 63 bases are two numbers, ``high`` and ``low``, that sort as a pair; ``pair_text`` spells them.

    Reads are cut where the bin of the k-mers' signature changes. What crosses the network is one row for the stretches of
    a bin and a piece of a batch, about a byte a k-mer, and all occurrences of a k-mer meet in one bin: counts leave their
    task whole, and rare k-mers never leave it. A bin with more than ``split`` k-mers is dealt over several tasks, whose
    counts are added up. Use more ``bins`` for larger samples: a bin is held by one task, up to ``split`` k-mers.

    Null and short reads have no k-mers; repeated reads count each; null keys are keys; an empty table gives none.
    """
    if not m <= k <= MAX_PAIR:
        raise ValueError(f"k = {k} is not from {m} to {MAX_PAIR}")
    if not 5 <= m <= 11:
        raise ValueError(f"signatures have 5 to 11 bases, not {m}")
    n_keys = len(keys)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return cut_batches(batches, k, m, bins)

    def counted(least: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return counted_stretches(batches, k, both_strands, least, n_keys)

        return run

    own = [T.StructField(c, reads.schema[c].dataType) for c in keys]
    parts = T.StructType([*own, T.StructField("bin", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("sizes", T.BinaryType()), T.StructField("bases", T.BinaryType())])
    kmer = ["kmer"] if k <= MAX_K else ["high", "low"]
    out = T.StructType([*own, *(T.StructField(c, T.LongType()) for c in (*kmer, "cnt"))])
    pieces = written(reads.select(*keys, "seq").mapInArrow(cut, parts), "superkmers")
    place = [*keys, "bin"]
    sizes = pieces.groupBy(*place).agg(F.sum("n").alias("_n")).where(F.col("_n") > split)
    large = written(sizes.select(*[F.col(c).alias(f"_{c}") for c in place], F.ceil(F.col("_n") / split).cast("int").alias("_parts")), "large-bins")
    n_large = large.count()

    def dealt(rows: DataFrame, part, least: int) -> DataFrame:
        rows = rows.select(*place, part.alias("part"), "n", "sizes", "bases")
        return rows.repartition(*place, "part").sortWithinPartitions(*place, "part").mapInArrow(counted(least), out)

    if not n_large:
        return dealt(pieces, F.lit(0), min_count)
    side = F.broadcast(large) if n_large <= BROADCAST_ROWS else large
    same = F.lit(True)
    for c in place:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    whole = dealt(pieces.join(side, same, "left_anti"), F.lit(0), min_count)
    divided = dealt(pieces.join(side, same), F.pmod(F.xxhash64("sizes", "bases"), F.col("_parts")).cast("int"), 1)
    return whole.unionByName(divided.groupBy(*keys, *kmer).agg(F.sum("cnt").alias("cnt")).where(F.col("cnt") >= min_count))


def pair_text(k: int, high: str = "high", low: str = "low") -> Column:
    """A k-mer of two numbers as text."""
    # In halves: as one signed number, 2^63 has no counterpart that ``conv`` could turn back.
    bits, half = F.col(low).bitwiseXOR(F.lit(-(1 << 63))), LOW // 2
    text = [unpacked(F.shiftrightunsigned(bits, 2 * half), half), unpacked(bits.bitwiseAND(F.lit((1 << 2 * half) - 1)), half)]
    return F.concat(*([unpacked(F.col(high), k - LOW)] if k > LOW else []), *text)
