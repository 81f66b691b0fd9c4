"""Column functions over nucleotide sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASES = "ACGT"
#: Sequences are cut into pieces of this many windows before windows are cut out of a piece, so that the work stays linear
#: in the length of a sequence.
PIECE = 256


def reverse_complement(kmer: Column) -> Column:
    return F.reverse(F.translate(kmer, BASES, BASES[::-1]))


def canonical(kmer: Column) -> Column:
    """The smaller of a k-mer and its reverse complement."""
    return F.least(kmer, reverse_complement(kmer))


def is_valid(kmer: Column) -> Column:
    """True for upper-case k-mers of the four bases only."""
    return ~kmer.rlike("[^ACGT]")


def base_at(kmer: Column, pos: int) -> Column:
    """The base at a position from 0; null outside."""
    return F.when((F.lit(pos) >= 0) & (F.lit(pos) < F.length(kmer)), F.substring(kmer, pos + 1, 1))


def code_at(kmer: Column, pos: int) -> Column:
    """0 to 3 for the base at a position; 0 outside the k-mer."""
    return F.coalesce(F.instr(F.lit(BASES), base_at(kmer, pos)) - 1, F.lit(0))


def packed(kmer: Column, k: int) -> Column:
    """Two bits a base as a long, first base highest; for k up to 31, so that order is that of the strings."""
    if not 1 <= k <= 31:
        raise ValueError(f"k = {k} does not fit a signed 64-bit integer")
    return F.conv(F.translate(kmer, BASES, "0123"), 4, 10).cast("long")


def unpacked(value: Column, k: int) -> Column:
    """The k-mer of a packed long."""
    return F.translate(F.lpad(F.conv(value.cast("string"), 10, 4), k, "0"), "0123", BASES)


def windows(reads: DataFrame, k: int, seq: str = "seq", pos: str = "pos", kmer: str = "kmer") -> DataFrame:
    """One row per window of ``k`` symbols of each read, upper-cased, with its position from 0; other columns stay.

    Reads shorter than ``k`` and null reads have none. Windows with symbols other than the bases are kept here.
    """
    last = F.length(seq) - k
    pieces = reads.where(last >= 0).withColumn("_at", F.explode(F.sequence(F.lit(0), last, F.lit(PIECE))))
    pieces = pieces.withColumn("_piece", F.upper(F.substring(F.col(seq), F.col("_at") + 1, F.lit(PIECE + k - 1)))).drop(seq)
    cut = pieces.withColumn("_in", F.explode(F.sequence(F.lit(0), F.length("_piece") - k)))
    return cut.withColumn(pos, F.col("_at") + F.col("_in")).withColumn(kmer, F.substring(F.col("_piece"), F.col("_in") + 1, F.lit(k))).drop("_at", "_in", "_piece")


def text_to_bases(text: Column, joined: bool = False) -> Column:
    """Letters onto the four bases in turn, all else onto N, or away if ``joined``: a deterministic stand-in for reads."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    onto = "".join(BASES[i % 4] for i in range(26))
    if joined:
        return F.translate(F.lower(F.regexp_replace(text, "[^A-Za-z]", "")), letters, onto)
    return F.translate(F.lower(F.regexp_replace(text, "[^A-Za-z]", "-")), letters + "-", onto + "N")
