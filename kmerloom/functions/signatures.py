"""Minimizer signatures of k-mers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sequences import packed, reverse_complement, windows


def allowed(mmer: Column) -> Column:
    """False for m-mers that would make overfull bins: low-complexity starts and ends, or AA inside."""
    return ~(mmer.rlike("(TTT|TGT|TT.)$") | mmer.rlike("^.+AA") | mmer.rlike("^(AAA|ACA)"))


def normalised(mmer: Column, m: int) -> Column:
    """The smaller packed value of the m-mer and its reverse complement, of those that are allowed; 4^m if none is."""
    rc = reverse_complement(mmer)
    forward = F.when(allowed(mmer), packed(mmer, m))
    backward = F.when(allowed(rc), packed(rc, m))
    return F.coalesce(F.least(forward, backward), F.lit(4**m))


def signatures(kmers: DataFrame, m: int, kmer: str = "kmer") -> DataFrame:
    """``(kmer, signature)``: the smallest normalised m-mer of each distinct k-mer."""
    if not 5 <= m <= 11:
        raise ValueError(f"signatures have 5 to 11 bases, not {m}")
    cut = windows(kmers.select(kmer, F.col(kmer).alias("seq")), m, kmer="mmer")
    # A few million distinct m-mers at most: each is normalised where it stands.
    return cut.groupBy(kmer).agg(F.min(normalised(F.col("mmer"), m)).alias("signature"))
