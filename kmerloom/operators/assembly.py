"""Compaction of k-mers into contigs (unitigs) with iterative joins.

Nodes are k-mers in both orientations; u goes to v where the last k-1 bases of u are the first of v. A link is kept where
it is the only one out of u and the only one into v, and where v is not u's own reverse complement. Chains of kept links
are spelled out once, in the smaller orientation. This is this library's own definition of assembly, without error
correction or bubble removal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sequences import canonical, is_valid, reverse_complement, windows
from ..storage import written

PIECE = 4096


def _kept(df: DataFrame) -> DataFrame:
    """Each round is computed once: what it gives is written, and the next one reads that."""
    return written(df, "assembly")


def unitigs(kmers: DataFrame, k: int, min_length: int | None = None) -> DataFrame:
    """``(seq, n_kmers)``: the contigs of distinct canonical ``kmers (kmer)``, at least ``min_length`` long (default k).

    Cycles are cut before their smallest k-mer. Chains are ranked by doubling, so that the number of joins grows with the
    logarithm of the longest chain. An empty table gives no contigs.
    """
    own = kmers.select("kmer").where(F.col("kmer").isNotNull() & ~F.col("kmer").rlike("[^ACGT]")).distinct()
    nodes = own.select(F.col("kmer").alias("u")).union(own.select(reverse_complement(F.col("kmer")).alias("u"))).distinct()
    nodes = _kept(nodes)
    out = nodes.select("u", F.substring("u", 2, k - 1).alias("overlap"))
    into = nodes.select(F.col("u").alias("v"), F.substring("u", 1, k - 1).alias("overlap"))
    # At most four nodes share an overlap on each side.
    links = out.join(into, "overlap").select("u", "v")
    only_out = links.groupBy("u").agg(F.count("*").alias("n"), F.first("v").alias("v")).where("n = 1").select("u", "v")
    only_in = links.groupBy("v").agg(F.count("*").alias("n")).where("n = 1").select("v")
    chain = only_out.join(only_in, "v", "left_semi").where((F.col("u") != F.col("v")) & (F.col("v") != reverse_complement(F.col("u"))))
    chain = _kept(chain.select("u", "v"))
    heads = _cut_cycles(nodes, chain)
    # Each node knows a node before it, how far back, and doubles that until it reaches its chain's first.
    ranks = _kept(nodes.join(heads, F.col("u") == F.col("v"), "left").select(F.col("u").alias("node"), F.coalesce("prev", "u").alias("head"), F.when(F.col("prev").isNull(), 0).otherwise(1).cast("long").alias("dist")))
    while True:
        before = ranks.select(F.col("node").alias("head"), F.col("head").alias("further"), F.col("dist").alias("more"))
        ranks = _kept(ranks.join(before, "head").select("node", F.col("further").alias("head"), (F.col("dist") + F.col("more")).alias("dist"), (F.col("more") > 0).alias("moved")))
        if ranks.where("moved").isEmpty():
            break
        ranks = ranks.drop("moved")
    # A long contig is spelled in pieces by many tasks first; the last step joins one string per piece.
    base = F.struct("dist", F.substring("node", -1, 1).alias("text"))
    pieces = ranks.groupBy("head", F.floor(F.col("dist") / PIECE).alias("dist")).agg(F.array_sort(F.collect_list(base)).alias("parts"), F.count("*").alias("n"))
    pieces = pieces.select("head", "n", F.struct("dist", _joined("parts").alias("text")).alias("piece"))
    spelled = pieces.groupBy("head").agg(F.array_sort(F.collect_list("piece")).alias("parts"), F.sum("n").alias("n_kmers"))
    tail = _joined("parts")
    spelled = spelled.select(F.concat(F.col("head"), F.substring(tail, F.lit(2), F.length(tail))).alias("seq"), "n_kmers")
    once = spelled.select(F.least("seq", reverse_complement(F.col("seq"))).alias("seq"), "n_kmers").distinct()
    return once.where(F.length("seq") >= (k if min_length is None else min_length))


def iterated_unitigs(seqs: DataFrame, k: int, min_k: int = 17, step: int = 1) -> DataFrame:
    """``(seq, n_kmers)``: contigs of the sequences ``seqs (seq)`` by lengths from ``min_k`` to ``k``.

    The contigs of one length are read together with the sequences at the next. Short k-mers bridge gaps between
    sequences that overlap by less than k - 1 letters; longer ones part what short ones leave ambiguous. What no length
    gains comes out as ``unitigs`` of the last length give it. Contigs have at least k letters. Null sequences and those
    with other letters than the bases have no k-mers there; repeated ones count once; an empty table gives no contigs.
    """
    if not 1 <= min_k <= k or step < 1:
        raise ValueError(f"lengths from {min_k} to {k} by {step} are none")
    own = _kept(seqs.select("seq").where("seq is not null").distinct())
    contigs = None
    for size in [*range(min_k, k, step), k]:
        parts = own if contigs is None else own.union(contigs.select("seq"))
        cut = windows(parts, size).where(is_valid(F.col("kmer")))
        contigs = _kept(unitigs(cut.select(canonical(F.col("kmer")).alias("kmer")), size))
    return contigs


def _joined(parts: str) -> Column:
    return F.array_join(F.transform(parts, lambda p: p["text"]), "")


def _cut_cycles(nodes: DataFrame, chain: DataFrame) -> DataFrame:
    """``(v, prev)`` of the links of ``chain``, without those that close a cycle.

    A node on a cycle never comes to a first node: walking back by doubling, it sees the smallest k-mer of the cycle, in
    either orientation; the link into that k-mer goes, or out of its reverse complement.
    """
    walk = nodes.join(chain.select(F.col("v").alias("u"), F.col("u").alias("prev")), "u", "left")
    walk = walk.select(F.col("u").alias("node"), "prev", F.least("u", reverse_complement(F.col("u"))).alias("least"))
    walk = _kept(walk)
    open_ = walk.where("prev is not null").count()
    steps, total = 1, max(1, nodes.count())
    while open_ and steps < 2 * total:
        back = walk.select(F.col("node").alias("prev"), F.col("prev").alias("further"), F.col("least").alias("other"))
        walk = _kept(walk.join(back, "prev", "left").select("node", F.col("further").alias("prev"), F.least("least", F.coalesce("other", "least")).alias("least")))
        left = walk.where("prev is not null").count()
        if left == open_ and steps >= left:
            break
        open_, steps = left, steps * 2
    cyclic = walk.where("prev is not null").select(F.col("node").alias("v"), "least")
    # On the other strand the cycle is cut behind it, so that both strands spell the same contig.
    first = cyclic.where(F.col("least") == F.col("v")).select("v")
    last = cyclic.where((F.col("least") != F.col("v")) & (F.col("least") == reverse_complement(F.col("v")))).select(F.col("v").alias("u"))
    return chain.join(first, "v", "left_anti").join(last, "u", "left_anti").select("v", F.col("u").alias("prev"))
