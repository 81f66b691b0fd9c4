import math
from fractions import Fraction
from math import comb

import pytest
from pyspark.sql import functions as F

from kmerloom.functions.statistics import fisher_exact, ln_factorial, with_fisher
from kmerloom.operators import assembly, presence, report

MATRIX = {
    "AAACG": ([3, 2, 4, 2, 5], [0, 0, 0, 0, 0]), "AACGT": ([0, 0, 0, 0, 0], [2, 2, 3, 9, 2]), "ACCTA": ([2, 2, 2, 2, 2], [2, 3, 2, 2, 2]),
    "ACGTA": ([3, 2, 2, 2, 0], [0, 0, 0, 0, 2]), "AGATC": ([7, 2, 2, 2, 2], [0, 0, 0, 2, 0]), "CCTAA": ([0, 2, 0, 2, 0], [2, 0, 2, 0, 2]),
}


def counts(spark):
    rows = [(k, g, float(c)) for k, (one, two) in MATRIX.items() for g, cs in ((1, one), (2, two)) for c in cs if c]
    return spark.createDataFrame(rows, "kmer string, grp int, cnt double")


def exact(a, b, c, d):
    r1, r2, c1 = a + b, c + d, a + c
    p = {x: Fraction(comb(r1, x) * comb(r2, c1 - x), comb(r1 + r2, c1)) for x in range(max(0, c1 - r2), min(r1, c1) + 1)}
    limit = p[a] * (1 + Fraction(1, 10**7))
    return {"two": sum(v for v in p.values() if v <= limit), "less": sum(v for x, v in p.items() if x <= a), "greater": sum(v for x, v in p.items() if x >= a), "point": p[a]}


TABLES = [(5, 0, 0, 5), (4, 1, 1, 4), (5, 0, 1, 4), (2, 3, 3, 2), (52, 0, 0, 52), (0, 0, 0, 0), (3, 0, 0, 0), (10, 0, 0, 10), (8, 2, 1, 9), (7, 3, 2, 8), (5, 5, 5, 5), (100, 30, 40, 90), (0, 7, 9, 1)]


def test_exact_tests_against_rationals(spark):
    df = spark.createDataFrame(TABLES, "a long, b long, c long, d long")
    cells = [F.col(c) for c in "abcd"]
    for row in df.select("*", *[fisher_exact(*cells, alt).alias(alt) for alt in ("two", "less", "greater", "point")]).collect():
        for alt, want in exact(*row[:4]).items():
            assert math.isclose(row[alt], float(want), rel_tol=1e-11), (row, alt)
    assert with_fisher(df, "two").where("a = 52").first()["pval"] == pytest.approx(1.26337e-30, rel=1e-5)
    with pytest.raises(ValueError):
        fisher_exact(*cells, "both")


def test_symmetry(spark):
    df = spark.createDataFrame(TABLES, "a long, b long, c long, d long")
    a, b, c, d = (F.col(x) for x in "abcd")
    for r in df.select(fisher_exact(a, b, c, d).alias("p"), fisher_exact(c, d, a, b).alias("q"), fisher_exact(a, b, c, d, "greater").alias("g"), fisher_exact(c, d, a, b, "less").alias("l")).collect():
        assert r["p"] == pytest.approx(r["q"], rel=1e-12) and r["g"] == pytest.approx(r["l"], rel=1e-12)


def test_factorials_beyond_the_table(spark):
    for r in spark.range(60, 70).union(spark.range(10**6, 10**6 + 1)).select("id", ln_factorial(F.col("id")).alias("l")).collect():
        assert r["l"] == pytest.approx(math.lgamma(r["id"] + 1), rel=1e-14)


def tables(df):
    return {r["kmer"]: (r["a"], r["b"], r["c"], r["d"]) for r in df.collect()}


def test_presence(spark):
    assert tables(presence.presence(counts(spark), 5, 5)) == {"AAACG": (5, 0, 0, 5), "AACGT": (0, 5, 5, 0), "ACCTA": (5, 0, 5, 0), "ACGTA": (4, 1, 1, 4), "AGATC": (5, 0, 1, 4), "CCTAA": (2, 3, 3, 2)}
    assert tables(presence.presence(counts(spark), 5, 5, cmin1=3, cmin2=1)) == {"AAACG": (3, 0, 0, 5), "AACGT": (0, 5, 2, 0), "ACCTA": (0, 0, 1, 0), "ACGTA": (1, 1, 0, 4), "AGATC": (1, 0, 0, 4), "CCTAA": (0, 3, 0, 2)}
    odd = spark.createDataFrame([("A", 1, float("nan")), ("A", 1, float("inf")), ("A", 2, 2.0)], "kmer string, grp int, cnt double")
    assert tables(presence.presence(odd, 2, 2)) == {"A": (1, 0, 1, 1)}
    assert tables(presence.presence(odd.where("grp = 2"), 2, 2, 2, 1, missing=1)) == {"A": (0, 2, 1, 1)}


def test_cut_is_strict(spark):
    found = presence.presence(counts(spark), 5, 5)
    assert {r["kmer"] for r in presence.significant(found, 0.01).collect()} == {"AAACG", "AACGT"}
    one = spark.createDataFrame([(3, 0, 0, 0)], "a long, b long, c long, d long")
    assert presence.significant(one, 1.0).count() == 0 and presence.significant(one, 1.0, printed=True).count() == 1
    assert [r["kmer"] for r in presence.group_specific(found, 5, 5, 2).collect()] == ["AACGT"]


def test_tests_run_once_per_table(spark):
    """The sum of a test stands above the distinct tables, and the cut above the sum: nothing of it is done row by row."""
    rows = spark.createDataFrame([(f"k{i}", 5, 0, i % 3, 5 - i % 3) for i in range(50)], "kmer string, a long, b long, c long, d long")
    plan = presence.significant(rows, 0.01)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    exps = [i for i, line in enumerate(plan) if "EXP(" in line.upper()]
    assert exps and all("Aggregate" in plan[i] for i in exps)
    cut = [i for i, line in enumerate(plan) if "Filter" in line and "0.01" in line]
    assert cut and max(cut) < min(exps)
    distinct = [i for i, line in enumerate(plan) if "Aggregate [a" in line]
    assert max(distinct) > max(i for i, line in enumerate(plan) if "Generate explode" in line)


def test_legacy_cut_is_on_the_printed_value(spark):
    # The point probability of this table is 0.0099999504...: printed 0.01 or not decides between neighbours.
    rows = spark.createDataFrame([(5, 0, 0, 5)], "a long, b long, c long, d long")
    p = 1 / 252
    assert presence.significant(rows, float(f"{p:.6g}"), "point", printed=True).count() == 1
    assert (presence.significant(rows, float(f"{p:.6g}"), "point").count() == 1) == (p < float(f"{p:.6g}"))


def test_ranks_with_one_p_value(spark):
    rows = spark.range(500).select(F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("kmer"), F.lit(0.25).alias("pval"))
    got = report.ranked(rows).orderBy("rank").collect()
    assert [(r["rank"], r["kmer"]) for r in got] == [(i + 1, f"k{i:04d}") for i in range(500)]


def test_long_contigs_are_spelled_in_pieces(spark, monkeypatch):
    import random

    monkeypatch.setattr(assembly, "PIECE", 7)
    text = "".join(random.Random(5).choices("ACGT", k=60))
    assert contigs(spark, canonical_set(text, 11), 11) == [min(text, rc(text))]


def test_report(spark):
    found = presence.significant(presence.presence(counts(spark), 5, 5), 0.05)
    groups = [tuple(r) for r in report.top_groups(found.withColumn("pval", F.round("pval", 8))).collect()]
    assert [(g[1:5], g[5]) for g in groups] == [((0, 5, 5, 0), 1), ((5, 0, 0, 5), 1), ((5, 0, 1, 4), 1)]
    names = [(r["name"], r["seq"]) for r in report.fasta_records(report.ranked(found)).orderBy("rank").collect()]
    assert names == [("kmer1_pval_0.00793651", "AAACG"), ("kmer2_pval_0.00793651", "AACGT"), ("kmer3_pval_0.047619", "AGATC")]


def rc(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def canonical_set(text, k):
    return {min(text[i : i + k], rc(text[i : i + k])) for i in range(len(text) - k + 1)}


def contigs(spark, kmers, k):
    return sorted(r["seq"] for r in assembly.unitigs(spark.createDataFrame([(x,) for x in kmers], "kmer string"), k).collect())


def test_unitigs(spark):
    assert contigs(spark, ["AAACG", "AACGT"], 5) == ["AAACGT"]
    text = "ACGGATTCAGCCTATGCAATCG"
    assert contigs(spark, canonical_set(text, 7), 7) == [min(text, rc(text))]
    assert contigs(spark, [], 5) == []
    # A fork: two ends share a stem.
    got = contigs(spark, canonical_set("ACGGATTCAGA", 5) | canonical_set("ACGGATTCTCC", 5), 5)
    assert {c for s in got for c in canonical_set(s, 5)} == canonical_set("ACGGATTCAGA", 5) | canonical_set("ACGGATTCTCC", 5)
    assert min("ACGGATTC", rc("ACGGATTC")) in got


def iterated(spark, seqs, k, min_k, step=1):
    return sorted(r["seq"] for r in assembly.iterated_unitigs(spark.createDataFrame([(x,) for x in seqs], "seq string"), k, min_k, step).collect())


def test_lengths_bridge_gaps(spark):
    """15-mers that overlap by nine letters: one length leaves two contigs, the lengths from 7 on join them."""
    text = "ACGGATTCAGCCTATGCAATCGTTGAC"
    cut = [text[i : i + 15] for i in range(len(text) - 14) if not 4 <= i <= 8]
    assert contigs(spark, [min(w, rc(w)) for w in cut], 15) == sorted(min(x, rc(x)) for x in (text[:18], text[9:]))
    assert iterated(spark, [rc(w) for w in cut] + cut + [None, "NNN", ""], 15, 7, 8) == [min(text, rc(text))]


def test_lengths_part_repeats(spark):
    """A stretch of eight letters stands twice: short lengths stop there, the longer ones read through it."""
    twice = "GATTCAGC"
    text = "ACCTG" + twice + "TGCAAT" + twice + "CCGTA"
    whole = min(text, rc(text))
    assert len(contigs(spark, canonical_set(text, 7), 7)) > 1
    reads = [text[i : i + 13] for i in range(len(text) - 12)]
    assert iterated(spark, reads, 13, 7, 3) == [whole] == contigs(spark, canonical_set(text, 13), 13)


def test_nothing_gained_is_the_last_length(spark):
    pieces = ["ACGGATTCAGCCTATGCA", "TTGACCGTAGGCATCCA"]
    kmers = set().union(*(canonical_set(p, 11) for p in pieces))
    assert iterated(spark, kmers, 11, 10) == contigs(spark, kmers, 11) == sorted(min(p, rc(p)) for p in pieces)
    assert iterated(spark, [], 11, 9) == []
    with pytest.raises(ValueError):
        assembly.iterated_unitigs(spark.createDataFrame([], "seq string"), 5, 7)


def test_cycle_is_cut(spark):
    ring = "ACGGATTCAGC"
    kmers = canonical_set(ring + ring[:6], 7)
    got = contigs(spark, kmers, 7)
    assert len(got) == 1 and canonical_set(got[0], 7) == kmers
