import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kmerloom.functions import packing, superkmers
from kmerloom.operators import counting
from kmerloom.operators.superkmers import pair_text, superkmer_counts

RNG = random.Random(31)


def rc(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def brute(rows, k, least=1, both=True):
    n = Counter()
    for sample, grp, seq in rows:
        s = (seq or "").upper()
        for i in range(len(s) - k + 1):
            w = s[i : i + k]
            if set(w) <= set("ACGT"):
                n[sample, grp, min(w, rc(w)) if both else w] += 1
    return {key: c for key, c in n.items() if c >= least}


def reads(n=60):
    genome = "".join(RNG.choices("ACGT", k=3000))
    rows = []
    for _ in range(n):
        at, size = RNG.randrange(2900), RNG.randint(5, 300)
        s = genome[at : at + size]
        rows.append((RNG.choice(["a", "b", None]), RNG.choice([1, 2]), RNG.choice([s, rc(s), s.lower(), s[: size // 2] + "N" + s[size // 2 :]])))
    return [*rows, ("a", 1, None), ("a", 1, ""), ("b", 2, "A" * 400), ("b", 2, "ACGTN" * 40), ("b", 2, "TTTTTTTTTTTTTT")]


@pytest.mark.parametrize("m", [5, 6, 7])
def test_table_is_the_rule_for_mmers(m):
    table = superkmers.normalised_table(m)

    def allowed(w):
        return not (w.endswith(("TTT", "TGT")) or w[-3:-1] == "TT" or "AA" in w[1:] or w.startswith(("AAA", "ACA")))

    for value in RNG.sample(range(4**m), 400):
        w = "".join("ACGT"[(value >> (2 * (m - 1 - i))) & 3] for i in range(m))
        number = [sum("ACGT".index(c) * 4 ** (m - 1 - i) for i, c in enumerate(x)) for x in (w, rc(w)) if allowed(x)]
        assert table[value] == min(number, default=4**m)


@pytest.mark.parametrize(("k", "m"), [(9, 5), (27, 7), (31, 9), (7, 7)])
def test_stretches_hold_every_window_once(k, m):
    text = "".join(RNG.choices("ACGTacgtN", [9, 9, 9, 9, 1, 1, 1, 1, 0.3], k=2000))
    symbols = np.frombuffer(text.encode(), np.uint8)
    bins, n, size, bases = superkmers.stretches(symbols, k, m, 13)
    assert size.sum() == len(bases) and len(bins) == len(n)
    values, ok = packing.packed_windows(symbols, k)
    assert superkmers.expanded(n, bases, k, True)[0].tolist() == values[ok].tolist()
    # Both strands of a k-mer have one bin.
    by = dict(zip(values[ok].tolist(), np.repeat(bins, n).tolist(), strict=True))
    other, n2, _, bases2 = (x for x in superkmers.stretches(np.frombuffer(rc(text.upper().replace("N", "-")).encode(), np.uint8), k, m, 13))
    assert dict(zip(superkmers.expanded(n2, bases2, k, True)[0].tolist(), np.repeat(other, n2).tolist(), strict=True)) == by


def test_batches_of_any_size_count_whole_bins(monkeypatch):
    rows = reads()
    table = pa.table({"sample": [r[0] for r in rows], "grp": [r[1] for r in rows], "seq": [r[2] for r in rows]})
    monkeypatch.setattr(superkmers, "FLUSH_KMERS", 300)
    pieces = pa.Table.from_batches(superkmers.cut_batches(iter(table.to_batches(7)), 11, 5, 9))
    pieces = pieces.append_column("part", pa.array([0] * len(pieces))).select(["sample", "grp", "bin", "part", "n", "sizes", "bases"]).sort_by([("sample", "ascending"), ("grp", "ascending"), ("bin", "ascending")])
    for most, size in ((10, 3), (200, 5), (1 << 20, 1000)):
        monkeypatch.setattr(superkmers, "COUNT_KMERS", most)
        got = {}
        for batch in superkmers.counted_stretches(iter(pieces.to_batches(size)), 11, True, 2, 2):
            for r in batch.to_pylist():
                assert (key := (r["sample"], r["grp"], r["kmer"])) not in got
                got[key] = r["cnt"]
        packed = {(s, g, sum("ACGT".index(c) * 4 ** (10 - i) for i, c in enumerate(w))): c for (s, g, w), c in brute(rows, 11, 2).items()}
        assert got == packed


@pytest.mark.parametrize(("split", "both"), [(1 << 24, True), (60, True), (60, False)])
def test_counts(spark, split, both):
    rows = reads()
    df = spark.createDataFrame(rows, "sample string, grp int, seq string").withColumn("bin", F.lit("own")).repartition(4)
    found = superkmer_counts(df, 21, 2, ("sample", "grp"), both, bins=16, split=split)
    got = {(r["sample"], r["grp"], r["text"]): r["cnt"] for r in found.withColumn("text", counting.kmer_text("kmer", 21)).collect()}
    assert got == brute(rows, 21, 2, both) and found.count() == len(got)
    assert superkmer_counts(df.where("false"), 21).count() == 0
    with pytest.raises(ValueError):
        superkmer_counts(df, 64)


@pytest.mark.parametrize(("k", "both"), [(32, True), (33, True), (33, False), (47, True), (63, True)])
def test_kmers_of_two_numbers(spark, k, both):
    rows = reads(80)
    df = spark.createDataFrame(rows, "sample string, grp int, seq string").repartition(3)
    found = superkmer_counts(df, k, 1, ("sample", "grp"), both, bins=16, split=500).withColumn("text", pair_text(k))
    got = found.orderBy("high", "low").collect()
    assert {(r["sample"], r["grp"], r["text"]): r["cnt"] for r in got} == brute(rows, k, 1, both)
    assert [r["text"] for r in got] == sorted(r["text"] for r in got)
    counted = counting.count_kmers(df, k, 2, keys=("sample", "grp"), both_strands=both)
    assert {(r["sample"], r["grp"], r["kmer"]): r["cnt"] for r in counted.collect()} == brute(rows, k, 2, both)


@pytest.mark.parametrize("k", [32, 33, 63])
def test_last_bases_of_every_sign(spark, k):
    """The last 32 bases as a number: 0, 2^63 - 1, 2^63, 2^64 - 1 and their neighbours."""
    lasts = ["A" * 32, "A" * 31 + "C", "C" + "T" * 31, "G" + "A" * 31, "G" + "A" * 30 + "C", "T" * 31 + "G", "T" * 32]
    rows = [("s", 1, "ACG" * 10 + "A" + last) for last in lasts]
    rows = [(s, g, seq[-k:]) for s, g, seq in rows]
    df = spark.createDataFrame(rows, "sample string, grp int, seq string")
    for both in (True, False):
        got = {(r["sample"], r["grp"], r["kmer"]): r["cnt"] for r in counting.count_kmers(df, k, 1, keys=("sample", "grp"), both_strands=both).collect()}
        assert got == brute(rows, k, 1, both)


def test_one_signature_for_all_reads(spark):
    """Reads of one letter have one bin; it is dealt over several tasks and still counted whole."""
    df = spark.createDataFrame([("s", "A" * 200)] * 500 + [("s", "ACGT" * 50)] * 20, "sample string, seq string").repartition(8)
    found = superkmer_counts(df, 27, bins=8, split=2000)
    got = {r["text"]: r["cnt"] for r in found.withColumn("text", counting.kmer_text("kmer", 27)).collect()}
    assert got["A" * 27] == 500 * 174 and sum(got.values()) == 520 * 174
