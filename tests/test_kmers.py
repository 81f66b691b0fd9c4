import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kmerloom.functions import packing, parsing, sequences, signatures
from kmerloom.operators import counting, lookup, matrix

READS = [(1, "ACGTNACGTACG"), (2, "AC"), (3, "acgt"), (4, None)]


def reads(spark, rows=READS):
    return spark.createDataFrame(rows, "read_id long, seq string").withColumn("sample", F.lit("s"))


def counted(df):
    return {r["kmer"]: r["cnt"] for r in df.collect()}


def test_canonical_counts(spark):
    assert counted(counting.count_kmers(reads(spark), 3, 1)) == {"ACG": 7, "GTA": 2}
    assert counted(counting.count_kmers(reads(spark), 3, 2)) == {"ACG": 7, "GTA": 2}
    assert counted(counting.count_kmers(reads(spark), 3, 3)) == {"ACG": 7}
    assert counted(counting.count_kmers(reads(spark), 3, 1, count_cap=5)) == {"ACG": 5, "GTA": 2}
    assert counted(counting.count_kmers(reads(spark), 3, 2, times=2)) == {"ACG": 14, "GTA": 4}
    assert counted(counting.count_kmers(reads(spark, []), 3, 1)) == {}


def test_counters_along_reads(spark):
    db = counting.count_kmers(reads(spark), 3, 1)
    asked = reads(spark, [(1, "ACGTNACGTA"), (2, "TTTACG"), (3, "AC")])
    found = {r["read_id"]: r["counters"] for r in lookup.counter_arrays(lookup.counters(asked, db, 3)).collect()}
    assert found == {1: [7, 7, 0, 0, 0, 7, 7, 2], 2: [0, 0, 2, 7]}
    long = "ACGT" * 12 + "N" + "ACGT" * 9
    db = counting.count_kmers(reads(spark, [(1, long)]), 33, 1)
    got = lookup.counter_arrays(lookup.counters(reads(spark, [(1, long)]), db, 33)).first()["counters"]
    assert len(got) == len(long) - 32 and got[16:49] == [0] * 33 and min(got[:16] + got[49:]) > 0


@pytest.mark.parametrize(("k", "both"), [(4, False), (11, True), (11, False), (12, True)])
def test_counters_of_short_kmers_shuffle_no_windows(spark, k, both):
    rng = random.Random(k)
    base = "".join(rng.choices("ACGT", k=300))
    rows = [(i, base[rng.randint(0, 250) :][: rng.randint(0, 90)] + rng.choice(["", "N", "nnnACGTTGCA", "N" * 40])) for i in range(40)] + [(90, None), (91, "N" * 30), (92, base), (92, rc(base))]
    db = {}
    for i in range(0, 300 - k, 2):
        db[min(w := base[i : i + k], rc(w)) if both else base[i : i + k]] = i + 1
    want = Counter((i, at, 0 if "N" in (w := seq[at : at + k].upper()) else db.get(min(w, rc(w)) if both else w, 0)) for i, seq in rows for at in range(len(seq or "") - k + 1))
    table = spark.createDataFrame(list(db.items()), "kmer string, cnt long")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = lookup.counters(reads(spark, rows), table, k, both)
        plan = found._jdf.queryExecution().executedPlan().toString()
        got = Counter((r["read_id"], r["pos"], r["cnt"]) for r in found.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert got == want
    # No more than 4^11 k-mers are sent to every task, whatever their table's size; longer ones meet in a shuffle.
    assert ("BroadcastHashJoin" in plan and "hashpartitioning" not in plan) == (k <= lookup.TABLE_K)


def test_windows_of_long_reads_cross_pieces(spark):
    text = "ACGTTGCA" * 200
    rows = sequences.windows(spark.createDataFrame([(text,)], "seq string"), 9).orderBy("pos").collect()
    assert [(r["pos"], r["kmer"]) for r in rows] == [(i, text[i : i + 9]) for i in range(len(text) - 8)]


def rc(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


@settings(max_examples=200, deadline=None)
@given(st.text("ACGTacgtN", max_size=80), st.integers(1, 31), st.booleans())
def test_packed_windows(text, k, both):
    values, ok = packing.packed_windows(np.frombuffer(text.encode(), np.uint8), k, both)
    want = []
    for i in range(len(text) - k + 1):
        w = text[i : i + k].upper()
        w = min(w, rc(w)) if both else w
        want.append(None if "N" in w else sum("ACGT".index(c) * 4 ** (k - 1 - j) for j, c in enumerate(w)))
    assert [int(v) if o else None for v, o in zip(values, ok, strict=True)] == want


@pytest.mark.parametrize("k", [5, 12, 31, 33])
def test_counts_by_sample_against_python(spark, k, monkeypatch):
    """Keys with nulls, long reads in pieces, other symbols; above 31 bases k-mers are strings."""
    rng = random.Random(k)
    base = "".join(rng.choices("ACGT", k=400))
    rows = [(i, rng.choice(["a", "b", None]), i % 2, base[rng.randint(0, 200) :][: rng.randint(0, 200)] + rng.choice(["", "N", "nx-ü", "acgt"])) for i in range(60)]
    rows += [(99, "a", 0, base * 400), (100, "b", None, None), (101, "b", 1, "")]
    df = spark.createDataFrame(rows, "read_id long, sample string, grp int, seq string")
    want = Counter()
    for _, sample, grp, seq in rows:
        for i in range(len(seq or "") - k + 1):
            w = seq[i : i + k].upper()
            if not set(w) - set("ACGT"):
                want[(sample, grp, min(w, rc(w)))] += 1
    got = {(r["sample"], r["grp"], r["kmer"]): r["cnt"] for r in counting.count_kmers(df, k, 1, keys=("sample", "grp")).collect()}
    assert got == want
    packed_rows = counting.count_kmers(df, k, 1, keys=(), packed=True).count() if k < 32 else len({x for *_, x in want})
    assert packed_rows == len({x for *_, x in want})
    if k > 31:
        with pytest.raises(ValueError):
            counting.count_kmers(df, k, packed=True)


def test_repeated_rows(spark):
    table = spark.createDataFrame([("s", "A", 1), ("s", "A", 2), ("t", "A", 1)], "sample string, kmer string, cnt long")
    assert [tuple(r) for r in counting.repeated_rows(table).collect()] == [("s", "A", 2)]


def test_packed_and_back(spark):
    df = spark.createDataFrame([("T" * 31,), ("A" * 31,), ("ACGTACGTACGTACGTACGTACGTACGTACG",)], "kmer string")
    rows = df.select("kmer", sequences.packed(F.col("kmer"), 31).alias("n")).withColumn("back", sequences.unpacked(F.col("n"), 31)).collect()
    assert rows[0]["n"] == 4611686018427387903 and rows[1]["n"] == 0
    assert all(r["kmer"] == r["back"] for r in rows)
    with pytest.raises(ValueError):
        sequences.packed(F.col("kmer"), 32)


def test_bases(spark):
    r = spark.range(1).select(sequences.base_at(F.lit("ACG"), 1).alias("b"), sequences.code_at(F.lit("ACG"), 2).alias("c"), sequences.code_at(F.lit("ACG"), 5).alias("out"), sequences.canonical(F.lit("TTT")).alias("k")).first()
    assert (r["b"], r["c"], r["out"], r["k"]) == ("C", 2, 0, "AAA")


def test_signatures(spark):
    df = spark.createDataFrame([(m,) for m in ("AACCG", "CCAAG", "ACAGT", "GGTTC", "ACCGT", "AAAAA")], "m string")
    got = {r["m"]: r["n"] for r in df.select("m", signatures.normalised(F.col("m"), 5).alias("n")).collect()}
    assert got == {"AACCG": 22, "CCAAG": 506, "ACAGT": 1024, "GGTTC": 1024, "ACCGT": 91, "AAAAA": 1024}
    one = signatures.signatures(spark.createDataFrame([("ACGTACCGTTA",)], "kmer string"), 5).first()
    assert one["signature"] == 26


def test_lenient_numbers(spark):
    cases = {"12abc": 12, "": 0, "x": 0, "2.5e1z": 25, " 7": 7, "-3": -3, "0x1A": 0, ".5": 0.5, "inf": float("inf"), "-inf": float("-inf")}
    df = spark.createDataFrame([(k,) for k in [*cases, "nan", None]], "v string")
    got = {r["v"]: r["n"] for r in df.select("v", parsing.lenient_number(F.col("v")).alias("n")).collect()}
    assert got.pop("nan") != got.get("nan") and got.pop(None) == 0
    assert got == cases


def test_ranges_and_sets(spark):
    a = spark.createDataFrame([("A", 5), ("C", 2)], "kmer string, cnt long")
    b = spark.createDataFrame([("C", 9), ("G", 1)], "kmer string, cnt long")
    assert counted(counting.union_sum(a.union(b), 10)) == {"A": 5, "C": 10, "G": 1}
    assert counted(counting.right_counts(a.union(b).select("kmer").distinct(), b)) == {"A": 1, "C": 9, "G": 1}
    assert counted(counting.count_range(a, 3, None)) == {"A": 5}
    assert {r["kmer"] for r in lookup.contained(b, a).collect()} == {"C"}
    r = counting.CountRange(2, 10)
    assert not r.set_low(1) and r.set_low(5) and not r.set_high(4) and r.set_high(6) and (r.low, r.high) == (5, 6)
    r.reset()
    assert (r.low, r.high) == (2, 10)


def test_matrix_and_back(spark):
    counts = spark.createDataFrame([("m-1", "AC", 3), ("m-2", "AC", 4), ("m-2", "GT", 1)], "sample string, kmer string, cnt long")
    rows = {r["kmer"]: (r["m-1"], r["m-2"]) for r in matrix.count_matrix(counts, ["m-1", "m-2"]).collect()}
    assert rows == {"AC": (3, 4), "GT": (0, 1)}
    lines = spark.createDataFrame([("AC\t3\t4",), ("GT\t0",), ("",)], "value string")
    back = {(r["kmer"], r["sample"]): r["cnt"] for r in matrix.read_matrix(lines, ["m-1", "m-2"]).collect()}
    assert back == {("AC", "m-1"): 3, ("AC", "m-2"): 4, ("GT", "m-1"): 0}


def test_headers_are_no_rows(spark):
    lines = spark.createDataFrame([("kmer\tf\tm",), ("AC\t3\t4",), ("kmer\tf\tm",)], "value string")
    head = matrix.header_of(lines)
    assert sorted(tuple(r) for r in matrix.read_matrix(lines, header=head).collect()) == [("AC", "f", 3.0), ("AC", "m", 4.0)]
    with pytest.raises(ValueError):
        matrix.read_matrix(lines)
    one = matrix.line_tables(lines.unionAll(spark.createDataFrame([("",), ("GT\tx\tnan\t5",), (None,)], "value string")), 1, header=head)
    assert {r["kmer"]: tuple(r)[1:5] for r in one.collect()} == {"AC": (1, 0, 1, 0), "": (0, 0, 0, 0), "GT": (0, 1, 1, 0)}


def test_field_means(spark):
    rows = ["0.00793651\t5\t0\t0\t5\tAAACG\t3\t2\t4\t2\t5\t0\t0\t0\t0\t0", "0.00793651\t0\t5\t5\t0\tAACGT\t0\t0\t0\t0\t0\t2\t2\t3\t9\t2"]
    got = matrix.field_means(spark.createDataFrame([(r,) for r in rows], "value string")).orderBy("field").collect()
    assert [(r["field"], r["avg"]) for r in got] == list(zip(range(7, 17), [3, 2, 4, 2, 5, 2, 2, 3, 9, 2], strict=True))
