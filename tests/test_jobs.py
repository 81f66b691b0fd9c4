import gzip

import pytest

from kmerloom.jobs import association
from kmerloom.operators.counting import count_kmers
from kmerloom.sources.database import KmerDatabase, save_database
from kmerloom.sources.reads import read_tsv

SHARED, OWN = "ACGGATTCAGCCTATG", "TTGACCAGTACGGATA"


@pytest.fixture
def cohort(tmp_path):
    for group, own in (("females", True), ("males", False)):
        (tmp_path / group).mkdir()
        for i in range(5):
            with gzip.open(tmp_path / group / f"S{i}_1.fq.gz", "wt") as f:
                for s in [SHARED] * 2 + [OWN] * 2 * own:
                    f.write(f"@r\n{s}\n+\n{'I' * len(s)}\n")
    return str(tmp_path)


def test_association(spark, cohort, tmp_path):
    out = str(tmp_path / "out")
    found = association.run_association(spark, cohort, out, association.Settings(k=9))
    assert found["n1"] == found["n2"] == 5 and found["significant"] == len(OWN) - 8
    rows = read_tsv(spark, f"{out}/significant").collect()
    assert {(r["pval"], r["grp1_high"], r["grp2_low"]) for r in rows} == {("0.00793651", "5", "5")}
    contigs = [r["value"] for r in spark.read.text(f"{out}/contigs").collect() if r["value"][0] != ">"]
    rc = OWN[::-1].translate(str.maketrans("ACGT", "TGCA"))
    assert contigs == [min(OWN, rc)]
    assert {(r["female-S0"], r["male-S4"]) for r in rows} == {("2", "0")}
    means = sorted(tuple(r) for r in spark.read.option("sep", "\t").csv(f"{out}/averages").collect())
    assert means == sorted((str(7 + i), "2") for i in range(5))
    wide = read_tsv(spark, f"{out}/matrix").collect()
    assert len(wide) == found["tested"] and {r["male-S0"] for r in wide} == {"0", "2"}
    steps = {r["step"]: r for r in spark.read.json(f"{out}/steps").collect()}
    assert [steps[x]["rows"] for x in ("matrix", "tested", "ranked", "significant", "fasta", "contigs")] == [found["tested"], found["tested"], *[found["significant"]] * 3, 1]
    assert steps["counts"]["rows"] == spark.read.parquet(f"{out}/counts").count() and all(r["seconds"] > 0 for r in steps.values())
    with pytest.raises(ValueError):
        association.run_association(spark, str(tmp_path / "out" / "top"), str(tmp_path / "none"))
    again = str(tmp_path / "again")
    assert association.run_matrix(spark, f"{out}/matrix", 5, again) == {"significant": found["significant"]}
    assert sorted(spark.read.text(f"{again}/significant").collect()) == sorted(spark.read.text(f"{out}/significant").collect())


def test_legacy_and_full_tables(spark, cohort, tmp_path):
    out = str(tmp_path / "out")
    found = association.run_association(spark, cohort, out, association.legacy_settings(k=9, full_table=True, matrix=False))
    full = read_tsv(spark, f"{out}/full").collect()
    assert len(full) == found["tested"] and {r["male-S0"] for r in full} == {"1", "2"}
    assert found["significant"] == len(OWN) - 8


def test_database(spark, tmp_path):
    reads = spark.createDataFrame([(1, "s1", "ACGTNACGTACG"), (2, "s2", "TTTTT")], "read_id long, sample string, seq string")
    save_database(count_kmers(reads, 3, 1), str(tmp_path / "db"), 3)
    db = KmerDatabase.open(spark, str(tmp_path / "db"), "s1")
    assert (db.kmer_length, db.both_strands, db.original, db.kmer_count()) == (3, True, (2, 5), 2)
    probe = spark.createDataFrame([("ACG",), ("GTA",), ("CGT",)], "kmer string")
    assert {r["kmer"]: r["cnt"] for r in db.find(probe).collect()} == {"ACG": 5, "GTA": 2, "CGT": None}
    narrow = db.with_low(3)
    assert narrow.kmer_count() == 1 and narrow.full_range().kmer_count() == 2
    assert {r["kmer"] for r in narrow.contained(probe).collect()} == {"ACG"}
    assert db.counters(reads.where("read_id = 1")).first()["counters"] == [5, 5, 0, 0, 0, 5, 5, 2, 2, 5]
    for bad in (lambda: db.with_low(1), lambda: db.with_high(8), lambda: KmerDatabase.open(spark, str(tmp_path / "db"), "no")):
        with pytest.raises(ValueError):
            bad()
