import gzip

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from kmerloom import storage
from kmerloom.operators.counting import count_kmers
from kmerloom.sources import manifest, reads
from kmerloom.streaming import cohort


@pytest.fixture
def cohort_dir(tmp_path):
    for group, name, seqs in [("females", "F1_a", ["ACGTA", "TTTAC"]), ("females", "F1_b", ["GGGCC"]), ("females", "F10_a", ["AAAAA"]), ("females", "F2_a", ["CCCCC"]), ("males", "M1_a", ["ACACA"] * 3)]:
        (tmp_path / group).mkdir(exist_ok=True)
        with gzip.open(tmp_path / group / f"{name}.fq.gz", "wt") as f:
            for i, s in enumerate(seqs):
                f.write(f"@r{i}\n{s}\n+\n{'I' * len(s)}\n")
    return str(tmp_path)


def test_manifest(spark, cohort_dir):
    found = manifest.discover(spark, cohort_dir)
    assert manifest.sample_order(found) == ["female-F1", "female-F2", "female-F10", "male-M1"]
    assert found.groupBy("sample").count().where("sample = 'female-F1'").first()["count"] == 2


def test_fastq(spark, cohort_dir):
    found = reads.read_fastq(spark, [f"{cohort_dir}/females/*.fq.gz", f"{cohort_dir}/males/*.fq.gz"])
    rows = sorted((r["sample"], r["grp"], r["seq"]) for r in found.collect())
    assert rows == [("female-F1", 1, "ACGTA"), ("female-F1", 1, "GGGCC"), ("female-F1", 1, "TTTAC"), ("female-F10", 1, "AAAAA"), ("female-F2", 1, "CCCCC")] + [("male-M1", 2, "ACACA")] * 3


def test_ids_without_groups(spark, cohort_dir):
    found = manifest.discover(spark, cohort_dir, prefix_group=False)
    assert {r["sample"] for r in found.collect()} == {"F1", "F2", "F10", "M1"}


def test_plain_fastq_and_awkward_qualities(spark, tmp_path):
    """Split anywhere; qualities that start with @ or +, CRLF, no last newline, a record cut short."""
    (tmp_path / "females").mkdir()
    seqs = [f"ACGT{'ACGT'[i % 4]}{'TTG' * (i % 5)}" for i in range(400)]
    quals = ["@" + "I" * (len(s) - 1) if i % 3 == 0 else "+" * len(s) for i, s in enumerate(seqs)]
    (tmp_path / "females" / "A_1.fq").write_text("".join(f"@r{i} @x\n{s}\n+r{i}\n{q}\n" for i, (s, q) in enumerate(zip(seqs, quals, strict=True)))[:-1])
    (tmp_path / "females" / "B_1.fq").write_bytes(b"@r\r\nGGG\r\n+\r\n@@@\r\n@cut\r\nTTT")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        df = reads.read_fastq(spark, f"{tmp_path}/females/*.fq")
        assert df.rdd.getNumPartitions() > 5
        rows = df.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert sorted(r["seq"] for r in rows if r["sample"] == "female-A") == sorted(seqs)
    assert [r["seq"] for r in rows if r["sample"] == "female-B"] == ["GGG"]


def test_tsv_and_fasta(spark, tmp_path):
    df = spark.createDataFrame([("kmer1_pval_0.1", "ACG")], "name string, seq string")
    reads.write_fasta(df, str(tmp_path / "fa"), "none")
    assert [r["value"] for r in spark.read.text(str(tmp_path / "fa")).collect()] == [">kmer1_pval_0.1", "ACG"]
    reads.write_tsv(df, str(tmp_path / "tsv"))
    assert reads.read_tsv(spark, str(tmp_path / "tsv")).first()["seq"] == "ACG"


def test_stream_adds_new_samples(spark, tmp_path):
    schema = "read_id long, grp int, sample string, seq string"
    rows = [(1, 1, "f", "ACGTACGT"), (2, 2, "m", "GGGTTT")]
    for k, row in enumerate(rows):
        spark.createDataFrame([row], schema).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        cohort.append_counts(stream, 3, str(tmp_path / "counts"), str(tmp_path / "state"))
        table = spark.read.schema(cohort.SCHEMA).parquet(str(tmp_path / "counts"))
        got = {(r["sample"], r["kmer"]): r["cnt"] for r in cohort.cohort_counts(table, 1).collect()}
        want = {(r["sample"], r["kmer"]): r["cnt"] for r in count_kmers(spark.createDataFrame(rows[: k + 1], schema), 3, 1, packed=True).collect()}
        assert got == want


@pytest.mark.parametrize("name", ["significant_kmers", "ranked_fasta", "read_counters", "kmer_signature", "part_segment_enrichment", "count_matrix_all", "annotated_significant", "field_means_significant", "matrix_lines_significant", "significant_legacy", "kmer_count_k33"])
def test_queries_match_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "events", "lineitem", "orders", "customer", "nation", "part"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    want = con.sql(__spark_entry__.oracle_sql()[name]).df()
    got = __spark_entry__.queries()[name](spark, sf).toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    a, b = (x[columns].sort_values(columns).reset_index(drop=True) for x in (got, want))
    assert len(a) == len(b) and (a == b).all().all()


def test_k33_keeps_groups_apart(spark, tmp_path):
    """Languages and sources with dashes may give samples of both groups one name; a k-mer may end in a G and 31 A."""
    text = "ac" + "a" * 31
    rows = [(1, text, "en", "a-b"), (2, text, "en-a", "b"), (3, text, "fr", "b"), (4, f"{text[:9]} {text[9:]}.", "fr", "b")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(path := str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{path}/*.parquet'")
    want = sorted(con.sql(f"select sample, kmer, cnt from ({__spark_entry__.oracle_sql()['kmer_count_k33']})").fetchall())
    got = sorted(tuple(r) for r in __spark_entry__.queries()["kmer_count_k33"](spark, str(tmp_path)).select("sample", "kmer", "cnt").collect())
    assert got == want == [("fr-b", "AG" + "A" * 31, 2)]


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_shared_folder():
    from types import SimpleNamespace

    def session(master, named=None, app="app-1"):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: named), sparkContext=SimpleNamespace(master=master, applicationId=app))

    assert storage.shared_folder(session("spark://host:1", "hdfs://x/y/")) == "hdfs://x/y"
    own = storage.shared_folder(session("local[2]"))
    assert own.startswith("file:///") and storage.shared_folder(session("local[2]")) == own
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.shared_folder(session("yarn"))


def test_document_reads_leave_out_nulls(spark, tmp_path):
    df = spark.createDataFrame([(1, "Ab c", "en", "s"), (2, None, "en", "s"), (3, "x", None, "s")], "doc_id long, text string, lang string, source string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    rows = reads.document_reads(spark, str(tmp_path)).select("read_id", "seq").collect()
    assert [tuple(r) for r in rows] == [(1, "ACNG")]


def test_parts_of_a_table_are_one_file_in_order(spark, tmp_path):
    """The compressed parts one after another are one gzip file: a header, and the rows in their order."""
    import gzip

    df = spark.range(0, 5000, 1, 7).select((5000 - F.col("id")).alias("n"), F.when(F.col("id") % 3 != 0, F.concat(F.lit("x"), F.col("id"))).alias("s.t"))
    reads.write_tsv(df.repartitionByRange(5, "n").sortWithinPartitions("n"), path := str(tmp_path / "table"))
    parts = sorted(p for p in (tmp_path / "table").iterdir() if p.name.startswith("part-"))
    assert len(parts) > 2
    lines = gzip.decompress(b"".join(p.read_bytes() for p in parts)).decode().splitlines()
    assert lines == ["n\ts.t", *[f"{n}\t{'' if (5000 - n) % 3 == 0 else f'x{5000 - n}'}" for n in range(1, 5001)]]
    assert reads.table_header(spark, path) == "n\ts.t" and reads.read_tsv(spark, path).count() == 5000
