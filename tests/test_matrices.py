import duckdb
import pytest

import __spark_entry__

DOCS = [
    (1, "abcde abcde fghij fghij", "en", "src0"),
    (2, "abcde abcde klmno klmno", "fr", "src10"),
    (3, "pqrst pqrst abcdefgh abcdefgh", "fr", "src2"),
    (4, "zyxwvuts zyxwvuts", "de", "blog"),
    (5, "one", "es", "src0"),
    (6, None, "es", "src1"),
]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs"))
    spark.createDataFrame(DOCS, "doc_id long, text string, lang string, source string").write.parquet(f"{path}/documents.parquet")
    return path


@pytest.mark.parametrize("name", ["count_matrix_all", "kmer_right_count_all"])
def test_every_sample(spark, sf, tables, name):
    """Both groups, sources of any name, and samples without a counted k-mer; rows as the SQL has them."""
    for path, glob in ((tables, "documents.parquet/*.parquet"), (sf, "documents.parquet")):
        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/{glob}'")
        want = sorted(con.execute(__spark_entry__.oracle_sql()[name]).fetchall())
        got = sorted(tuple(r) for r in __spark_entry__.queries()[name](spark, path).collect())
        assert got == want and got


def test_matrix_order(spark, tables):
    cells = {r["kmer"]: r["cells"].split("\t") for r in __spark_entry__.queries()["count_matrix_all"](spark, tables).collect()}
    # en-src0, de-blog, es-src0, fr-src2, fr-src10.
    assert cells["ACGTA"] == ["2", "0", "0", "6", "2"]
    assert {len(v) for v in cells.values()} == {5}
    samples = {r["sample"] for r in __spark_entry__.queries()["kmer_right_count_all"](spark, tables).collect()}
    assert samples == {"en-src0", "de-blog", "es-src0", "fr-src2", "fr-src10"}
