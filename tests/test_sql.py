import pytest
from pyspark.errors import PythonException

from kmerloom.functions import sql
from kmerloom.functions.statistics import with_fisher

TABLES = [(5, 0, 0, 5), (4, 1, 1, 4), (52, 0, 0, 52), (0, 0, 0, 0), (3, 0, 0, 0), (8, 2, 1, 9), (100, 30, 40, 90), (0, 7, 9, 1), (1000, 20, 900, 90)]


def test_fisher_in_sql(spark):
    sql.register_fisher(spark)
    df = spark.createDataFrame([*TABLES, TABLES[0]], "a long, b long, c long, d long")
    own = {tuple(r)[:4]: r["p"] for r in spark.sql("SELECT *, fisher_exact(a, b, c, d) AS p FROM {df}", df=df).collect()}
    assert len(own) == len(TABLES)
    for r in with_fisher(df, "two").collect():
        assert own[tuple(r)[:4]] == pytest.approx(r["pval"], rel=1e-12)
    assert spark.sql("SELECT fisher_exact(NULL, 1, 2, 3) AS p").first()["p"] is None


def test_kmers_in_sql(spark):
    sql.register_kmers(spark)
    rows = [("s", 1, "ACGTNACGTACG"), ("s", 1, "acgt"), ("t", 2, None), ("t", 2, "AC"), (None, 2, "ACGT")]
    df = spark.createDataFrame(rows, "sample string, grp int, seq string").repartition(3)
    for dealt in ("", "PARTITION BY (sample)"):
        found = spark.sql(f"SELECT sample, grp, kmer, sum(cnt) AS n FROM kmers(TABLE(SELECT * FROM {{df}}) {dealt}, 3) GROUP BY ALL", df=df).collect()
        assert {tuple(r) for r in found} == {("s", 1, "ACG", 7), ("s", 1, "GTA", 2), (None, 2, "ACG", 2)}
    with pytest.raises(PythonException, match="is not from"):
        spark.sql("SELECT * FROM kmers(TABLE(SELECT * FROM {df}), 40)", df=df).collect()
