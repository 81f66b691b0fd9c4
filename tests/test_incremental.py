import random

from pyspark.sql import functions as F

from kmerloom.functions.statistics import with_fisher
from kmerloom.operators import presence
from kmerloom.streaming import incremental
from kmerloom.streaming.incremental import Rules

SCHEMA = "sample string, grp int, kmer long, cnt long"


def rows_of(rng, samples):
    return [(s, g, k, rng.randint(1, 4)) for s, g in samples for k in rng.sample(range(40), 25)]


def whole(spark, rows, samples, rules):
    """One run over everything."""
    counts = spark.createDataFrame(rows, SCHEMA).groupBy("sample", "grp", "kmer").agg(F.sum("cnt").alias("cnt")).where(F.col("cnt") >= rules.min_count)
    sizes = [len({s for s, g in samples if g == x}) for x in (1, 2)]
    return with_fisher(presence.presence(counts, *sizes, rules.cmin1, rules.cmin2), rules.alternative)


def values(df):
    return sorted((r["kmer"], r["a"], r["b"], r["c"], r["d"], round(r["pval"], 12)) for r in df.collect())


def test_arrivals_equal_one_run(spark, tmp_path):
    """Three arrivals; one sample goes on in the second, and one has no k-mer at all."""
    rng = random.Random(2)
    for rules in (Rules(), Rules(3, 4, 2, "greater")):
        path = f"file://{tmp_path}/{rules.min_count}{rules.cmin1}"
        arrivals = [[("f1", 1), ("f2", 1), ("m1", 2)], [("f2", 1), ("m2", 2), ("none", 2)], [("f3", 1), ("m3", 2)]]
        rows, samples = [], []
        for n, own in enumerate(arrivals):
            new = rows_of(rng, [x for x in own if x[0] != "none"])
            rows, samples = rows + new, samples + own
            for _ in range(1 + (n == 1 and rules == Rules())):  # an arrival that is run again changes nothing
                got = incremental.arrive(spark.createDataFrame(new, SCHEMA), spark.createDataFrame(own, "sample string, grp int"), path, n, rules)
            assert values(got) == values(whole(spark, rows, samples, rules))


def test_only_new_tables_are_tested(spark, tmp_path):
    path, own = f"file://{tmp_path}/x", [("f1", 1), ("m1", 2)]
    rows = [("f1", 1, k, 2) for k in range(10)] + [("m1", 2, k, 2) for k in range(5, 15)]
    incremental.arrive(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(own, "sample string, grp int"), path, 0)
    assert spark.read.parquet(f"{path}/tests/arrival=0").count() == 3
    # A k-mer more of the same sample makes no table that was not there.
    got = incremental.arrive(spark.createDataFrame([("f1", 1, 99, 5), (None, 1, 3, 3)], SCHEMA), spark.createDataFrame(own, "sample string, grp int"), path, 1)
    assert spark.read.parquet(f"{path}/tests/arrival=1").count() == 0 and got.count() == 16


def test_an_empty_arrival(spark, tmp_path):
    path = f"file://{tmp_path}/x"
    none = spark.createDataFrame([], SCHEMA)
    assert incremental.arrive(none, none.select("sample", "grp"), path, 0).count() == 0
    got = incremental.arrive(spark.createDataFrame([("f1", 1, 7, 2)], SCHEMA), spark.createDataFrame([("f1", 1)], "sample string, grp int"), path, 1)
    assert values(got) == [(7, 1, 0, 0, 0, 1.0)]
