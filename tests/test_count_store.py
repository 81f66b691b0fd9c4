import uuid

from kmerloom.operators import matrix, presence, report
from kmerloom.sources import count_store

ROWS = [(k * 37 % 101, f"s{s}", 1 + s % 2, 1 + (k * s) % 5) for k in range(80) for s in range(6) if (k + s) % 3]
SCHEMA = "kmer long, sample string, grp int, cnt long"


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def stored(spark, tmp_path, rows=ROWS, name=None):
    name = name or f"store_{uuid.uuid4().hex}"
    return count_store.store_counts(spark.createDataFrame(rows, SCHEMA), f"file://{tmp_path}/{name}", name, 4), name


def values(df):
    return sorted(map(str, df.collect()))


def test_readers_of_a_store_shuffle_nothing(spark, tmp_path):
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        _compare(spark, tmp_path)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)


def _compare(spark, tmp_path):
    table, _ = stored(spark, tmp_path)
    plain = spark.createDataFrame(ROWS, SCHEMA)
    samples = [f"s{s}" for s in range(6)]
    tables = [presence.presence(x, 3, 3) for x in (table, plain)]
    arrays = [matrix.count_arrays(x, samples) for x in (table, plain)]
    kept = [report.annotated(t.where("a > 1"), x, samples) for t, x in zip(tables, (table, plain), strict=True)]
    for own, other in (tables, arrays, kept):
        assert values(own) == values(other)
    for own, _ in (tables, arrays, kept):
        assert "Exchange" not in plan_of(own)
    assert "Exchange" in plan_of(tables[1])


def test_new_samples_join_the_same_buckets(spark, tmp_path):
    first, name = stored(spark, tmp_path, [r for r in ROWS if r[1] in ("s0", "s1")])
    assert first.count() < len(ROWS)
    table, _ = stored(spark, tmp_path, [r for r in ROWS if r[1] not in ("s0", "s1")], name)
    assert values(table.select("kmer", "sample", "grp", "cnt")) == values(spark.createDataFrame(ROWS, SCHEMA))
    found = presence.presence(table, 3, 3)
    assert values(found) == values(presence.presence(spark.createDataFrame(ROWS, SCHEMA), 3, 3))
    assert "Exchange" not in plan_of(found)
    assert count_store.open_counts(spark, name).count() == len(ROWS)


def test_an_empty_store(spark, tmp_path):
    table, _ = stored(spark, tmp_path, [])
    assert presence.presence(table, 1, 1).count() == 0


def test_queries_count_once(spark, sf):
    """What reads the counts several times has no counting left in its plan: it reads the store."""
    from kmerloom.jobs import queries

    for name in ("annotated_significant", "significant_mean_depth", "kmer_lookup", "kmer_semi", "kmer_right_count"):
        plan = queries.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" not in plan and "Bucketed: true" in plan, name
