"""Incremental association: samples arrive, stored cells change, and only tables that are new are tested.

What is kept under a folder, by the number of the arrival:

* ``counts`` the arrival's own counts, below the least count as well, since a sample may go on in a later arrival;
* ``samples`` its samples, with or without k-mers;
* ``cells`` for every k-mer, in how many samples of each group it is seen, high and low: the cells before, and what the
  arrival changes;
* ``tests`` the p-values of the 2 x 2 tables that no arrival before had.

An arrival writes under its own number alone, so that one that failed is simply run again. Groups grow with each arrival,
and so do the cells of k-mers that are absent: they are made from the groups' sizes when tables are asked for.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.statistics import fisher_tables

CELLS = ("a", "b", "c", "d")
SUMS = ("high1", "low1", "seen1", "high2", "low2", "seen2")


@dataclass(frozen=True)
class Rules:
    """Thresholds that hold for all arrivals of a folder."""

    min_count: int = 2
    cmin1: float = 1
    cmin2: float = 0
    alternative: str = "two"


def _read(spark: SparkSession, path: str, name: str, arrivals: range, schema: str) -> DataFrame:
    paths = [f"{path}/{name}/arrival={n}" for n in arrivals]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _contribution(cnt: Column, rules: Rules) -> dict[str, Column]:
    kept = cnt >= rules.min_count
    high = kept & (cnt >= rules.cmin1)
    return {"high": high, "low": kept & ~high & (cnt <= rules.cmin2), "seen": kept}


def arrive(counts: DataFrame, samples: DataFrame, path: str, number: int, rules: Rules = Rules()) -> DataFrame:
    """Add ``counts (sample, grp, kmer, cnt)`` of ``samples (sample, grp)`` as arrival ``number``, from 0; returns ``tested``.

    A sample that came before goes on: its counts add up, and what they said before is taken back. Repeated rows of an
    arrival add up as well. Rows without a sample, group, k-mer or count are no counts.
    """
    spark = counts.sparkSession
    kmer = counts.schema["kmer"].dataType.simpleString()
    schema = f"sample string, grp int, kmer {kmer}, cnt long"
    own = counts.where("sample is not null and grp is not null and kmer is not null and cnt is not null")
    own.groupBy("sample", "grp", "kmer").agg(F.sum("cnt").alias("cnt")).write.mode("overwrite").parquet(f"{path}/counts/arrival={number}")
    samples.select("sample", "grp").where("sample is not null").distinct().write.mode("overwrite").parquet(f"{path}/samples/arrival={number}")
    new = _read(spark, path, "counts", range(number, number + 1), schema)
    # Only what the arrival's own samples had before is read again.
    before = _read(spark, path, "counts", range(number), schema).join(new.select("sample").distinct(), "sample", "left_semi")
    before = before.groupBy("sample", "grp", "kmer").agg(F.sum("cnt").alias("old"))
    moved = new.join(before, ["sample", "grp", "kmer"], "left").withColumn("old", F.coalesce("old", F.lit(0).cast("long")))
    after, earlier = _contribution(F.col("old") + F.col("cnt"), rules), _contribution(F.col("old"), rules)
    changes = [F.sum(F.when(F.col("grp") == g, after[c].cast("long") - earlier[c].cast("long")).otherwise(0)).alias(f"{c}{g}") for g in (1, 2) for c in ("high", "low", "seen")]
    delta = moved.groupBy("kmer").agg(*changes)
    cells = _read(spark, path, "cells", range(max(0, number - 1), number), _cells_schema(kmer))
    merged = cells.unionByName(delta).groupBy("kmer").agg(*[F.sum(c).alias(c) for c in SUMS]).where("seen1 + seen2 > 0")
    merged.write.mode("overwrite").parquet(f"{path}/cells/arrival={number}")
    found = tables(spark, path, number, kmer, rules)
    known = _read(spark, path, "tests", range(number), "a long, b long, c long, d long, pval double")
    fisher_tables(found.select(*CELLS).distinct().join(known, list(CELLS), "left_anti"), rules.alternative).write.mode("overwrite").parquet(f"{path}/tests/arrival={number}")
    return tested(spark, path, number, kmer, rules)


def _cells_schema(kmer: str) -> str:
    return f"kmer {kmer}, " + ", ".join(f"{c} long" for c in SUMS)


def tables(spark: SparkSession, path: str, number: int, kmer: str = "long", rules: Rules = Rules()) -> DataFrame:
    """``(kmer, a, b, c, d)`` after arrival ``number``."""
    everyone = _read(spark, path, "samples", range(number + 1), "sample string, grp int").distinct()
    sizes = {r["grp"]: r["n"] for r in everyone.groupBy("grp").agg(F.count("*").alias("n")).collect()}
    cells = _read(spark, path, "cells", range(number, number + 1), _cells_schema(kmer))

    def cell(kind: str, grp: int) -> Column:
        absent = F.lit(sizes.get(grp, 0)) - F.col(f"seen{grp}")
        counts = 0 >= rules.cmin1 if kind == "high" else 0 < rules.cmin1 and 0 <= rules.cmin2
        return F.col(f"{kind}{grp}") + (absent if counts else F.lit(0))

    return cells.select("kmer", *[cell(kind, g).cast("long").alias(c) for c, (kind, g) in zip(CELLS, (("high", 1), ("low", 1), ("high", 2), ("low", 2)), strict=True)])


def tested(spark: SparkSession, path: str, number: int, kmer: str = "long", rules: Rules = Rules()) -> DataFrame:
    """``(kmer, a, b, c, d, pval)`` after arrival ``number``, by the tests of all arrivals up to it."""
    tests = _read(spark, path, "tests", range(number + 1), "a long, b long, c long, d long, pval double")
    return tables(spark, path, number, kmer, rules).join(tests, list(CELLS)).select("kmer", *CELLS, "pval")
