"""Long count tables as wide matrices and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.parsing import lenient_number


def count_matrix(counts: DataFrame, samples: list[str], missing: int = 0) -> DataFrame:
    """One row per k-mer and one column per sample, in the given order: a single shuffle on the k-mer."""
    wide = counts.groupBy("kmer").pivot("sample", samples).agg(F.first("cnt"))
    return wide.na.fill(missing, samples)


def count_arrays(counts: DataFrame, samples: list[str], missing: int = 0) -> DataFrame:
    """``(kmer, counts)``: one array per k-mer with the counts of all samples in the given order, in a single shuffle.

    Arrays hold any number of samples and any names, where columns do not.
    """
    wide = counts.groupBy("kmer").pivot("sample", samples).agg(F.first("cnt"))
    cells = [F.coalesce(F.col("`" + s.replace("`", "``") + "`"), F.lit(missing).cast("long")) for s in samples]
    return wide.select("kmer", F.array(*cells).alias("counts"))


def right_counts(counts: DataFrame, samples: list[str], missing: int = 1) -> DataFrame:
    """``(kmer, sample, cnt)``: each k-mer of any sample for every one of ``samples``, with its count there or ``missing``."""
    cells = count_arrays(counts, samples, missing).select("kmer", F.posexplode("counts").alias("at", "cnt"))
    return cells.select("kmer", F.get(F.array(*map(F.lit, samples)), F.col("at")).alias("sample"), "cnt")


def header_of(lines: DataFrame) -> str:
    """The first line of the first file; each part file of a table has the same."""
    first = lines.first()
    return "" if first is None else first["value"] or ""


def body(lines: DataFrame, header: str | None = None) -> DataFrame:
    """``lines`` without nulls and without those equal to ``header``."""
    rows = lines.where("value is not null")
    return rows if header is None else rows.where(F.col("value") != header)


def read_matrix(lines: DataFrame, samples: list[str] | None = None, header: str | None = None) -> DataFrame:
    """``(kmer, sample, cnt)`` from tab-separated lines ``value``; cells are parsed leniently, short rows have fewer cells.

    Names come from ``header`` where ``samples`` are not given; lines equal to the header are no rows.
    """
    if samples is None:
        if header is None:
            raise ValueError("sample names or a header line are needed")
        samples = header.split("\t")[1:]
    cells = F.split("value", "\t", -1)
    names = F.array(*map(F.lit, samples))
    rows = body(lines, header).select(cells.getItem(0).alias("kmer"), F.posexplode(F.slice(cells, 2, len(samples))).alias("at", "cell"))
    return rows.select("kmer", F.get(names, F.col("at")).alias("sample"), lenient_number(F.col("cell")).alias("cnt"))


def line_tables(lines: DataFrame, n1: int, cmin1: float = 1, cmin2: float = 0, header: str | None = None) -> DataFrame:
    """``(kmer, a, b, c, d, value)``: high and low cells of the first ``n1`` samples and of the others, line by line.

    Cells are counted as they stand, without a shuffle: short lines have fewer, and an empty line has none.
    """
    fields = F.split("value", "\t", -1)
    values = F.transform(F.slice(fields, 2, F.greatest(F.size(fields) - 1, F.lit(0))), lenient_number)
    rows = body(lines, header).select("value", fields.getItem(0).alias("kmer"), values.alias("_v"))

    def number(v: F.Column, keep) -> F.Column:
        return F.size(F.filter(v, keep)).cast("long")

    def high(v: F.Column) -> F.Column:
        return ~F.isnan(v) & (v >= cmin1)

    def low(v: F.Column) -> F.Column:
        return ~F.isnan(v) & (v < cmin1) & (v <= cmin2)

    one, two = F.slice("_v", 1, n1), F.slice("_v", n1 + 1, F.greatest(F.size("_v"), F.lit(0)))
    return rows.select("kmer", number(one, high).alias("a"), number(one, low).alias("b"), number(two, high).alias("c"), number(two, low).alias("d"), "value")


def field_means(lines: DataFrame, first: int = 7, header: str | None = None) -> DataFrame:
    """``(field, avg)`` of tab-separated lines: the mean of the values above 1 in each 1-based field from ``first`` on."""
    cells = body(lines, header).select(F.posexplode(F.split("value", "\t", -1)).alias("at", "cell")).where(F.col("at") >= first - 1)
    values = cells.select((F.col("at") + 1).alias("field"), lenient_number(F.col("cell")).alias("v"))
    return values.where((F.col("v") > 1) & ~F.isnan("v")).groupBy("field").agg(F.avg("v").alias("avg"))
