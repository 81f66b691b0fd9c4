"""Presence of k-mers in two groups of samples, and its test."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parsing import six_digits
from ..functions.statistics import fisher_tables

CELLS = ("a", "b", "c", "d")


def presence(counts: DataFrame, n1: int, n2: int, cmin1: float = 1, cmin2: float = 0, missing: float | None = 0, feature: str = "kmer") -> DataFrame:
    """``(feature, a, b, c, d)``: high and low samples of group 1, then of group 2, from ``(feature, grp, cnt)``.

    A count is high from ``cmin1`` on, else low up to ``cmin2``, else neither; NaN is neither. ``n1`` and ``n2`` are the
    numbers of samples in the groups, those without any k-mer included; samples without a row count as ``missing``, or
    nowhere if that is None.
    """
    cnt = F.col("cnt").cast("double")
    high = ~F.isnan(cnt) & (cnt >= cmin1)
    low = ~F.isnan(cnt) & ~high & (cnt <= cmin2)

    def cells(grp: int, n: int) -> tuple[Column, Column]:
        own = F.col("grp") == grp
        absent = F.lit(n).cast("long") - F.count_if(own)
        zero = F.lit(0).cast("long")
        counted = missing is not None
        return F.count_if(own & high) + (absent if counted and missing >= cmin1 else zero), F.count_if(own & low) + (absent if counted and missing < cmin1 and missing <= cmin2 else zero)

    (a, b), (c, d) = cells(1, n1), cells(2, n2)
    return counts.groupBy(feature).agg(a.alias("a"), b.alias("b"), c.alias("c"), d.alias("d"))


def significant(tables: DataFrame, p_cut: float, alternative: str = "two", printed: bool = False) -> DataFrame:
    """Rows with p below ``p_cut``; ``printed``: up to ``p_cut`` itself, by p in six digits (the rule of older versions)."""
    tests = fisher_tables(tables, alternative)
    if printed:
        tests = tests.where(six_digits("pval").cast("double") <= p_cut)
    else:
        tests = tests.where(F.col("pval") < p_cut)
    return tables.join(tests, list(CELLS))


def group_specific(tables: DataFrame, n1: int, n2: int, group: int, share: float = 1.0) -> DataFrame:
    """Features high in every sample of one group (or in a ``share`` of them at least) and in none of the other."""
    own, other, n = ("a", "c", n1) if group == 1 else ("c", "a", n2)
    return tables.where((F.col(own) >= share * n) & (F.col(other) == 0))
