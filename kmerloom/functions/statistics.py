"""Fisher's exact test and what it needs, as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TABLE = 64
TOLERANCE = 1e-7
ALTERNATIVES = ("two", "less", "greater", "point")


def ln_factorial(n: Column) -> Column:
    """ln n!: a table for small n, Stirling's series beyond, so that no array grows with the number of samples."""
    table = F.array(*[F.lit(math.lgamma(i + 1)) for i in range(TABLE)])
    x = n.cast("double")
    series = x * F.ln(x) - x + 0.5 * F.ln(2 * math.pi * x) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
    return F.when(n < TABLE, F.get(table, n.cast("int"))).otherwise(series)


def _log_terms(a: Column, b: Column, c: Column, d: Column) -> tuple[Column, Column, Column]:
    """Bounds of the support of the table's margins, and the part of the logarithm that they fix."""
    r1, r2, c1 = a + b, c + d, a + c
    margins = ln_factorial(r1) + ln_factorial(r2) + ln_factorial(c1) + ln_factorial(b + d) - ln_factorial(r1 + r2)
    return F.greatest(F.lit(0).cast("long"), c1 - r2), F.least(r1, c1), margins


def _log_p(x: Column, a: Column, b: Column, c: Column, d: Column, margins: Column) -> Column:
    return margins - (ln_factorial(x) + ln_factorial(a + b - x) + ln_factorial(a + c - x) + ln_factorial(d - a + x))


def fisher_exact(a: Column, b: Column, c: Column, d: Column, alternative: str = "two") -> Column:
    """The p-value of the table [[a, b], [c, d]] as one expression; ``point`` is the probability of the table itself.

    ``two`` sums the probabilities of all tables with the same margins that are no likelier than this one, up to a
    relative 1e-7. P-values are at most 1. For many rows ``with_fisher`` computes each distinct table once.
    """
    _known(alternative)
    lo, hi, margins = _log_terms(a, b, c, d)
    if alternative == "point":
        return F.exp(_log_p(a, a, b, c, d, margins))
    if alternative == "two":
        # The table's own logarithm is the last of the array, so that it is computed once.
        logs = F.transform(F.concat(F.sequence(lo, hi), F.array(a)), lambda x: _log_p(x, a, b, c, d, margins))
        kept = F.transform(F.array(logs), lambda ls: F.filter(F.slice(ls, 1, F.size(ls) - 1), lambda l: l <= F.element_at(ls, -1) + TOLERANCE))[0]
    else:
        kept = F.transform(F.sequence(lo, a) if alternative == "less" else F.sequence(a, hi), lambda x: _log_p(x, a, b, c, d, margins))
    return F.least(F.lit(1.0), F.aggregate(kept, F.lit(0.0), lambda s, l: s + F.exp(l)))


def _known(alternative: str) -> None:
    if alternative not in ALTERNATIVES:
        raise ValueError(f"alternative {alternative!r} is none of {ALTERNATIVES}")


def fisher_tables(tables: DataFrame, alternative: str = "two", column: str = "pval", cells: tuple[str, str, str, str] = ("a", "b", "c", "d")) -> DataFrame:
    """``(cells ..., column)``: each distinct table of ``tables`` with its p-value.

    The terms of a sum are rows, added up by table. What is asked of the p-value later is thereby asked of an aggregate,
    which the optimizer cannot move below the distinct tables, and all arithmetic is compiled.
    """
    _known(alternative)
    own = tables.select(*cells).where(F.col(cells[0]).isNotNull()).distinct()
    a, b, c, d = (F.col(x) for x in cells)
    lo, hi, margins = _log_terms(a, b, c, d)
    x = {"two": F.sequence(lo, hi), "less": F.sequence(lo, a), "greater": F.sequence(a, hi), "point": F.array(a)}[alternative]
    terms = own.select(*cells, margins.alias("_m"), F.explode(x).alias("_x"))
    terms = terms.select(*cells, _log_p(F.col("_x"), a, b, c, d, F.col("_m")).alias("_l"), _log_p(a, a, b, c, d, F.col("_m")).alias("_own"))
    if alternative == "two":
        terms = terms.where(F.col("_l") <= F.col("_own") + TOLERANCE)
    total = F.sum(F.exp("_l"))
    return terms.groupBy(*cells).agg((total if alternative == "point" else F.least(F.lit(1.0), total)).alias(column))


def with_fisher(tables: DataFrame, alternative: str = "two", column: str = "pval", cells: tuple[str, str, str, str] = ("a", "b", "c", "d")) -> DataFrame:
    """``tables`` with the p-value of each row's table, computed once for each distinct table and joined back.

    There are at most (n1 + 1)^2 (n2 + 1)^2 distinct tables for groups of n1 and n2 samples, and far fewer in data; Spark
    chooses the join by their actual size.
    """
    return tables.join(fisher_tables(tables, alternative, column, cells), list(cells))
