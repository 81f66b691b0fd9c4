"""SQL functions: Fisher's exact test as a scalar function, k-mers of reads as a table function.

``fisher_exact(a, b, c, d)`` is an SQL expression, so that Spark compiles it and tests each distinct table once.
``kmers(TABLE(...), k)`` takes a table with the columns ``sample``, ``grp`` and ``seq``, whole batches of rows at a time, and
gives ``(sample, grp, kmer, cnt)``, a row for each distinct canonical k-mer of a batch; counts are added up by SQL. Without
``PARTITION BY`` rows stay where they are; with it, they are dealt as it says.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.functions import arrow_udtf

from .packing import MAX_K, counted_batches
from .statistics import TABLE, TOLERANCE


def _ln_factorial(n: str) -> str:
    table = ", ".join(f"{math.lgamma(i + 1)!r}D" for i in range(TABLE))
    x = f"CAST({n} AS DOUBLE)"
    series = f"{x} * ln({x}) - {x} + 0.5D * ln({2 * math.pi!r}D * {x}) + 1 / (12 * {x}) - 1 / (360 * pow({x}, 3)) + 1 / (1260 * pow({x}, 5))"
    return f"CASE WHEN {n} < {TABLE} THEN get(array({table}), CAST({n} AS INT)) ELSE {series} END"


def _function(name: str, takes: str, gives: str) -> str:
    return f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({takes}) RETURNS DOUBLE RETURN {gives}"


def register_fisher(spark: SparkSession, name: str = "fisher_exact") -> None:
    """The two-sided p-value of a 2 x 2 table; null where a cell is null."""
    margins = " + ".join(f"({_ln_factorial(n)})" for n in ("(a + b)", "(c + d)", "(a + c)", "(b + d)")) + f" - ({_ln_factorial('(a + b + c + d)')})"

    def log_p(x: str) -> str:
        return "margins - (" + " + ".join(f"({_ln_factorial(n)})" for n in (x, f"(a + b - {x})", f"(a + c - {x})", f"(d - a + {x})")) + ")"

    # The logarithms of all tables with these margins are rows of a scalar query: each is computed once.
    terms = f"(SELECT explode(sequence(greatest(0L, a - d), least(a + b, a + c))) AS x, {margins} AS margins)"
    known = " AND ".join(f"{c} IS NOT NULL" for c in "abcd")
    body = f"CASE WHEN {known} THEN (SELECT least(1.0D, sum(exp(l))) FROM (SELECT {log_p('x')} AS l, {log_p('a')} AS own FROM {terms}) WHERE l <= own + {TOLERANCE}D) END"
    spark.sql(_function(name, "a BIGINT, b BIGINT, c BIGINT, d BIGINT", body))


def spelled(values: np.ndarray, k: int) -> pa.Array:
    """Packed k-mers as text."""
    codes = (values[:, None] >> (2 * np.arange(k - 1, -1, -1))) & 3
    text = np.frombuffer(b"ACGT", np.uint8)[codes]
    return pa.Array.from_buffers(pa.string(), len(values), [None, pa.py_buffer(np.arange(len(values) + 1, dtype=np.int32) * k), pa.py_buffer(text.tobytes())])


def register_kmers(spark: SparkSession, name: str = "kmers") -> None:
    """The table function; k-mers have up to 31 bases and are text."""

    @arrow_udtf(returnType="sample string, grp int, kmer string, cnt bigint")
    class Kmers:
        def eval(self, reads: pa.RecordBatch, k: pa.Array) -> Iterator[pa.Table]:
            size = k[0].as_py() if len(k) else 0
            if not 1 <= size <= MAX_K:
                raise ValueError(f"k = {size} is not from 1 to {MAX_K}")
            for batch in counted_batches(iter([reads.select(["sample", "grp", "seq"])]), size, True):
                yield pa.table([batch.column(0), batch.column(1), spelled(batch.column(2).to_numpy(), size), batch.column(3)], names=["sample", "grp", "kmer", "cnt"])

    spark.udtf.register(name, Kmers)
