"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable
from sys import getsizeof

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import scratch, written

__all__ = ["Memo", "column", "free_name", "read_table", "scratch", "without", "written"]


class Memo(dict):
    """What ``make`` gives for a key, kept while keys and values take ``most`` bytes at most; then it begins anew.

    What is large for one entry (a very long word) is not kept.
    """

    ENTRY = 100

    def __init__(self, make: Callable, most: int) -> None:
        super().__init__()
        self.make, self.most, self.held = make, most, 0

    def __missing__(self, key):
        got = self.make(key)
        size = getsizeof(key) + getsizeof(got) + self.ENTRY
        if size <= 1024:
            if self.held + size > self.most:
                self.clear()
            self[key] = got
            self.held += size
        return got

    def clear(self) -> None:
        super().clear()
        self.held = 0


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have in any letter case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns that an operator is about to add."""
    drop = {n.lower() for n in names}
    return df.select(*[column(c) for c in df.columns if c.lower() not in drop])


def column(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")
