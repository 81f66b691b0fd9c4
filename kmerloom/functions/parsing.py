"""Lenient number parsing and number formatting."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^[ \t]*([+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)"
SPECIAL = r"(?i)^[ \t]*([+-]?)(nan|inf)"


def lenient_number(text: Column) -> Column:
    """The number a text starts with, after blanks; ``nan`` and ``inf`` are numbers; anything else, null included, is 0."""
    special = F.lower(F.regexp_extract(text, SPECIAL, 2))
    sign = F.when(F.regexp_extract(text, SPECIAL, 1) == "-", -1.0).otherwise(1.0)
    plain = F.regexp_extract(text, NUMBER, 1).try_cast("double")
    value = F.when(special == "nan", F.lit(float("nan"))).when(special == "inf", sign * F.lit(float("inf"))).otherwise(plain)
    return F.coalesce(value, F.lit(0.0))


def six_digits(values: Column | str) -> Column:
    """Six significant digits, without padding. Asked for distinct p-values only, of which there are few."""

    @F.pandas_udf("string")
    def run(numbers: pd.Series) -> pd.Series:
        return numbers.map(lambda v: None if pd.isna(v) else f"{v:.6g}")

    return run(values)
