"""String helpers (all Catalyst built-ins)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def split_part(col, index: int, sep: str = r"\|") -> Column:
    """Element ``index`` (0-based) of ``col`` split on regex ``sep``; null if absent.

    ``F.get`` returns null out of range, where ``getItem`` raises under ANSI.
    """
    return F.get(F.split(_c(col), sep), F.lit(index))


def split_demographics(df: DataFrame, col: str = "demographics",
                       drop_source: bool = True) -> DataFrame:
    """``name|sex|age`` -> name, sex (trimmed), age (int, null if not a number)."""
    out = df.withColumns({
        "name": split_part(col, 0),
        "sex": F.trim(split_part(col, 1)),
        "age": F.trim(split_part(col, 2)).try_cast("int"),
    })
    return out.drop(col) if drop_source else out


def trim_column(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.trim(F.col(col)))


def upper_column(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.upper(F.col(col)))


def joined_label(sep: str, *cols) -> Column:
    """``concat_ws``: nulls are skipped, never turn the whole label null."""
    return F.concat_ws(sep, *[_c(c) for c in cols])
