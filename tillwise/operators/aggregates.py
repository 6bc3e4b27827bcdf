"""Grouped statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .clean import group_mode


def median_by(df: DataFrame, group: list[str] | str, col: str,
              out: str | None = None, accuracy: int = 10000) -> DataFrame:
    """Approximate median per group (``percentile_approx``; exact lower
    median while a group has fewer distinct values than ``accuracy``).
    Mergeable sketches: partial per task, merged after the shuffle."""
    group = [group] if isinstance(group, str) else list(group)
    return df.groupBy(*group).agg(
        F.percentile_approx(col, 0.5, accuracy).alias(out or f"median_{col}"))


def mode_of(df: DataFrame, col: str, groups: list[str] | None = None) -> DataFrame:
    """Most frequent non-null value (per group), ties to the smallest value."""
    return group_mode(df, col, groups)


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()
