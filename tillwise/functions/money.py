"""Order-independent money arithmetic.

Floating sums depend on the order rows meet, which differs between runs,
partitionings and engines.  Money is therefore summed as whole cents in a
64-bit integer (exact, associative) and turned back into a double once at
the end.  Rounding to cents is half-up on the double value,
``floor(x * 100 + 0.5)``: each step is one IEEE operation, so any engine
produces the same cents for the same input.

Averages (prices, discounts, scores, window frames) are not money totals:
their inputs keep their own precision (``functions.exact``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_units(col, scale: int = 2) -> Column:
    """Round half-up to ``scale`` decimals and return the integer units."""
    return F.floor(_c(col) * (10 ** scale) + 0.5).cast("long")


def cents(col) -> Column:
    return to_units(col, 2)


def cents_to_money(col) -> Column:
    return _c(col).cast("double") / 100
