"""Exact decimal ratios, rounded half away from zero to two places."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Counts fit in 20 digits; a quotient then keeps 18 decimals before it is rounded.
_WHOLE = "decimal(20,0)"


def mean(total: Column, count: Column) -> Column:
    return F.round(total.cast(_WHOLE) / F.nullif(count.cast(_WHOLE), F.lit(0)), 2)


def percent(part: Column, whole: Column) -> Column:
    """Null where ``whole`` is zero or null."""
    return mean(part.cast(_WHOLE) * F.lit(100), whole)
