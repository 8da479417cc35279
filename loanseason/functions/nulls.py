"""NULL-aware aggregate and arithmetic helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def latest(value: Column, order: Column, where: Column | None = None) -> Column:
    """Value at the largest ``order`` among rows where the value is present."""
    keep = value.isNotNull() if where is None else value.isNotNull() & where
    return F.max_by(value, F.when(keep, order))


def earliest(value: Column, order: Column) -> Column:
    """Value at the smallest ``order`` among rows where the value is present."""
    return F.min_by(value, F.when(value.isNotNull(), order))


def share(condition: Column) -> Column:
    """Share of rows on which the condition is true; unknown counts as false."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def ratio(top: Column, bottom: Column) -> Column:
    """Quotient that is NULL unless the divisor is positive."""
    return F.when(bottom > 0, top / bottom)
