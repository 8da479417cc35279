"""Column helpers for month text (``MMYYYY``) and vintage text (``YYYYQn``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what a vintage name looks like.
VINTAGE_PATTERN = r"^(\d{4})(Q[1-4])$"


def _year(period: Column) -> Column:
    return F.substring(period, 3, 4).try_cast("int")


def _month(period: Column) -> Column:
    return F.substring(period, 1, 2).try_cast("int")


def month_index(period: Column) -> Column:
    """Months as a running integer, so that differences are ages and order is time."""
    return _year(period) * 12 + _month(period)


def month_text(index: Column) -> Column:
    """Inverse of :func:`month_index`."""
    month = F.pmod(index - 1, F.lit(12)) + 1
    year = F.floor((index - 1) / 12).cast("int")
    return F.concat(F.lpad(month.cast("string"), 2, "0"), year.cast("string"))


def quarter_key(period: Column) -> Column:
    """``year * 10 + quarter`` of a month."""
    return (_year(period) * 10 + F.ceil(_month(period) / 3)).cast("int")


def vintage_year(vintage: Column) -> Column:
    return F.substring(vintage, 1, 4).cast("int")


def vintage_quarter(vintage: Column) -> Column:
    return F.substring(vintage, 5, 2)


def is_vintage(text: Column) -> Column:
    return F.coalesce(text.rlike(VINTAGE_PATTERN), F.lit(False))


def require_vintage(text: Column) -> Column:
    """The text itself when well formed; otherwise the job fails with a message."""
    return F.when(is_vintage(text), text).otherwise(
        F.raise_error(F.concat(F.lit("vintage must look like 2018Q1, got "), F.coalesce(text, F.lit("NULL"))))
        .cast("string")
    )
