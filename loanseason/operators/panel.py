"""Monthly rows made ready for aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_index
from ..schema import CORE_COLUMNS

# Room for a month index below the loan age when both share one ordering number.
_MONTHS_PER_AGE = 1_000_000


def core_columns(panel: DataFrame) -> DataFrame:
    """Only the columns that later steps read, plus the vintage."""
    return panel.select("vintage", *CORE_COLUMNS)


def with_effective_age(panel: DataFrame) -> DataFrame:
    """Add ``age`` and ``dlq_num`` and keep rows at or after origination.

    The row that ends a loan has no age of its own although it carries the exit
    code; its age follows from the two dates. A status that is no number (such as
    forbearance) has no ``dlq_num``. ``tick`` orders the rows of one loan by age
    and, within an age, by month.
    """
    age = F.coalesce(F.col("LOAN_AGE"), month_index(F.col("ACT_PERIOD")) - month_index(F.col("ORIG_DATE")))
    aged = panel.withColumns(
        {
            "age": age.cast("int"),
            "dlq_num": F.col("DLQ_STATUS").try_cast("int"),
        }
    ).where(F.col("age") >= 0)
    return aged.withColumn(
        "tick",
        F.col("age").cast("long") * _MONTHS_PER_AGE + F.coalesce(month_index(F.col("ACT_PERIOD")), F.lit(0)),
    )
