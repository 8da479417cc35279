"""Readers for the rate series and the price index as they are published."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.market import long_series

# Accepted header names, best first.
STATE_NAMES = ("state", "st")
YEAR_NAMES = ("year",)
QUARTER_NAMES = ("qtr", "quarter")
INDEX_NAMES = ("index_nsa", "index_sa", "hpi", "index")


def read_series(spark: SparkSession, path: str) -> DataFrame:
    """Two columns by position, date and value; bad dates are dropped, bad values are NULL."""
    raw = spark.read.schema("date string, value string").option("header", "true").csv(path)
    return raw.select(
        F.try_to_timestamp("date").cast("date").alias("date"), F.col("value").try_cast("double").alias("value")
    ).where(F.col("date").isNotNull())


def read_rate_series(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """All series in long form, ready for the monthly collapse."""
    return long_series({name: read_series(spark, path) for name, path in paths.items()})


def read_price_index(spark: SparkSession, path: str) -> DataFrame:
    """``state, year, qtr, hpi_index`` from any of the known headers, or from four bare columns."""
    first = spark.read.text(path).first()
    if first is None:
        raise ValueError(f"{path} is empty")
    header = [name.strip().strip('"').lower() for name in first.value.split(",")]
    chosen = [next((n for n in names if n in header), None) for names in (STATE_NAMES, YEAR_NAMES, QUARTER_NAMES, INDEX_NAMES)]
    if all(chosen):
        schema = ", ".join(f"`c{i}` string" for i in range(len(header)))
        raw = spark.read.schema(schema).option("header", "true").option("enforceSchema", "true").csv(path)
        columns = [F.col(f"c{header.index(name)}") for name in chosen]
    elif len(header) == 4:
        raw = spark.read.schema("c0 string, c1 string, c2 string, c3 string").csv(path)
        columns = [F.col(f"c{i}") for i in range(4)]
    else:
        raise ValueError(f"unrecognised price index columns: {header}")
    state, year, quarter, index = columns
    return raw.select(
        state.alias("state"), year.cast("int").alias("year"), quarter.alias("qtr"),
        index.try_cast("double").alias("hpi_index"),
    )
