"""Named views over the stores, their sizes, and a check of the lookup tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SplitBands
from ..functions.dates import vintage_quarter, vintage_year
from ..operators.splits import load_split
from . import files


def catalog_views(raw: DataFrame, features: DataFrame, bands: SplitBands = SplitBands()) -> dict[str, DataFrame]:
    """The frames behind the views, by name; nothing is read until one is used."""
    named = features.withColumns(
        {"orig_year": vintage_year(F.col("vintage")), "orig_qtr": vintage_quarter(F.col("vintage"))}
    )
    views = {"raw_monthly": raw, "features": named, "features_eligible": named.where(F.col("eligible") == 1)}
    for split, _ in bands.items():
        views[f"features_{split}"] = load_split(named, split, bands)
    return views


def register_views(raw: DataFrame, features: DataFrame, bands: SplitBands = SplitBands()) -> list[str]:
    views = catalog_views(raw, features, bands)
    for name, frame in views.items():
        frame.createOrReplaceTempView(name)
    return sorted(views)


def catalog_counts(raw: DataFrame, features: DataFrame, bands: SplitBands = SplitBands()) -> DataFrame:
    """Rows per view. The views over loan rows are counted together in one pass."""
    eligible = F.col("eligible") == 1
    year = vintage_year(F.col("vintage"))
    counts = {"features": F.count("*"), "features_eligible": F.count_if(eligible)}
    for split, (low, high) in bands.items():
        counts[f"features_{split}"] = F.count_if(eligible & year.between(low, high))
    loans = features.agg(*[c.alias(name) for name, c in counts.items()]).unpivot([], list(counts), "view", "rows")
    months = raw.agg(F.count("*").alias("rows")).select(F.lit("raw_monthly").alias("view"), "rows")
    return loans.unionByName(months)


def source_check(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """Presence, row count and columns of each lookup table."""
    parts = []
    for name, path in tables.items():
        if files.exists(spark, path):
            table = spark.read.parquet(path)
            parts.append(
                table.agg(F.count("*").alias("rows")).select(
                    F.lit(name).alias("source"), F.lit(True).alias("present"), "rows",
                    F.lit(",".join(table.columns)).alias("columns"),
                )
            )
        else:
            parts.append(
                spark.range(1).select(
                    F.lit(name).alias("source"), F.lit(False).alias("present"), F.lit(0).cast("long").alias("rows"),
                    F.lit(None).cast("string").alias("columns"),
                )
            )
    return reduce(DataFrame.unionByName, parts)
