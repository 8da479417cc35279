"""Vintage-based splits and the summaries that describe them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SplitBands
from ..functions.dates import vintage_quarter, vintage_year
from ..schema import ALL_FEATURES, TARGETS
from ..session import stored


def split_name(vintage: Column, bands: SplitBands = SplitBands()) -> Column:
    """First band that holds the vintage year; loans outside all bands go to the rest."""
    year = vintage_year(vintage)
    named = None
    for name, (low, high) in bands.items():
        hit = year.between(low, high)
        named = F.when(hit, name) if named is None else named.when(hit, name)
    return named.otherwise(bands.rest)


def with_split(features: DataFrame, bands: SplitBands = SplitBands()) -> DataFrame:
    vintage = F.col("vintage")
    return features.withColumns(
        {
            "vintage_year": vintage_year(vintage),
            "vintage_quarter": vintage_quarter(vintage),
            "split": split_name(vintage, bands),
        }
    )


def load_split(
    features: DataFrame,
    split: str,
    bands: SplitBands = SplitBands(),
    columns: Sequence[str] | None = None,
    only_eligible: bool = True,
) -> DataFrame:
    """Rows of one band. On a store partitioned by vintage the band prunes partitions."""
    low, high = bands.bounds(split)
    rows = features.where(vintage_year(F.col("vintage")).between(low, high))
    if only_eligible:
        rows = rows.where(F.col("eligible") == 1)
    return rows.select(*columns) if columns else rows


def training_frame(
    features: DataFrame, split: str, target: str, bands: SplitBands = SplitBands(), columns: Sequence[str] | None = None
) -> DataFrame:
    """Keys, model inputs and one label (as ``y_true``) of a band; an empty band is an error."""
    if target not in TARGETS:
        raise ValueError(f"unknown target {target!r}; expected one of {sorted(TARGETS)}")
    chosen = list(columns or ALL_FEATURES)
    rows = load_split(features, split, bands).select(
        "vintage", "LOAN_ID", *chosen, F.col(TARGETS[target]).alias("y_true")
    )
    kept, seen = stored(rows, "training-frame")
    if not seen["rows"]:
        raise RuntimeError(f"no eligible loans in split {split}; build those vintages first")
    return kept


def require_rows(df: DataFrame, message: str) -> DataFrame:
    if df.isEmpty():
        raise RuntimeError(message)
    return df


def _eligible_only(column: str) -> Column:
    return F.when(F.col("eligible") == 1, F.col(column))


def build_summary(features: DataFrame) -> DataFrame:
    """Loans, eligible loans and label rates over everything given."""
    return features.agg(
        F.count("*").alias("loans"),
        F.coalesce(F.sum("eligible"), F.lit(0)).alias("eligible"),
        F.round(F.avg(_eligible_only("y_prepay")), 6).alias("prepay_rate"),
        F.round(F.avg(_eligible_only("y_delinq_90p")), 6).alias("delinq_rate"),
    )


def split_summary(features: DataFrame, bands: SplitBands = SplitBands()) -> DataFrame:
    order = F.array_position(
        F.array(*[F.lit(name) for name, _ in bands.items()]), F.col("split")
    )
    return (
        features.groupBy(split_name(F.col("vintage"), bands).alias("split"))
        .agg(
            F.count("*").alias("loans"),
            F.sum("eligible").alias("eligible"),
            F.sum(_eligible_only("y_prepay")).alias("prepays"),
            F.sum(_eligible_only("y_delinq_90p")).alias("delinq90p"),
            F.round(F.avg(_eligible_only("y_prepay")), 4).alias("prepay_rate"),
            F.round(F.avg(_eligible_only("y_delinq_90p")), 4).alias("delinq_rate"),
        )
        .orderBy(F.when(order == 0, 99).otherwise(order))
    )


def prevalence_by_vintage(features: DataFrame) -> DataFrame:
    return (
        features.groupBy("vintage")
        .agg(
            F.count("*").alias("loans"),
            F.sum("eligible").alias("eligible"),
            F.round(F.avg(_eligible_only("y_delinq_90p")), 4).alias("delinq_rate"),
            F.round(F.avg(_eligible_only("y_prepay")), 4).alias("prepay_rate"),
        )
        .orderBy("vintage")
    )


def class_weights(features: DataFrame, split: str = "train", bands: SplitBands = SplitBands()) -> DataFrame:
    """Negatives per positive for each target.

    ``tree_weight`` is 1 when there is no positive; ``network_weight`` then equals the
    number of rows, because its divisor is at least one.
    """
    rows = load_split(features, split, bands)
    counts = rows.agg(
        F.count("*").alias("n"), *[F.coalesce(F.sum(y), F.lit(0)).alias(task) for task, y in TARGETS.items()]
    )
    long = counts.unpivot(["n"], list(TARGETS), "task", "pos")
    neg, pos = F.col("n") - F.col("pos"), F.col("pos")
    return long.select(
        "task",
        "n",
        "pos",
        F.round(F.when(pos == 0, 1.0).otherwise(neg / F.greatest(pos, F.lit(1))), 6).alias("tree_weight"),
        F.round(neg / F.greatest(pos, F.lit(1)), 6).alias("network_weight"),
    )
