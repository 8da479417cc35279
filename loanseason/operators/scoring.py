"""Linear scorecards and additive attributions, as plain column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import SplitBands
from ..schema import TARGETS
from .splits import split_name


@dataclass(frozen=True)
class Term:
    """``weight * (value - center)``, where an absent value counts as ``fill``."""

    feature: str
    weight: float
    center: float = 0.0
    fill: float = 0.0

    def value(self) -> Column:
        return F.coalesce(F.col(self.feature).cast("double"), F.lit(float(self.fill)))

    def contribution(self) -> Column:
        return F.lit(self.weight) * (self.value() - F.lit(float(self.center)))


@dataclass(frozen=True)
class Scorecard:
    model: str
    task: str
    intercept: float
    terms: tuple[Term, ...]
    digits: int | None = None

    def score(self) -> Column:
        z = reduce(lambda acc, t: acc + t.contribution(), self.terms, F.lit(self.intercept))
        return sigmoid(z) if self.digits is None else F.round(sigmoid(z), self.digits)


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def apply_scorecards(
    features: DataFrame, cards: Sequence[Scorecard], bands: SplitBands = SplitBands()
) -> DataFrame:
    """Score every eligible loan with every card; the loan id stays on the rows."""
    results = [
        F.struct(
            F.lit(c.model).alias("model"),
            F.lit(c.task).alias("task"),
            F.col(TARGETS[c.task]).cast("int").alias("y_true"),
            c.score().alias("y_score"),
        )
        for c in cards
    ]
    return (
        features.where(F.col("eligible") == 1)
        .select("LOAN_ID", "vintage", split_name(F.col("vintage"), bands).alias("split"), F.explode(F.array(*results)).alias("r"))
        .select("r.model", "r.task", "split", "LOAN_ID", "vintage", "r.y_true", "r.y_score")
    )


def attributions(features: DataFrame, card: Scorecard) -> DataFrame:
    """Signed contribution of every feature to every loan's score, relative to the average loan."""
    means = _means(features, [card])
    return features.select("LOAN_ID", "vintage", *[F.round(v, 6).alias(t.feature) for t, v in _centred(card, means)])


def mean_attributions(features: DataFrame, cards: Sequence[Scorecard], top: int = 20) -> DataFrame:
    """Mean absolute contribution per task and feature: the ``top`` largest of each task.

    Two passes over the rows, each a plain aggregate over all cards; in between only one
    mean per feature reaches the driver, and afterwards there is one row per task and
    feature.
    """
    means = _means(features, cards)
    named = [(card.task, t.feature, v) for card in cards for t, v in _centred(card, means)]
    sizes = features.agg(*[F.avg(F.abs(v)).alias(f"size_{i}") for i, (_, _, v) in enumerate(named)])
    cells = F.array(
        *[
            F.struct(F.lit(task).alias("task"), F.lit(f).alias("feature"), F.round(f"size_{i}", 6).alias("mean_abs"))
            for i, (task, f, _) in enumerate(named)
        ]
    )
    place = F.row_number().over(W.partitionBy("task").orderBy(F.desc("mean_abs"), "feature"))
    long = sizes.select(F.explode(cells).alias("c")).select("c.*")
    return long.withColumn("_place", place).where(F.col("_place") <= top).drop("_place")


def compare_attributions(table: DataFrame, left: str = "delinq", right: str = "prepay", top: int = 25) -> DataFrame:
    """Both tasks' lists aligned on the feature, absent ones as zero, largest total first."""

    def side(task: str) -> DataFrame:
        return table.where(F.col("task") == task).select("feature", F.col("mean_abs").alias(task))

    both = side(left).join(side(right), "feature", "full").fillna(0.0, [left, right])
    return (
        both.withColumn("total", F.round(F.col(left) + F.col(right), 6)).orderBy(F.desc("total"), "feature").limit(top)
    )


def _means(features: DataFrame, cards: Sequence[Scorecard]) -> dict[Term, float]:
    terms = list(dict.fromkeys(t for card in cards for t in card.terms))
    row = features.agg(*[F.avg(t.value()).alias(f"m_{i}") for i, t in enumerate(terms)]).first()
    return {t: float(row[f"m_{i}"] or 0.0) for i, t in enumerate(terms)}


def _centred(card: Scorecard, means: dict[Term, float]) -> list[tuple[Term, Column]]:
    return [(t, F.lit(t.weight) * (t.value() - F.lit(means[t]))) for t in card.terms]
