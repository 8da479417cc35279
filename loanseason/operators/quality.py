"""The data-quality contract: one grouped pass over the loan rows, rules as data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import QualityContract
from ..functions.dates import vintage_year
from ..functions.nulls import share


def _text(value: Column, digits: int) -> Column:
    """Fixed number of decimals, without scientific notation."""
    return F.round(value, digits).cast(f"decimal(18,{digits})").cast("string")


def _statistics(features: DataFrame, contract: QualityContract) -> DataFrame:
    eligible = F.col("eligible") == 1
    null_shares = [share(F.col(n.column).isNull()).alias(n.label) for n in contract.null_limits]
    outside = [
        share(~F.col(r.column).between(r.low, r.high)).alias(f"oor_{r.column}") for r in contract.range_limits
    ]
    return features.groupBy("vintage").agg(
        F.count("*").alias("n_rows"),
        F.sum("eligible").alias("n_eligible"),
        *null_shares,
        *outside,
        F.avg(F.when(eligible, F.col("y_delinq_90p"))).alias("delinq_rate"),
        F.avg(F.when(eligible, F.col("y_prepay"))).alias("prepay_rate"),
    )


def _violations(contract: QualityContract) -> Column:
    """Messages of every broken rule, in rule order."""
    found = [
        F.when(F.col(n.label) > n.limit, F.concat(F.lit(f"{n.label}="), _text(F.col(n.label), 3)))
        for n in contract.active_null_limits()
    ]
    for r in contract.active_range_limits():
        name = f"oor_{r.column}"
        found.append(F.when(F.col(name) > r.tolerance, F.concat(F.lit(f"{name}="), _text(F.col(name), 4))))
    year, rate = vintage_year(F.col("vintage")), F.col("delinq_rate")
    for era in contract.eras:
        broken = year.between(era.first_year, era.last_year) & ~rate.between(era.low, era.high)
        message = F.concat(F.lit("delinq_rate="), _text(rate, 4), F.lit(f" outside [{era.low},{era.high}]"))
        found.append(F.when(broken, message))
    return F.array_compact(F.array(*found))


def quality_report(features: DataFrame, contract: QualityContract = QualityContract()) -> DataFrame:
    """One row per vintage with rates, NULL shares, broken rules and the verdict.

    A vintage without eligible loans has no label rate; the rate stays NULL and the
    era rule does not fire.
    """
    judged = _statistics(features, contract).withColumn("_found", _violations(contract))
    passed = F.size("_found") == 0
    shown = [n.label for n in contract.null_limits if n.enforced and n.column != "ORIG_RATE"]
    if contract.all_declared:
        shown = [n.label for n in contract.null_limits] + [f"oor_{r.column}" for r in contract.range_limits]
    return judged.select(
        "vintage",
        "n_rows",
        "n_eligible",
        *[F.round(c, 4).alias(c) for c in ["delinq_rate", "prepay_rate", *shown]],
        F.when(passed, "OK").otherwise(F.array_join("_found", "; ")).alias("violations"),
        passed.alias("passed"),
    ).orderBy("vintage")


def drift(report: DataFrame) -> DataFrame:
    return report.select("vintage", "delinq_rate", "prepay_rate")


def coverage(report: DataFrame) -> DataFrame:
    return report.select("vintage", "n_rows", "n_eligible", "passed")


def quality_summary(report: DataFrame) -> DataFrame:
    """Totals and the list of failed vintages; there are only as many rows as vintages."""
    failed = ~F.col("passed")
    return report.agg(
        F.count("*").alias("vintages_checked"),
        F.count_if("passed").alias("passed"),
        F.count_if(failed).alias("failed"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum("n_eligible"), F.lit(0)).alias("total_eligible"),
        F.array_join(F.array_sort(F.collect_list(F.when(failed, F.col("vintage")))), ",").alias("failed_vintages"),
        F.coalesce(F.max(failed.cast("int")), F.lit(0)).alias("exit_status"),
    )


def quality_gate(report: DataFrame) -> None:
    """Raise when a vintage fails, naming the first one and its broken rules."""
    failed = report.where(~F.col("passed")).orderBy("vintage").take(1)
    if failed:
        raise RuntimeError(f"quality check failed for {failed[0].vintage}: {failed[0].violations}")
