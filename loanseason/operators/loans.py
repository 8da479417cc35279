"""One row per loan: origination snapshot, window features, labels, horizon, market context.

Everything about a loan comes from one grouping of its monthly rows. Each measure
is a conditional aggregate, so no window is scanned or joined on its own, and
rows are combined before they are shuffled: what travels is about one row per
loan, not one per month.

The origination snapshot holds text. Text cannot live in the fixed-width buffer of
a hash aggregate, and Spark would sort the whole panel instead. As those columns
hardly change over the life of a loan, they join the grouping key of a first, hashed
step; a second step over the one or two rows that remain per loan picks the earliest
known value of each.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..config import ExitCodes, Windows
from ..functions.nulls import earliest, latest, ratio
from ..schema import (
    FEATURE_ROW_COLUMNS,
    HORIZON_COLUMNS,
    LABEL_COLUMNS,
    MARKET_FEATURES,
    ORIGINATION_COLUMNS,
    WINDOW_FEATURES,
)
from .market import MARKET_SERIES, with_market
from .panel import with_effective_age

LOAN_KEY = ("vintage", "LOAN_ID")


@dataclass(frozen=True)
class Measure:
    """How to compute a value from monthly rows and how to merge partial values."""

    name: str
    compute: Column
    merge: Callable[[Column], Column]


def _flag(condition: Column) -> Column:
    return F.max(F.when(condition, 1).otherwise(0))


def window_measures(windows: Windows, codes: ExitCodes) -> list[Measure]:
    age, late = F.col("age"), F.col("dlq_num")
    inside = age <= windows.feature_last
    out = [
        Measure("f12_n_obs", F.count_if(inside), F.sum),
        Measure("f12_dlq_max", F.max(F.when(inside, late)), F.max),
        Measure("f12_mod_flag", _flag(inside & (F.col("MOD_FLAG") == codes.modified)), F.max),
        Measure("f12_forbearance", _flag(inside & (F.col("DLQ_STATUS") == codes.forbearance_status)), F.max),
        Measure("f12_last_age_seen", F.max(F.when(inside, age)), F.max),
    ]
    for months, days in ((1, 30), (2, 60), (3, 90)):
        out.append(Measure(f"f12_months_{days}p", F.count_if(inside & (late >= months)), F.sum))
        out.append(Measure(f"f12_ever_{days}", _flag(inside & (late >= months)), F.max))
    return out


def label_measures(windows: Windows, codes: ExitCodes) -> list[Measure]:
    inside = F.col("age").between(windows.label_first, windows.label_last)
    return [
        Measure("y_delinq_90p", _flag(inside & (F.col("dlq_num") >= 3)), F.max),
        Measure("y_prepay", _flag(inside & (F.col("ZB_CODE") == codes.prepaid)), F.max),
        Measure("y_default_zb", _flag(inside & F.col("ZB_CODE").isin(*codes.default)), F.max),
        Measure("lw_forbearance", _flag(inside & (F.col("DLQ_STATUS") == codes.forbearance_status)), F.max),
        Measure("lw_n_obs", F.count_if(inside), F.sum),
    ]


def horizon_measures() -> list[Measure]:
    ended = F.col("ZB_CODE").isNotNull()
    return [
        Measure("observed_through_age", F.max("age"), F.max),
        Measure("ever_terminal", _flag(ended), F.max),
        Measure("first_terminal_age", F.min(F.when(ended, F.col("age"))), F.min),
    ]


def aggregate_loans(
    months: DataFrame,
    measures: Sequence[Measure],
    last_values: dict[str, Column] | None = None,
    snapshot: Sequence[str] = (),
) -> DataFrame:
    """Group aged monthly rows by loan.

    ``measures`` merge freely. ``last_values`` maps an output name to a column whose
    value at the highest ``tick`` (where present) is wanted. ``snapshot`` columns
    give their earliest known value.
    """
    tick = F.col("tick")
    last_values = last_values or {}
    aggregates = [m.compute.alias(m.name) for m in measures]
    aggregates += [latest(column, tick).alias(name) for name, column in last_values.items()]
    if not any(isinstance(months.schema[c].dataType, StringType) for c in snapshot):
        firsts = [earliest(F.col(c), tick).alias(c) for c in snapshot]
        return months.groupBy(*LOAN_KEY).agg(*firsts, *aggregates)

    aggregates += [F.max(F.when(column.isNotNull(), tick)).alias(f"{n}__tick") for n, column in last_values.items()]
    partial = months.groupBy(*LOAN_KEY, *snapshot).agg(F.min(tick).alias("first_tick"), *aggregates)
    merged = [earliest(F.col(c), F.col("first_tick")).alias(c) for c in snapshot]
    merged += [m.merge(F.col(m.name)).alias(m.name) for m in measures]
    merged += [latest(F.col(n), F.col(f"{n}__tick")).alias(n) for n in last_values]
    return partial.groupBy(*LOAN_KEY).agg(*merged)


def origination_snapshot(panel: DataFrame) -> DataFrame:
    return loan_features(panel, columns=ORIGINATION_COLUMNS)


def window_features(panel: DataFrame, windows: Windows = Windows(), codes: ExitCodes = ExitCodes()) -> DataFrame:
    return loan_features(panel, windows=windows, codes=codes, columns=WINDOW_FEATURES)


def labels(panel: DataFrame, windows: Windows = Windows(), codes: ExitCodes = ExitCodes()) -> DataFrame:
    """Competing-risk labels; ``y_censored`` marks loans with no event and no forbearance."""
    loans = loan_features(panel, windows=windows, codes=codes, columns=LABEL_COLUMNS)
    quiet = (F.col("y_delinq_90p") == 0) & (F.col("y_prepay") == 0) & (F.col("lw_forbearance") == 0)
    return loans.withColumn("y_censored", F.when(quiet, 1).otherwise(0))


def outcomes(panel: DataFrame, windows: Windows = Windows(), codes: ExitCodes = ExitCodes()) -> DataFrame:
    """Labels, horizon and eligibility without any inputs, for summaries."""
    return loan_features(panel, windows=windows, codes=codes, columns=[*LABEL_COLUMNS, *HORIZON_COLUMNS, "eligible"])


def eligibility(panel: DataFrame, windows: Windows = Windows(), strict: bool = False) -> DataFrame:
    """Horizon and eligibility.

    By default a loan that ended at any age counts as resolved. ``strict`` also asks
    that it was still observed after the feature window, so that loans which ended
    inside it no longer count as observed zeros.
    """
    loans = loan_features(panel, windows=windows, columns=[*HORIZON_COLUMNS, "eligible"])
    if strict:
        alive = F.col("observed_through_age") > windows.feature_last
        loans = loans.withColumn("eligible", F.when(alive, F.col("eligible")).otherwise(0))
    return loans


# Columns computed from other columns of the loan row.
_INPUTS = {
    "f12_upb_paid_ratio": ("ORIG_UPB", "f12_last_upb"),
    "hpi_state_ratio_curr_to_orig": ("hpi_state_curr", "hpi_state_orig"),
    "rate_incentive": ("ORIG_RATE", "macro_mortgage30us"),
    "est_current_ltv_from_oltv": ("OLTV", "hpi_state_curr", "hpi_state_orig"),
    "eligible": ("observed_through_age", "ever_terminal"),
}


def loan_features(
    panel: DataFrame,
    rates: DataFrame | None = None,
    price_index: DataFrame | None = None,
    windows: Windows = Windows(),
    codes: ExitCodes = ExitCodes(),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The full loan row, or only ``columns`` of it.

    A missing lookup table leaves its columns NULL. Measures that no wanted column needs
    are not computed.
    """
    shown = list(columns) if columns else [c for c in FEATURE_ROW_COLUMNS if c not in LOAN_KEY]
    needed = set(shown) | {i for c in shown for i in _INPUTS.get(c, ())}
    in_window = F.col("age") <= windows.feature_last
    months = with_effective_age(panel)
    if needed & set(MARKET_SERIES):
        months = with_market(months, rates, price_index, in_window)
    last_values = {"f12_last_upb": F.when(in_window, F.col("CURRENT_UPB"))}
    last_values |= {s: F.when(in_window, F.col(s)) for s in MARKET_SERIES if s in months.columns}
    measures = window_measures(windows, codes) + label_measures(windows, codes) + horizon_measures()
    loans = aggregate_loans(
        months,
        [m for m in measures if m.name in needed],
        {n: c for n, c in last_values.items() if n in needed},
        [c for c in ORIGINATION_COLUMNS if c in needed],
    )
    return _derived(loans, needed, windows).select(*LOAN_KEY, *shown)


def _derived(loans: DataFrame, needed: set[str], windows: Windows) -> DataFrame:
    """Ratios and flags over the aggregated values; market series that were not joined are NULL."""
    absent = {s: F.lit(None).cast("double") for s in MARKET_SERIES if s in needed and s not in loans.columns}
    current, original = F.col("hpi_state_curr"), F.col("hpi_state_orig")
    growth = F.when((original > 0) & (current > 0), current / original)
    resolved = (F.col("observed_through_age") >= windows.label_last) | (F.col("ever_terminal") == 1)
    formulas = {
        "f12_upb_paid_ratio": ratio(F.col("ORIG_UPB") - F.col("f12_last_upb"), F.col("ORIG_UPB")),
        "hpi_state_ratio_curr_to_orig": ratio(current, original),
        "rate_incentive": F.col("ORIG_RATE") - F.col("macro_mortgage30us"),
        "est_current_ltv_from_oltv": F.when(F.col("OLTV") > 0, F.col("OLTV") / growth),
        "eligible": F.when(resolved, 1).otherwise(0),
    }
    return loans.withColumns(absent).withColumns({n: f for n, f in formulas.items() if n in needed})


def market_features(
    panel: DataFrame, rates: DataFrame | None, price_index: DataFrame | None, windows: Windows = Windows()
) -> DataFrame:
    """Only the market columns of the loan row."""
    return loan_features(panel, rates, price_index, windows, columns=MARKET_FEATURES)
