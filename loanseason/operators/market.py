"""Market context: monthly rates, state price index, and their join to monthly rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.dates import quarter_key
from ..functions.nulls import latest, ratio
from ..session import BROADCAST_ROW_LIMIT, stored

RATE_SERIES = ("mortgage30us", "unrate", "dgs10", "gs3m")
FILLED_SERIES = ("mortgage30us", "dgs10", "gs3m")

# Columns that the joins add to a monthly row.
MARKET_SERIES = (
    "macro_mortgage30us",
    "macro_unrate",
    "macro_dgs10",
    "macro_term_spread_10y3m",
    "hpi_state_curr",
    "hpi_state_growth_1y",
    "hpi_state_orig",
)


def long_series(frames: dict[str, DataFrame]) -> DataFrame:
    """Stack ``(date, value)`` frames into ``(series, date, value)``."""
    parts = [f.select(F.lit(name).alias("series"), "date", "value") for name, f in frames.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def monthly_rates(
    series: DataFrame, names: Sequence[str] = RATE_SERIES, filled: Sequence[str] = FILLED_SERIES
) -> DataFrame:
    """Merge dated series and keep the last known value of each per month.

    ``series`` holds ``(series, date, value)``. All series share one list of dates;
    those in ``filled`` carry their last value forward along it. After the grouping by
    date there is at most one row per calendar day, so the fill runs over a few
    thousand rows per series whatever the input size.
    """
    by_date = (
        series.where(F.col("date").isNotNull())
        .groupBy("date")
        .agg(*[F.max(F.when(F.col("series") == n, F.col("value"))).alias(n) for n in names])
    )
    carried = W.partitionBy("series").orderBy("date").rowsBetween(W.unboundedPreceding, W.currentRow)
    value = F.when(
        F.col("series").isin(*filled), F.last("value", ignorenulls=True).over(carried)
    ).otherwise(F.col("value"))
    day = (
        by_date.unpivot(["date"], list(names), "series", "value")
        .withColumn("value", value)
        .withColumn("period_mmyyyy", F.date_format("date", "MMyyyy"))
    )
    return day.groupBy("period_mmyyyy").agg(
        F.max("date").alias("date"),
        *[latest(F.col("value"), F.col("date"), F.col("series") == n).alias(n) for n in names],
    )


def price_index_changes(index: DataFrame, calendar: bool = False) -> DataFrame:
    """Normalise ``(state, year, qtr, hpi_index)`` and add the change over four rows.

    By default the change looks four rows back within the state, so a missing quarter
    shifts it. ``calendar`` looks up the same quarter of the previous year instead.
    A state has a few hundred quarters at most.
    """
    clean = (
        index.select(
            F.upper(F.trim(F.col("state").cast("string"))).alias("state"),
            (
                F.col("year").cast("int") * 10
                + F.regexp_extract(F.col("qtr").cast("string"), "([1-4])", 1).try_cast("int")
            ).alias("quarter_key"),
            F.col("hpi_index").try_cast("double").alias("hpi_index"),
        )
        .where(F.col("hpi_index").isNotNull())
    )
    if calendar:
        before = clean.select("state", (F.col("quarter_key") + 10).alias("quarter_key"), F.col("hpi_index").alias("prior"))
        with_prior = clean.join(before, ["state", "quarter_key"], "left")
    else:
        by_quarter = W.partitionBy("state").orderBy("quarter_key")
        with_prior = clean.withColumn("prior", F.lag("hpi_index", 4).over(by_quarter))
    return with_prior.select(
        "state", "quarter_key", "hpi_index", (ratio(F.col("hpi_index"), F.col("prior")) - 1).alias("hpi_yoy")
    )


def unique_lookup(table: DataFrame, keys: Sequence[str], latest_by: str | None = None) -> tuple[DataFrame, int]:
    """Store a lookup table with one row per key; return it with its number of rows.

    A repeated key would multiply monthly rows. With ``latest_by`` the latest row
    wins; without it a repeated key is an error.
    """
    row = F.struct(*[c for c in table.columns if c not in keys])
    chosen = F.max_by(row, F.col(latest_by)) if latest_by else F.first(row)
    known = table.dropna(subset=list(keys)).groupBy(*keys).agg(chosen.alias("_row"), F.count("*").alias("_times"))
    fixed, seen = stored(known.select(*keys, "_row.*", "_times"), "lookup", most=F.max("_times"))
    if latest_by is None and (seen["most"] or 0) > 1:
        repeated = fixed.where("_times > 1").first()
        raise ValueError(f"lookup table repeats key {tuple(repeated[k] for k in keys)}")
    return fixed.drop("_times"), seen["rows"]


def _attach(months: DataFrame, lookup: DataFrame, keys: dict[str, Column], wanted: Column, small: bool) -> DataFrame:
    """Left join a lookup on computed keys; rows that are not ``wanted`` stay unmatched.

    A small lookup is broadcast. Otherwise the join shuffles, and as unmatched rows would
    all meet under one NULL key, those are dealt out over keys that match nothing.
    """
    first = next(iter(keys))
    computed = {f"_m_{k}": value for k, value in keys.items()}
    computed[f"_m_{first}"] = F.when(wanted, keys[first])
    if small:
        side, match = F.broadcast(lookup), F.lit(True)
    else:
        computed["_ok"] = wanted & keys[first].isNotNull()
        dealt = F.concat(F.lit("~"), F.pmod(F.xxhash64("LOAN_ID"), F.lit(4096)).cast("string"))
        computed[f"_m_{first}"] = F.when(computed["_ok"], keys[first]).otherwise(dealt)
        side, match = lookup, F.col("_ok")
    for k in keys:
        match = match & (F.col(f"_m_{k}") == F.col(f"_l_{k}"))
    renamed = side.withColumnsRenamed({k: f"_l_{k}" for k in keys})
    joined = months.withColumns(computed).join(renamed, match, "left")
    return joined.drop(*computed, *[f"_l_{k}" for k in keys])


def with_market(
    months: DataFrame,
    rates: DataFrame | None,
    price_index: DataFrame | None,
    wanted: Column,
    broadcast_rows: int = BROADCAST_ROW_LIMIT,
) -> DataFrame:
    """Add the market series of each monthly row; rows that are not ``wanted`` get none."""
    out = months
    if rates is not None:
        table, size = unique_lookup(rates, ["period_mmyyyy"], "date" if "date" in rates.columns else None)
        lookup = table.select(
            F.col("period_mmyyyy").alias("period"),
            F.col("mortgage30us").alias("macro_mortgage30us"),
            F.col("unrate").alias("macro_unrate"),
            F.col("dgs10").alias("macro_dgs10"),
            (F.col("dgs10") - F.col("gs3m")).alias("macro_term_spread_10y3m"),
        )
        out = _attach(out, lookup, {"period": F.col("ACT_PERIOD")}, wanted, size <= broadcast_rows)
    if price_index is not None:
        table, size = unique_lookup(price_index, ["state", "quarter_key"])
        current = table.select(
            "state",
            F.col("quarter_key").alias("quarter"),
            F.col("hpi_index").alias("hpi_state_curr"),
            F.col("hpi_yoy").alias("hpi_state_growth_1y"),
        )
        original = table.select(
            "state", F.col("quarter_key").alias("quarter"), F.col("hpi_index").alias("hpi_state_orig")
        )
        for lookup, date in ((current, "ACT_PERIOD"), (original, "ORIG_DATE")):
            keys = {"state": F.col("STATE"), "quarter": quarter_key(F.col(date))}
            out = _attach(out, lookup, keys, wanted, size <= broadcast_rows)
    return out
