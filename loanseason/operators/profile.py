"""Profile and validation of the monthly panel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.dates import month_index, month_text
from ..functions.nulls import ratio

# Months kept in one number when presence is stored as bits.
_WORD = 60


def panel_profile(panel: DataFrame) -> DataFrame:
    """Rows, loans, period range, balance summary and age agreement per vintage."""
    month = month_index(F.col("ACT_PERIOD"))
    recomputed = month - month_index(F.col("ORIG_DATE"))
    per_vintage = panel.groupBy("vintage").agg(
        F.count("*").alias("rows"),
        F.count_distinct("LOAN_ID").alias("loans"),
        F.min(month).alias("_first"),
        F.max(month).alias("_last"),
        F.min("ORIG_UPB").alias("upb_min"),
        F.round(F.avg("ORIG_UPB"), 4).alias("upb_mean"),
        F.max("ORIG_UPB").alias("upb_max"),
        F.round(F.stddev_samp("ORIG_UPB"), 4).alias("upb_std"),
        F.count_if(F.col("LOAN_AGE") != recomputed).alias("age_disagreements"),
    )
    return per_vintage.select(
        "vintage",
        "rows",
        "loans",
        F.round(ratio(F.col("rows"), F.col("loans")), 6).alias("rows_per_loan"),
        month_text(F.col("_first")).alias("first_period"),
        month_text(F.col("_last")).alias("last_period"),
        "upb_min",
        "upb_mean",
        "upb_max",
        "upb_std",
        "age_disagreements",
    )


def month_runs(rows: DataFrame, subsets: dict[str, Column]) -> DataFrame:
    """Per loan and subset of its rows: rows, distinct months, months spanned, runs of adjacent months.

    The months of a loan are kept as bits of a few integers, so rows combine before the
    shuffle and a loan with any number of repeated rows still costs a few numbers. A run
    starts at a set bit whose lower neighbour is unset. All subsets share one pass.
    """
    month = month_index(F.col("ACT_PERIOD")).cast("long")
    word, bit = F.floor(month / _WORD), F.pmod(month, F.lit(_WORD)).cast("int")
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    before = W.partitionBy("vintage", "LOAN_ID").orderBy("word")
    adjacent = F.lag("word").over(before) == F.col("word") - 1

    packed, starts, merged = [], {}, []
    for name, inside in subsets.items():
        packed += [
            F.coalesce(F.bit_or(F.when(inside, mask)), F.lit(0)).alias(f"bits{name}"),
            F.count_if(inside).alias(f"rows{name}"),
            F.min(F.when(inside, month)).alias(f"from{name}"),
            F.max(F.when(inside, month)).alias(f"to{name}"),
        ]
        bits = F.col(f"bits{name}")
        carry = F.when(adjacent, F.shiftrightunsigned(F.lag(bits).over(before), _WORD - 1)).otherwise(0)
        shifted = F.shiftleft(bits, 1).bitwiseOR(F.coalesce(carry, F.lit(0)))
        starts[f"starts{name}"] = F.bit_count(bits.bitwiseAND(F.bitwise_not(shifted)))
        merged += [
            F.sum(f"rows{name}").alias(f"rows{name}"),
            F.sum(F.bit_count(bits)).alias(f"months{name}"),
            (F.max(f"to{name}") - F.min(f"from{name}") + 1).alias(f"span{name}"),
            F.sum(f"starts{name}").alias(f"runs{name}"),
        ]
    words = rows.groupBy("vintage", "LOAN_ID", word.alias("word")).agg(*packed)
    return words.withColumns(starts).groupBy("vintage", "LOAN_ID").agg(*merged)


def panel_gaps(panel: DataFrame) -> DataFrame:
    """Contiguity of the monthly rows per vintage, and of the months with a balance."""
    subsets = {"": F.lit(True), "_reported": F.col("CURRENT_UPB").isNotNull()}
    out = []
    for s in subsets:
        present, runs = F.col(f"rows{s}") > 0, F.col(f"runs{s}")
        out += [
            F.count_if(present).alias(f"loans{s}"),
            F.count_if(runs > 1).alias(f"loans_with_gaps{s}"),
            F.sum(F.when(present, runs - 1).otherwise(0)).alias(f"gaps{s}"),
            F.sum(F.coalesce(F.col(f"span{s}") - F.col(f"months{s}"), F.lit(0))).alias(f"missing_months{s}"),
            F.sum(F.col(f"rows{s}") - F.col(f"months{s}")).alias(f"repeated_rows{s}"),
        ]
    return month_runs(panel, subsets).groupBy("vintage").agg(*out)


def histogram(panel: DataFrame, widths: dict[str, int]) -> DataFrame:
    """Counts per bucket of equal width for several columns in one pass; absent values are left out."""
    cells = [
        F.when(
            F.col(c).isNotNull(),
            F.struct(F.lit(c).alias("column"), (F.floor(F.col(c) / w) * w).cast("int").alias("bucket")),
        )
        for c, w in widths.items()
    ]
    return (
        panel.select(F.explode(F.array_compact(F.array(*cells))).alias("cell"))
        .groupBy("cell.column", "cell.bucket")
        .agg(F.count("*").alias("n"))
    )


def frequency(panel: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Values by how often they occur, ties in value order; NULL counts as a value."""
    counts = (
        panel.groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), F.asc_nulls_last("value"))
    )
    return counts.limit(top) if top else counts


def lifetime_outcome(panel: DataFrame) -> DataFrame:
    """Largest exit code of each loan, by how often it occurs.

    Loans are first reduced to their distinct codes with a hashed grouping; the
    maximum of a text needs sorted input and so only sees what remains.
    """
    codes = panel.groupBy("vintage", "LOAN_ID", "ZB_CODE").agg(F.count("*").alias("rows"))
    per_loan = codes.groupBy("vintage", "LOAN_ID").agg(F.max("ZB_CODE").alias("outcome"))
    return per_loan.groupBy("outcome").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc_nulls_last("outcome"))


def loan_sequence(panel: DataFrame, loans: int = 3, head: int = 4, tail: int = 3) -> DataFrame:
    """First and last periods, in time order, of the loans with the smallest ids.

    Repeated rows of one month are counted before the months of a loan are gathered,
    so a gathered list is as long as the life of a loan, however many rows it has.
    """
    chosen = panel.groupBy("LOAN_ID").agg(F.count("*").alias("count")).orderBy("LOAN_ID").limit(loans)
    months = (
        panel.join(F.broadcast(chosen.select("LOAN_ID")), "LOAN_ID", "left_semi")
        .groupBy("LOAN_ID", "ACT_PERIOD")
        .agg(F.count("*").alias("times"))
    )
    entry = F.struct(month_index(F.col("ACT_PERIOD")).alias("idx"), F.col("ACT_PERIOD").alias("period"), F.col("times"))
    ordered = F.array_sort(F.collect_list(entry))

    def ends(entries: Column, size: int) -> Column:
        repeated = F.transform(
            entries, lambda e: F.array_repeat(e["period"], F.least(e["times"], F.lit(size)).cast("int"))
        )
        return F.flatten(repeated)

    listed = months.groupBy("LOAN_ID").agg(F.sum("times").alias("count"), ordered.alias("entries"))
    first = F.slice(ends(F.slice("entries", 1, head), head), 1, head)
    last_entries = F.slice(F.reverse("entries"), 1, tail)
    last = F.reverse(F.slice(ends(last_entries, tail), 1, tail))
    return listed.select(
        "LOAN_ID", F.array_join(first, ",").alias("first"), F.array_join(last, ",").alias("last"), "count"
    )


def rowcount_parity(panel: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows per vintage against the expected ``months`` of each loan."""
    found = panel.groupBy("vintage").agg(F.count("*").alias("rows"))
    wanted = expected.groupBy("vintage").agg(F.sum("months").alias("expected_rows"))
    both = found.join(wanted, "vintage", "full")
    return both.select(
        "vintage",
        F.coalesce("rows", F.lit(0)).alias("rows"),
        F.coalesce("expected_rows", F.lit(0)).alias("expected_rows"),
        F.coalesce(F.col("rows") == F.col("expected_rows"), F.lit(False)).alias("matches"),
    )
