"""Exact ranking metrics over scored rows, without a global sort in one task.

Scored rows carry ``model, task, split, LOAN_ID, y_true, y_score``. Metrics that depend
on the order of scores only need, per distinct score, how many rows and positives it
has; those score groups are formed with a pre-aggregating shuffle, however many rows
share one score. Cumulative counts over them are built per range of scores: ranges are
equal in size, and each adds the totals of the ranges before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import CALIBRATION_BINS, RECALL_LEVELS
from ..session import materialise

SCORE_KEYS = ("model", "task", "split")


def running_totals(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], sums: Sequence[str], parts: int | None = None
) -> DataFrame:
    """Add ``cum_x`` and ``total_x`` for every ``x`` in ``sums``, within ``keys`` along ``order``.

    The rows are cut into ranges of the full order, so a key that holds most rows is
    spread over many ranges. The range of each row is fixed by a checkpoint before it is
    used. A range spans few keys and keys follow one another, so the table of range
    totals has at most one row per range plus one per key and may be broadcast.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *[F.col(k) for k in keys], *order)
    fixed = materialise(ranged.withColumn("_range", F.spark_partition_id()))

    by_range = fixed.groupBy(*keys, "_range").agg(*[F.sum(s).alias(s) for s in sums])
    along = W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*keys)
    offsets = by_range.select(
        *keys,
        "_range",
        *[F.coalesce(F.sum(s).over(along), F.lit(0)).alias(f"_before_{s}") for s in sums],
        *[F.sum(s).over(whole).alias(f"total_{s}") for s in sums],
    )
    within = W.partitionBy("_range", *keys).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        fixed.join(F.broadcast(offsets), [*keys, "_range"])
        .withColumns({f"cum_{s}": F.sum(s).over(within) + F.col(f"_before_{s}") for s in sums})
        .drop("_range", *[f"_before_{s}" for s in sums])
    )


def score_groups(scored: DataFrame, keys: Sequence[str] = SCORE_KEYS, parts: int | None = None) -> DataFrame:
    """Per distinct score: ``n``, ``pos`` and both counts cumulated from the highest score down."""
    groups = scored.groupBy(*keys, "y_score").agg(F.count("*").alias("n"), F.sum("y_true").cast("long").alias("pos"))
    return running_totals(groups, keys, [F.desc("y_score")], ["n", "pos"], parts)


def _average_precision() -> Column:
    gain = F.col("pos") * (F.col("cum_pos") / F.col("cum_n"))
    return F.when(F.max("total_pos") > 0, F.sum(gain) / F.max("total_pos")).otherwise(0.0)


def _roc_auc() -> Column:
    below = (F.col("n") - F.col("pos")) * (F.col("cum_pos") - F.col("pos") / 2)
    positives, negatives = F.max("total_pos"), F.max(F.col("total_n") - F.col("total_pos"))
    return F.when(
        (positives > 0) & (negatives > 0), F.sum(below) / (positives.cast("double") * negatives)
    )


def _brier() -> Column:
    score, pos = F.col("y_score"), F.col("pos")
    squared = pos * (1 - score) * (1 - score) + (F.col("n") - pos) * score * score
    return F.sum(squared) / F.max("total_n")


def average_precision(groups: DataFrame, keys: Sequence[str] = SCORE_KEYS) -> DataFrame:
    """Precision at every distinct score, weighted by the recall it adds."""
    return groups.groupBy(*keys).agg(F.round(_average_precision(), 6).alias("average_precision"))


def roc_auc(groups: DataFrame, keys: Sequence[str] = SCORE_KEYS) -> DataFrame:
    """Chance that a positive outranks a negative, ties counting half; NULL with one class only."""
    return groups.groupBy(*keys).agg(F.round(_roc_auc(), 6).alias("roc_auc"))


def precision_recall_points(groups: DataFrame, keys: Sequence[str] = SCORE_KEYS) -> DataFrame:
    """One point per distinct score, the end point (precision 1, recall 0), and the random baseline."""
    prevalence = F.col("total_pos") / F.col("total_n")
    recall = F.when(F.col("total_pos") > 0, F.col("cum_pos") / F.col("total_pos")).otherwise(1.0)
    points = groups.select(
        *keys,
        F.col("y_score").alias("threshold"),
        (F.col("cum_pos") / F.col("cum_n")).alias("precision"),
        recall.alias("recall"),
        prevalence.alias("random_precision"),
    )
    end = groups.groupBy(*keys).agg(F.max(prevalence).alias("random_precision")).select(
        *keys,
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
        "random_precision",
    )
    return points.unionByName(end)


def roc_points(groups: DataFrame, keys: Sequence[str] = SCORE_KEYS) -> DataFrame:
    """One point per distinct score and the origin."""
    negatives = F.col("total_n") - F.col("total_pos")
    points = groups.select(
        *keys,
        F.col("y_score").alias("threshold"),
        F.when(negatives > 0, (F.col("cum_n") - F.col("cum_pos")) / negatives).alias("fpr"),
        F.when(F.col("total_pos") > 0, F.col("cum_pos") / F.col("total_pos")).alias("tpr"),
    )
    origin = groups.select(*keys).distinct().select(
        *keys, F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(origin)


def _levels(groups: DataFrame, ks: Sequence[float], keys: Sequence[str]) -> DataFrame:
    """Per key and level: the score group in which the contact budget runs out.

    ``budget`` rows may be contacted; ``need`` of them come from the cut-off group,
    which follows ``before`` positives of higher score.
    """
    at = groups.withColumn("k", F.explode(F.array(*[F.lit(float(k)) for k in ks])))
    budget = F.greatest(F.ceil(F.col("k") * F.col("total_n")), F.lit(1))
    earlier = F.col("cum_n") - F.col("n")
    return (
        at.withColumn("budget", budget)
        .where((F.col("cum_n") >= F.col("budget")) & (earlier < F.col("budget")))
        .select(
            *keys,
            "k",
            F.col("total_n").alias("n"),
            F.col("total_pos").alias("positives"),
            "budget",
            "y_score",
            (F.col("budget") - earlier).alias("need"),
            (F.col("cum_pos") - F.col("pos")).alias("before"),
        )
    )


def recall_at_levels(
    scored: DataFrame,
    groups: DataFrame,
    ks: Sequence[float] = RECALL_LEVELS,
    keys: Sequence[str] = SCORE_KEYS,
    parts: int | None = None,
) -> DataFrame:
    """Share of positives among the best ``ceil(k * n)`` rows, score ties in id order.

    Only rows whose score equals a cut-off need that id order, and that group may be
    large; their positions come from :func:`running_totals` as well. There is one
    cut-off per key and level, so the cut-offs may be broadcast.
    """
    cuts = materialise(_levels(groups, ks, keys))
    tied = scored.join(F.broadcast(cuts.select(*keys, "y_score").distinct()), [*keys, "y_score"], "left_semi")
    by_id = [c for c in ("LOAN_ID", "vintage") if c in scored.columns]
    placed = running_totals(
        tied.select(*keys, "y_score", *by_id, F.lit(1).alias("n"), F.col("y_true").alias("pos")),
        [*keys, "y_score"],
        [F.asc(c) for c in by_id],
        ["n", "pos"],
        parts,
    )
    from_ties = (
        placed.select(*keys, "y_score", F.col("cum_n").alias("place"), F.col("pos").alias("hit"))
        .join(F.broadcast(cuts), [*keys, "y_score"])
        .groupBy(*keys, "k", "n", "positives", "budget", "before")
        .agg(F.sum(F.when(F.col("place") <= F.col("need"), F.col("hit")).otherwise(0)).alias("from_ties"))
    )
    captured = F.col("before") + F.col("from_ties")
    return from_ties.select(
        *keys,
        "k",
        "n",
        "positives",
        F.col("budget").alias("contacted"),
        captured.alias("captured"),
        F.round(captured / F.greatest("positives", F.lit(1)), 6).alias("recall"),
    )


def lift_and_funnel(recalls: DataFrame, keys: Sequence[str] = SCORE_KEYS) -> DataFrame:
    """Contacted and captured loans per level, and the gain over contacting at random."""
    return recalls.select(
        *keys,
        "k",
        "n",
        "positives",
        "contacted",
        "captured",
        "recall",
        F.round(F.col("captured") / F.greatest("positives", F.lit(1)) / F.col("k"), 4).alias("lift"),
    )


def metric_table(
    scored: DataFrame,
    ks: Sequence[float] = RECALL_LEVELS,
    keys: Sequence[str] = SCORE_KEYS,
    parts: int | None = None,
) -> DataFrame:
    """Size, prevalence, AP, AUC, Brier score and recall per level for each key."""
    groups = score_groups(scored, keys, parts)
    base = groups.groupBy(*keys).agg(
        F.max("total_n").alias("n"),
        F.round(F.max(F.col("total_pos") / F.col("total_n")), 4).alias("prevalence"),
        F.round(_average_precision(), 4).alias("pr_auc"),
        F.round(_roc_auc(), 4).alias("roc_auc"),
        F.round(_brier(), 4).alias("brier"),
    )
    recalls = recall_at_levels(scored, groups, ks, keys, parts)
    names = {float(k): f"{int(k * 100)}pct" for k in ks}
    share = F.col("captured") / F.greatest("positives", F.lit(1))
    wide = recalls.groupBy(*keys).agg(
        *[F.round(F.max(F.when(F.col("k") == k, share)), 4).alias(f"recall_at_{n}") for k, n in names.items()]
    )
    random = [F.lit(k).alias(f"random_recall_at_{n}") for k, n in names.items()]
    return base.join(F.broadcast(wide), list(keys)).select("*", *random)


def joint_average_precision(groups: DataFrame, keys: Sequence[str] = ("model", "split")) -> DataFrame:
    """Mean over the tasks of their average precision: the score for choosing among models."""
    per_task = groups.groupBy(*keys, "task").agg(_average_precision().alias("ap"))
    return per_task.groupBy(*keys).agg(F.avg("ap").alias("joint_ap"))


def compare_models(table: DataFrame, left: str, right: str) -> DataFrame:
    """Metrics of two models side by side per task and split, with right minus left.

    What only one of them was measured on stays, with NULL on the other side.
    """
    metrics = ["pr_auc", "roc_auc", "brier", *[c for c in table.columns if c.startswith("recall_at_")]]

    def side(model: str, suffix: str) -> DataFrame:
        rows = table.where(F.col("model") == model)
        return rows.select("task", "split", *[F.col(m).alias(f"{m}_{suffix}") for m in metrics])

    both = side(left, "a").join(side(right, "b"), ["task", "split"], "full")
    return both.withColumns({f"{m}_delta": F.round(F.col(f"{m}_b") - F.col(f"{m}_a"), 4) for m in metrics})


def calibration(scored: DataFrame, bins: int = CALIBRATION_BINS, keys: Sequence[str] = SCORE_KEYS) -> DataFrame:
    """Mean score against observed rate per equal-width bin; empty bins are left out.

    A score belongs to the bin of the last edge it reaches, with edges as multiples of the
    binary step width, and a score of one belongs to the last bin. Means are taken over
    decimals, so that they do not depend on the order in which rows are added up.
    """
    edges = [i * (1.0 / bins) for i in range(bins)] + [1.0]
    reached = [F.when(F.col("y_score") >= e, 1).otherwise(0) for e in edges[1:-1]]
    place = sum(reached, F.lit(0))
    low = F.element_at(F.array(*[F.lit(round(e, 2)) for e in edges]), F.col("bin") + 1)
    high = F.element_at(F.array(*[F.lit(round(e, 2)) for e in edges]), F.col("bin") + 2)
    return (
        scored.withColumn("bin", place)
        .groupBy(*keys, "bin")
        .agg(
            F.count("*").alias("n"),
            F.round(F.avg(F.col("y_score").cast("decimal(20,10)")), 4).cast("double").alias("mean_pred"),
            F.round(F.avg(F.col("y_true").cast("decimal(20,10)")), 4).cast("double").alias("mean_actual"),
        )
        .select(*keys, low.alias("bin_lo"), high.alias("bin_hi"), "n", "mean_pred", "mean_actual")
    )


def outreach_list(
    scored: DataFrame, k: float = 0.05, keys: Sequence[str] = SCORE_KEYS, parts: int | None = None
) -> DataFrame:
    """The best ``ceil(k * n)`` loans of each key with their rank, ties in order of id and vintage."""
    cuts = _levels(score_groups(scored, keys, parts), [k], keys).select(
        *keys, F.col("y_score").alias("cut"), "budget"
    )
    near = (
        scored.join(F.broadcast(cuts), list(keys))
        .where(F.col("y_score") >= F.col("cut"))
        .select(*keys, "LOAN_ID", "vintage", "y_true", "y_score", "budget", F.lit(1).alias("one"))
    )
    ranked = running_totals(near, keys, [F.desc("y_score"), F.asc("LOAN_ID"), F.asc("vintage")], ["one"], parts)
    return ranked.where(F.col("cum_one") <= F.col("budget")).select(
        *keys, F.col("cum_one").cast("long").alias("rank"), "LOAN_ID", "vintage", "y_score", "y_true"
    )
