"""One query per operator over the derived loan tables."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable, Sequence

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import NetworkSettings, TreeSettings
from ..functions.dates import is_vintage, vintage_quarter, vintage_year
from ..operators import loan_counts, loans, market, models, prep, profile, quality, ranking, sampling, scoring, splits, tree_nodes
from ..operators.panel import core_columns, with_effective_age
from ..schema import (
    ALL_FEATURES,
    CATEGORICAL_FEATURES,
    CORE_COLUMNS,
    NUMERIC_FEATURES,
    TARGETS,
    panel_schema,
)
from ..session import materialise, scratch_path, stored
from ..sources import landing as landing_source
from ..sources import panel_text, parity, reports, store
from ..sources.catalog import catalog_counts
from . import tables

Query = Callable[[SparkSession, str], DataFrame]

# Fixed scorecards: a rare and a frequent target, each with a full card and one on credit score only.
CARDS = (
    scoring.Scorecard(
        "full",
        "delinq",
        -2.0,
        (
            scoring.Term("f12_dlq_max", 0.8),
            scoring.Term("f12_months_30p", 0.3),
            scoring.Term("CSCORE_B", -0.01, 650.0, 700.0),
        ),
        digits=4,
    ),
    scoring.Scorecard(
        "full",
        "prepay",
        -1.2,
        (
            scoring.Term("ORIG_RATE", 0.25, 5.0, 5.0),
            scoring.Term("OLTV", -0.01, 70.0, 70.0),
            scoring.Term("CSCORE_B", 0.002, 600.0, 600.0),
        ),
        digits=4,
    ),
    scoring.Scorecard("credit", "delinq", -3.0, (scoring.Term("CSCORE_B", -0.01, 650.0, 700.0),), digits=4),
    scoring.Scorecard("credit", "prepay", -1.5, (scoring.Term("CSCORE_B", 0.004, 600.0, 600.0),), digits=4),
)
FULL_CARDS = CARDS[:2]
SAMPLE_SIZE = 1000
# Far below the defaults, which take hours here; README has figures.
TREES = TreeSettings(depth=4, learning_rate=0.1, rounds=12, min_rows_per_leaf=20, patience=4, first_rounds=12)
NETWORK = NetworkSettings(hidden=(16, 8), epochs=8, patience=3)


def rates(spark: SparkSession, sf: str) -> DataFrame:
    return market.monthly_rates(tables.rate_series(spark, sf))


def price_index(spark: SparkSession, sf: str) -> DataFrame:
    return market.price_index_changes(tables.index_input(spark, sf))


def features(spark: SparkSession, sf: str, columns: Sequence[str] | None = None) -> DataFrame:
    return loans.loan_features(tables.panel(spark, sf), rates(spark, sf), price_index(spark, sf), columns=columns)


def plain_features(spark: SparkSession, sf: str) -> DataFrame:
    """Loan rows without market context, for consumers that read none of it."""
    return loans.loan_features(tables.panel(spark, sf))


def outcomes(spark: SparkSession, sf: str) -> DataFrame:
    return loans.outcomes(tables.panel(spark, sf))


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(
        *[
            F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _card_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Loan rows with just the columns that the scorecards read."""
    inputs = sorted({t.feature for c in CARDS for t in c.terms})
    return loans.loan_features(tables.panel(spark, sf), columns=[*inputs, *TARGETS.values(), "eligible"])


def scored(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.apply_scorecards(_card_rows(spark, sf), CARDS, tables.BANDS)


def raw_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Text files into the partitioned store, then totals of every core column from there."""
    text, root = scratch_path(spark, "text"), scratch_path(spark, "raw")
    panel_text.write_panel_text(tables.panel(spark, sf), text)
    store.write_raw(panel_text.read_panel_text(spark, text), root)
    rows = core_columns(store.read_raw(spark, root))
    kinds = {f.name: f.dataType for f in panel_schema().fields}
    known = [F.count(c).alias(f"known_{c}") for c in CORE_COLUMNS]
    sums = [F.round(F.sum(F.col(c).cast("double")), 2).alias(f"sum_{c}") for c in CORE_COLUMNS if not isinstance(kinds[c], T.StringType)]
    return rows.groupBy("vintage").agg(F.count("*").alias("rows"), *known, *sums)


def _landed(spark: SparkSession, sf: str) -> str:
    """The panel as text, with a line in the files of 1997Q1 that no reader takes."""
    text = scratch_path(spark, "text")
    panel_text.write_panel_text(tables.panel(spark, sf), text)
    broken = spark.createDataFrame([("|".join(["x"] * 110),)], "value string")
    broken.coalesce(1).write.mode("append").text(f"{text}/file=1997Q1.csv")
    return text


def ingest_convert(spark: SparkSession, sf: str) -> DataFrame:
    """Conversion of all files: what became of each vintage, and the rows and files' footers of the store."""
    text, root = _landed(spark, sf), scratch_path(spark, "raw")
    status = landing_source.convert(spark, text, root, only_years=range(1992, 1998))
    found = parity.stored_rows(spark, root).select("vintage", "stored_rows")
    return status.join(found, "vintage", "left")


def ingest_parity(spark: SparkSession, sf: str) -> DataFrame:
    """Text against store, where the store has lost every other loan of 1996Q3 and has no 1997Q1 at all."""
    text, root = _landed(spark, sf), scratch_path(spark, "raw")
    landing_source.convert(spark, text, root)
    hurt = store.read_raw(spark, root).where("vintage = '1996Q3' AND CAST(LOAN_ID AS BIGINT) % 2 = 0").drop("vintage")
    store.write_raw(stored(hurt, "hurt")[0], root, overwrite=True)
    rows = parity.ingest_parity(spark, text, root)
    return rows.select("vintage", "text_rows", "stored_rows", "difference", "verdict")


def bucketed_features(spark: SparkSession, sf: str) -> DataFrame:
    """The loan rows again, from a store in which all months of a loan share a bucket."""
    root, table = scratch_path(spark, "bucketed"), f"months_{uuid.uuid4().hex}"
    panel = tables.panel(spark, sf).withColumns(
        {"orig_year": vintage_year(F.col("vintage")), "orig_qtr": vintage_quarter(F.col("vintage"))}
    )
    store.write_bucketed(panel.drop("vintage"), root, table, int(spark.conf.get("spark.sql.shuffle.partitions")))
    months = store.open_bucketed(spark, root, table)
    return rounded(loans.loan_features(months, rates(spark, sf), price_index(spark, sf)))


def ingest_status(spark: SparkSession, sf: str) -> DataFrame:
    landed = tables.panel(spark, sf).groupBy("vintage").agg(F.count("*").alias("rows"))
    quarter = F.substring("vintage", 6, 1).cast("int")
    existing = tables.loan_months(spark, sf).select("vintage").distinct().where(quarter % 2 == 0)
    return landing_source.conversion_status(landed, existing, only_years=(1996, 1997, 1998))


def vintage_parse(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.panel(spark, sf)
    text = rows.select(F.explode(F.array("vintage", "ACT_PERIOD")).alias("text")).distinct()
    good = is_vintage(F.col("text"))
    return text.select(
        "text",
        good.alias("valid"),
        F.when(good, vintage_year(F.col("text"))).alias("year"),
        F.when(good, vintage_quarter(F.col("text"))).alias("quarter"),
    )


def effective_age(spark: SparkSession, sf: str) -> DataFrame:
    aged = with_effective_age(tables.panel(spark, sf))
    return aged.groupBy("age", "dlq_num").agg(
        F.count("*").alias("rows"), F.count_if(F.col("LOAN_AGE").isNull()).alias("age_recomputed")
    )


def eligibility(spark: SparkSession, sf: str) -> DataFrame:
    panel = tables.panel(spark, sf)
    strict = loans.eligibility(panel, strict=True).select("vintage", "LOAN_ID", F.col("eligible").alias("eligible_strict"))
    return loans.eligibility(panel).join(strict, ["vintage", "LOAN_ID"])


def split_load(spark: SparkSession, sf: str) -> DataFrame:
    frame = splits.training_frame(features(spark, sf), "val", "delinq", tables.BANDS)
    return rounded(frame)


def split_assign(spark: SparkSession, sf: str) -> DataFrame:
    named = splits.with_split(outcomes(spark, sf), tables.BANDS)
    return named.select("LOAN_ID", "vintage", "vintage_year", "vintage_quarter", "split")


def report(spark: SparkSession, sf: str, contract=tables.CONTRACT) -> DataFrame:
    limited = {limit.column for limit in (*contract.null_limits, *contract.range_limits)}
    return quality.quality_report(features(spark, sf, [*sorted(limited), *TARGETS.values(), "eligible"]), contract)


def _numeric_train(spark: SparkSession, sf: str) -> tuple[DataFrame, int]:
    rows = features(spark, sf, [*NUMERIC_FEATURES, "eligible"])
    train, seen = stored(splits.load_split(rows, "train", tables.BANDS, NUMERIC_FEATURES), "numeric-train")
    return train, seen["rows"]


def impute_medians(spark: SparkSession, sf: str) -> DataFrame:
    train, count = _numeric_train(spark, sf)
    fitted = [(c, middle, count - known) for c, (middle, known) in prep.counted_medians(train).items()]
    filled = spark.createDataFrame(fitted, "feature string, median double, filled long")
    return filled.select("feature", F.round("median", 6).alias("median"), "filled")


def onehot(spark: SparkSession, sf: str) -> DataFrame:
    coded = loans.loan_features(tables.panel(spark, sf), columns=[*CATEGORICAL_FEATURES, "eligible"])
    rows = splits.with_split(coded, tables.BANDS).where("eligible = 1")
    rows = materialise(rows.select("split", *CATEGORICAL_FEATURES))
    encoded = prep.indicators(prep.fit_levels(rows.where("split = 'train'")))
    sums = rows.groupBy("split").agg(F.count("*").alias("loans"), *[F.sum(v).alias(n) for n, v in encoded.items()])
    return sums.unpivot(["split", "loans"], list(encoded), "encoded", "ones")


def onehot_sparse(spark: SparkSession, sf: str) -> DataFrame:
    """The same counts from sparse vectors, whose levels are no columns."""
    coded = loans.loan_features(tables.panel(spark, sf), columns=[*CATEGORICAL_FEATURES, "eligible"])
    rows = splits.with_split(coded, tables.BANDS).where("eligible = 1")
    rows = materialise(rows.select("split", *CATEGORICAL_FEATURES))
    encoder = prep.SparseLevels.fit(rows.where("split = 'train'"))
    names = spark.createDataFrame(list(enumerate(encoder.names)), "place int, encoded string")
    places = F.from_json(F.to_json(F.struct("levels")), "levels struct<indices: array<int>>")["levels"]["indices"]
    ones = encoder.transform(rows).select("split", F.explode(places).alias("place")).groupBy("split", "place").agg(F.count("*").alias("ones"))
    every = rows.groupBy("split").agg(F.count("*").alias("loans")).select("split", "loans", F.explode(F.lit(list(range(len(encoder.names))))).alias("place"))
    return (
        every.join(names, "place")
        .join(ones, ["split", "place"], "left")
        .select("split", "loans", "encoded", F.coalesce("ones", F.lit(0)).alias("ones"))
    )


def loans_by_range(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct loans of ranges of vintages, counted exactly, and whether the merged sketches come close."""
    panel, root = tables.panel(spark, sf), scratch_path(spark, "sketches")
    loan_counts.refresh_sketches(panel.where("vintage < '1996Q1'"), root)
    loan_counts.refresh_sketches(panel, root)
    ranges = [*((f"{y}Q1", f"{y}Q4") for y in range(1992, 1999)), ("1992Q1", "1998Q4"), ("1993Q3", "1996Q2")]
    merged = loan_counts.loans_in_ranges(loan_counts.read_sketches(spark, root), ranges)
    named = F.array(*[F.struct(F.lit(a).alias("first"), F.lit(b).alias("last")) for a, b in ranges])
    exact = (
        panel.select("vintage", "LOAN_ID").distinct().select("vintage", "LOAN_ID", F.explode(named).alias("r"))
        .where("vintage BETWEEN r.first AND r.last").groupBy("r.first", "r.last").agg(F.count_distinct("LOAN_ID").alias("loans"))
    )
    near = F.abs(F.col("estimate") - F.col("loans")) <= loan_counts.STATED_ERROR * F.col("loans")
    return merged.join(exact, ["first", "last"]).select("first", "last", "rows", "loans", near.alias("sketch_is_near"))


def scaled_stats(spark: SparkSession, sf: str) -> DataFrame:
    train, _ = _numeric_train(spark, sf)
    filled = prep.impute(train, prep.medians(train))
    scales = prep.fit_scales(filled, {c: F.col(c).cast("double") for c in NUMERIC_FEATURES})
    rows = spark.createDataFrame([(c, *scale) for c, scale in scales.items()], "feature string, mean double, scale double")
    return rounded(rows, 4)


def stratified(spark: SparkSession, sf: str) -> DataFrame:
    val = splits.load_split(outcomes(spark, sf), "val", tables.BANDS)
    rows = val.select("LOAN_ID", F.col("y_delinq_90p").alias("y_true"))
    return sampling.stratified_sample(rows, SAMPLE_SIZE, order=sampling.id_hash(F.col("LOAN_ID")))


def groups(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.score_groups(scored(spark, sf))


def recalls(spark: SparkSession, sf: str) -> DataFrame:
    rows = materialise(scored(spark, sf))
    return ranking.recall_at_levels(rows, ranking.score_groups(rows))


def attribution_table(spark: SparkSession, sf: str) -> DataFrame:
    rows = splits.load_split(_card_rows(spark, sf), "val", tables.BANDS)
    return scoring.mean_attributions(materialise(rows), FULL_CARDS)


def _model_frame(spark: SparkSession, sf: str) -> DataFrame:
    wanted = [*ALL_FEATURES, *TARGETS.values(), "eligible"]
    return stored(models.model_frame(features(spark, sf, wanted), tables.BANDS), "model-frame")[0]


def _once(fit: Callable) -> Callable:
    """A fit is made once for a session and folder; several keys show results of it."""
    held: dict[tuple[str, str], object] = {}

    @functools.wraps(fit)
    def made(spark: SparkSession, sf: str):
        key = (spark.sparkContext.applicationId, sf)
        if key not in held:
            held[key] = fit(spark, sf)
        return held[key]

    return made


@_once
def _trees(spark: SparkSession, sf: str):
    """The model rows, the inputs and one tree model for each task."""
    frame = _model_frame(spark, sf)
    inputs = models.TreeInputs.fit(frame.where("split = 'train'"))
    return frame, inputs, {task: models.fit_trees(frame, inputs, task, TREES) for task in TARGETS}


@_once
def _network(spark: SparkSession, sf: str):
    frame = _model_frame(spark, sf)
    fitted = prep.Preprocessor.fit(frame.where("split = 'train'"))
    return frame, fitted, models.fit_network(frame, fitted, NETWORK)


def gbt_scores(spark: SparkSession, sf: str) -> DataFrame:
    frame, inputs, fits = _trees(spark, sf)
    parts = [models.score_with_trees(frame, inputs, fits[t], t) for t in TARGETS]
    return rounded(parts[0].unionByName(parts[1]))


def joint_scores(spark: SparkSession, sf: str) -> DataFrame:
    frame, fitted, fit = _network(spark, sf)
    return rounded(models.score_with_network(frame, fitted, fit.model))


def network_history(spark: SparkSession, sf: str) -> DataFrame:
    _, _, fit = _network(spark, sf)
    return rounded(fit.history.withColumn("best", F.col("epoch") == fit.best_epoch))


def importance(spark: SparkSession, sf: str) -> DataFrame:
    _, inputs, fits = _trees(spark, sf)
    parts = [models.tree_importance(fits[t], inputs).withColumn("task", F.lit(t)) for t in TARGETS]
    return rounded(parts[0].unionByName(parts[1]))


def training_curve(spark: SparkSession, sf: str) -> DataFrame:
    _, _, fits = _trees(spark, sf)
    parts = [fit.curve.withColumn("counts", F.col("round") <= fit.rounds) for fit in fits.values()]
    return rounded(parts[0].unionByName(parts[1]))


def model_reload(spark: SparkSession, sf: str) -> DataFrame:
    """Trees saved, loaded and applied again: loans per split, and how far any score is off."""
    frame, inputs, fits = _trees(spark, sf)
    parts = []
    for task, fit in fits.items():
        place, about = scratch_path(spark, "model"), scratch_path(spark, "inputs")
        fit.model.write().save(place)
        reports.write_state(spark, inputs.state() | {"rounds": fit.rounds}, about)
        state = reports.read_state(spark, about)
        again = models.TreeFit.of(GBTClassificationModel.load(place), tree_nodes.saved_nodes(spark, place), state["rounds"])
        first = models.score_with_trees(frame, inputs, fit, task)
        second = models.score_with_trees(frame, models.TreeInputs.from_state(state), again, task)
        keys = ["task", "split", "vintage", "LOAN_ID"]
        both = first.join(second.select(*keys, F.col("y_score").alias("again")), keys)
        parts.append(both.groupBy("task", "split").agg(F.count("*").alias("loans"), F.max(F.abs(F.col("y_score") - F.col("again"))).alias("off_by")))
    return rounded(parts[0].unionByName(parts[1]))


def tree_attributions(spark: SparkSession, sf: str) -> DataFrame:
    frame, inputs, fits = _trees(spark, sf)
    parts = [models.tree_attributions(fits[t], inputs, frame, t, "val") for t in TARGETS]
    return rounded(models.mean_effects(parts[0].unionByName(parts[1])))


def _panel(step: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: step(tables.panel(spark, sf))


def _loans(step: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: step(outcomes(spark, sf))


def _groups(step: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: step(groups(spark, sf))


QUERIES: dict[str, Query] = {
    "raw_scan": raw_scan,
    "ingest_status": ingest_status,
    "ingest_convert": ingest_convert,
    "ingest_parity": ingest_parity,
    "vintage_parse": vintage_parse,
    "effective_age": effective_age,
    "panel_profile": _panel(profile.panel_profile),
    "panel_gaps": _panel(profile.panel_gaps),
    "histogram": _panel(lambda p: profile.histogram(p, {"CSCORE_B": 20, "OLTV": 10})),
    "status_freq": _panel(lambda p: profile.frequency(p, "DLQ_STATUS", 10)),
    "exit_freq": _panel(lambda p: profile.frequency(p, "ZB_CODE")),
    "lifetime_outcome": _panel(profile.lifetime_outcome),
    "loan_sequence": _panel(profile.loan_sequence),
    "rowcount_parity": lambda s, d: profile.rowcount_parity(tables.panel(s, d), tables.loan_months(s, d)),
    "orig_snapshot": _panel(loans.origination_snapshot),
    "window_features": _panel(lambda p: rounded(loans.window_features(p))),
    "labels": _panel(loans.labels),
    "eligibility": eligibility,
    "loan_features": lambda s, d: rounded(features(s, d)),
    "loan_features_bucketed": bucketed_features,
    "features_no_macro": lambda s, d: rounded(plain_features(s, d)),
    "macro_monthly": lambda s, d: rounded(rates(s, d)),
    "hpi_yoy": lambda s, d: rounded(price_index(s, d)),
    "hpi_yoy_calendar": lambda s, d: rounded(market.price_index_changes(tables.index_input(s, d), calendar=True)),
    "macro_features": lambda s, d: rounded(
        loans.market_features(tables.panel(s, d), rates(s, d), price_index(s, d))
    ),
    "build_summary": _loans(splits.build_summary),
    "split_assign": split_assign,
    "split_load": split_load,
    "split_summary": _loans(lambda f: splits.split_summary(f, tables.BANDS)),
    "prevalence_by_vintage": _loans(splits.prevalence_by_vintage),
    "catalog_counts": lambda s, d: catalog_counts(tables.panel(s, d), outcomes(s, d), tables.BANDS),
    "dq_report": report,
    "dq_report_all_rules": lambda s, d: report(s, d, tables.CONTRACT_ALL),
    "dq_summary": lambda s, d: quality.quality_summary(report(s, d)),
    "coverage": lambda s, d: quality.coverage(report(s, d)),
    "drift": lambda s, d: quality.drift(report(s, d)),
    "class_weights": _loans(lambda f: splits.class_weights(f, "train", tables.BANDS)),
    "impute_medians": impute_medians,
    "onehot": onehot,
    "onehot_sparse": onehot_sparse,
    "loans_by_range": loans_by_range,
    "scaled_stats": scaled_stats,
    "stratified_sample": stratified,
    "scorecard": scored,
    "average_precision": _groups(ranking.average_precision),
    "roc_auc": _groups(ranking.roc_auc),
    "pr_curve": _groups(lambda g: rounded(ranking.precision_recall_points(g))),
    "roc_curve": _groups(lambda g: rounded(ranking.roc_points(g))),
    "recall_at_k": recalls,
    "calibration": lambda s, d: ranking.calibration(scored(s, d)),
    "score_metrics": lambda s, d: ranking.metric_table(materialise(scored(s, d))),
    "joint_ap": _groups(lambda g: rounded(ranking.joint_average_precision(g))),
    "model_compare": lambda s, d: ranking.compare_models(
        ranking.metric_table(materialise(scored(s, d))), "full", "credit"
    ),
    "lift_funnel": lambda s, d: ranking.lift_and_funnel(recalls(s, d)),
    "outreach_list": lambda s, d: ranking.outreach_list(materialise(scored(s, d)), 0.05),
    "attribution_top": attribution_table,
    "attribution_compare": lambda s, d: scoring.compare_attributions(materialise(attribution_table(s, d))),
    "gbt_scores": gbt_scores,
    "model_reload": model_reload,
    "joint_scores": joint_scores,
    "network_history": network_history,
    "importance": importance,
    "training_curve": training_curve,
    "attribution_trees": tree_attributions,
}
