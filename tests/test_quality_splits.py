import pytest
from pyspark.sql import functions as F

from loanseason.config import EraBound, QualityContract, SplitBands
from loanseason.functions.dates import is_vintage, require_vintage
from loanseason.operators import profile, quality, splits

from .conftest import month

COLUMNS = ["CSCORE_B", "DTI", "OLTV", "ORIG_RATE", "ORIG_UPB", "rate_incentive", "macro_mortgage30us", "hpi_state_ratio_curr_to_orig"]


def features(spark, rows):
    full = [
        tuple({"vintage": "2018Q1", "LOAN_ID": str(i), "eligible": 1, "y_delinq_90p": 0, "y_prepay": 0,
               "CSCORE_B": 700.0, "DTI": 30.0, "OLTV": 80.0, "ORIG_RATE": 4.0, "ORIG_UPB": 1e5, "rate_incentive": 0.1,
               "macro_mortgage30us": 4.0, "hpi_state_ratio_curr_to_orig": 1.0, **r}.values())
        for i, r in enumerate(rows)
    ]
    schema = "vintage string, LOAN_ID string, eligible int, y_delinq_90p int, y_prepay int, " + ", ".join(f"{c} double" for c in COLUMNS)
    return spark.createDataFrame(full, schema)


def test_rules_fire_and_are_listed_in_order(spark):
    rows = [{"CSCORE_B": None, "OLTV": 300.0}] * 4 + [{"y_delinq_90p": 1}] * 6
    row = quality.quality_report(features(spark, rows)).first()
    assert row.violations == "null_cscore=0.400; oor_OLTV=0.4000; delinq_rate=0.6000 outside [0.001,0.08]"
    assert row.passed is False and row.null_cscore == 0.4


def test_declared_but_unenforced_rules_need_asking(spark):
    rows = [{"ORIG_UPB": 10.0, "y_delinq_90p": int(i == 0)} for i in range(20)]
    assert quality.quality_report(features(spark, rows)).first().passed
    strict = quality.quality_report(features(spark, rows), QualityContract(all_declared=True)).first()
    assert strict.violations == "oor_ORIG_UPB=1.0000"


def test_vintage_without_eligible_loans_has_no_rate_and_passes_the_era_rule(spark):
    row = quality.quality_report(features(spark, [{"eligible": 0}])).first()
    assert row.delinq_rate is None and row.passed and row.n_eligible == 0


def test_missing_price_index_disables_its_rule(spark):
    rows = [{"hpi_state_ratio_curr_to_orig": None, "y_delinq_90p": int(i == 0)} for i in range(20)]
    frame = features(spark, rows)
    assert not quality.quality_report(frame).first().passed
    assert quality.quality_report(frame, QualityContract(price_index_available=False)).first().passed


def test_years_without_an_era_are_unbounded(spark):
    frame = features(spark, [{"vintage": "1990Q1", "y_delinq_90p": 1}])
    assert quality.quality_report(frame).first().passed


def test_summary_and_gate(spark):
    contract = QualityContract(eras=(EraBound(2018, 2018, 0.5, 1.0),))
    report = quality.quality_report(features(spark, [{}, {"vintage": "2019Q1"}]), contract)
    row = quality.quality_summary(report).first()
    assert (row.vintages_checked, row.passed, row.failed, row.failed_vintages, row.exit_status) == (2, 1, 1, "2018Q1", 1)
    with pytest.raises(RuntimeError, match="2018Q1"):
        quality.quality_gate(report)
    quality.quality_gate(report.where("passed"))


def test_split_bands(spark):
    years = [1999, 2000, 2015, 2016, 2018, 2020, 2021]
    frame = spark.createDataFrame([(f"{y}Q1",) for y in years], "vintage string")
    got = [r.split for r in splits.with_split(frame).collect()]
    assert got == ["holdout", "train", "train", "val", "test", "stress", "holdout"]
    with pytest.raises(ValueError):
        SplitBands().bounds("holdout")


def test_training_frame_guards(spark):
    frame = features(spark, [{}])
    with pytest.raises(RuntimeError, match="no eligible loans"):
        splits.training_frame(frame, "val", "delinq", columns=["DTI"])
    assert splits.training_frame(frame, "test", "prepay", columns=["DTI"]).columns == ["vintage", "LOAN_ID", "DTI", "y_true"]


def test_class_weights_without_positives(spark):
    rows = {r.task: r for r in splits.class_weights(features(spark, [{}, {}]), "test").collect()}
    assert (rows["delinq"].tree_weight, rows["delinq"].network_weight) == (1.0, 2.0)


def test_vintage_names(spark):
    frame = spark.createDataFrame([("2018Q1",), ("2018Q5",), ("x2018Q1",), (None,)], "v string")
    assert [r[0] for r in frame.select(is_vintage(F.col("v"))).collect()] == [True, False, False, False]
    with pytest.raises(Exception, match="must look like 2018Q1"):
        frame.select(require_vintage(F.col("v"))).collect()


def test_month_runs_against_brute_force(spark, panel_rows):
    import random

    rng = random.Random(5)
    rows, expected = [], {}
    for loan in range(60):
        ages = sorted(rng.sample(range(0, 200), rng.randint(1, 60)))
        repeats = rng.randint(0, 3)
        gaps = [b - a for a, b in zip(ages, ages[1:]) if b - a > 1]
        expected[str(loan)] = (len(ages) + repeats, len(ages), ages[-1] - ages[0] + 1, len(gaps) + 1)
        rows += [month(a, loan=str(loan)) for a in ages + ages[:1] * repeats]
    got = profile.month_runs(panel_rows(rows), {"": F.lit(True)}).collect()
    assert {r.LOAN_ID: (r.rows, r.months, r.span, r.runs) for r in got} == expected


def test_sequence_counts_repeated_rows(panel_rows):
    rows = [month(a, loan="7") for a in (2, 0, 1, 1, 1, 1, 1)] + [month(0, loan=x) for x in ("8", "9", "6")]
    got = {r.LOAN_ID: r for r in profile.loan_sequence(panel_rows(rows)).collect()}
    assert set(got) == {"6", "7", "8"}
    assert got["7"].first == "012018,022018,022018,022018" and got["7"].last == "022018,022018,032018"
    assert got["7"]["count"] == 7
