import pytest
from pyspark.sql import functions as F

from loanseason.operators import loans
from loanseason.operators.panel import with_effective_age
from loanseason.schema import FEATURE_ROW_COLUMNS, WINDOW_FEATURES
from loanseason.testbed import tables

from .conftest import month, period

SF = "/root/testdata/sf0.001"


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_terminal_row_without_age_takes_it_from_the_dates(panel_rows):
    for age, window, label in ((12, 1, 0), (13, 0, 1), (24, 0, 1), (25, 0, 0)):
        rows = [{"ACT_PERIOD": period(age), "LOAN_AGE": None, "ZB_CODE": "01"}]
        row = one(loans.loan_features(panel_rows(rows)))
        assert (row.f12_n_obs, row.y_prepay, row.observed_through_age) == (window, label, age)
        assert (row.ever_terminal, row.first_terminal_age, row.eligible) == (1, age, 1)


def test_rows_before_origination_and_without_dates_are_dropped(panel_rows):
    rows = [month(-1), month(0), {"ACT_PERIOD": None, "LOAN_AGE": None}]
    assert one(loans.window_features(panel_rows(rows))).f12_n_obs == 1


def test_last_known_balance_skips_a_missing_one(panel_rows):
    rows = [month(10, CURRENT_UPB=90.0), month(11, CURRENT_UPB=80.0), month(12), month(13, CURRENT_UPB=1.0)]
    rows[0]["ORIG_UPB"] = 100.0
    row = one(loans.loan_features(panel_rows(rows)))
    assert row.f12_last_upb == 80.0
    assert row.f12_upb_paid_ratio == pytest.approx(0.2)
    assert row.f12_last_age_seen == 12


def test_snapshot_takes_the_earliest_known_value(panel_rows):
    rows = [
        month(0, SERVICER=None, DTI=None),
        month(1, SERVICER="A", DTI=None),
        month(2, SERVICER="B", DTI=31),
        month(3, SERVICER="A", DTI=40),
    ]
    row = one(loans.origination_snapshot(panel_rows(rows)))
    assert (row.SERVICER, row.DTI, row.SELLER) == ("A", 31, None)


def test_status_text_and_flags(panel_rows):
    rows = [
        month(1, DLQ_STATUS="XX", MOD_FLAG="Y"),
        month(2, DLQ_STATUS="03"),
        month(3, DLQ_STATUS=" 1 "),
        month(14, DLQ_STATUS="XX"),
        month(15, DLQ_STATUS="04"),
    ]
    row = one(loans.loan_features(panel_rows(rows)))
    assert (row.f12_dlq_max, row.f12_months_30p, row.f12_months_90p, row.f12_ever_60) == (3, 2, 1, 1)
    assert (row.f12_mod_flag, row.f12_forbearance, row.lw_forbearance, row.y_delinq_90p) == (1, 1, 1, 1)


def test_absent_windows(panel_rows):
    late = one(loans.loan_features(panel_rows([month(20)])))
    assert (late.f12_n_obs, late.f12_dlq_max, late.f12_last_upb, late.f12_last_age_seen) == (0, None, None, None)
    assert (late.lw_n_obs, late.eligible) == (1, 0)
    early = one(loans.loan_features(panel_rows([month(5)])))
    assert (early.lw_n_obs, early.y_delinq_90p, early.eligible) == (0, 0, 0)


def test_zero_balance_has_no_ratio(panel_rows):
    assert one(loans.loan_features(panel_rows([month(1, ORIG_UPB=0.0, CURRENT_UPB=5.0)]))).f12_upb_paid_ratio is None


def test_strict_eligibility_asks_for_survival_of_the_feature_window(panel_rows):
    rows = panel_rows([month(5, ZB_CODE="01")])
    assert one(loans.eligibility(rows)).eligible == 1
    assert one(loans.eligibility(rows, strict=True)).eligible == 0


def test_censoring(panel_rows):
    quiet = one(loans.labels(panel_rows([month(14)])))
    held = one(loans.labels(panel_rows([month(14, DLQ_STATUS="XX")])))
    assert (quiet.y_censored, held.y_censored) == (1, 0)


def test_default_codes(panel_rows):
    for code, default, prepay in (("02", 1, 0), ("03", 1, 0), ("09", 1, 0), ("15", 1, 0), ("16", 0, 0), ("01", 0, 1)):
        row = one(loans.labels(panel_rows([month(14, ZB_CODE=code)])))
        assert (row.y_default_zb, row.y_prepay) == (default, prepay)


def test_same_loan_id_in_two_vintages_stays_apart(panel_rows):
    rows = [month(1, vintage="2018Q1"), month(1, vintage="2018Q2")]
    assert loans.labels(panel_rows(rows)).count() == 2


def test_features_ignore_everything_after_the_window(spark):
    panel = tables.panel(spark, SF)
    later = F.col("LOAN_AGE") > 12
    changed = panel.withColumns(
        {
            "DLQ_STATUS": F.when(later, "09").otherwise(F.col("DLQ_STATUS")),
            "CURRENT_UPB": F.when(later, -1.0).otherwise(F.col("CURRENT_UPB")),
            "MOD_FLAG": F.when(later, "Y").otherwise(F.col("MOD_FLAG")),
        }
    )
    before, after = (loans.loan_features(p, columns=WINDOW_FEATURES) for p in (panel, changed))
    assert before.exceptAll(after).isEmpty() and after.exceptAll(before).isEmpty()


def test_result_does_not_depend_on_row_order_or_partitioning(spark):
    panel = tables.panel(spark, SF)
    shuffled = panel.repartition(7, F.rand(1)).sortWithinPartitions(F.rand(2))
    a, b = loans.loan_features(panel), loans.loan_features(shuffled)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert a.columns == FEATURE_ROW_COLUMNS


def test_single_pass_equals_the_join_of_separate_windows(spark):
    months = with_effective_age(tables.panel(spark, SF)).cache()
    key = ["vintage", "LOAN_ID"]
    feat = months.where("age <= 12").groupBy(*key).agg(
        F.count("*").alias("f12_n_obs"), F.max("dlq_num").alias("f12_dlq_max")
    )
    lab = months.where("age between 13 and 24").groupBy(*key).agg(
        F.count("*").alias("lw_n_obs"), F.max((F.col("dlq_num") >= 3).cast("int")).alias("y_delinq_90p")
    )
    horizon = months.groupBy(*key).agg(F.max("age").alias("observed_through_age"))
    joined = horizon.join(feat, key, "left").join(lab, key, "left").fillna(0, ["f12_n_obs", "lw_n_obs", "y_delinq_90p"])
    columns = ["vintage", "LOAN_ID", "observed_through_age", "f12_n_obs", "f12_dlq_max", "lw_n_obs", "y_delinq_90p"]
    single = loans.loan_features(tables.panel(spark, SF)).select(*columns)
    assert single.exceptAll(joined.select(*columns)).isEmpty()
    assert single.count() == joined.count() == 1500
