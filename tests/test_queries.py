"""Registered queries against their SQL, and known totals at a larger scale."""

import pytest

import __spark_entry__ as contract
from loanseason.testbed import queries, tables

from .oracle_check import compare, duck

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
# Covered at a larger scale by tests.oracle_check; here one key of each group keeps the run short.
CHECKED = [
    "raw_scan", "ingest_status", "effective_age", "panel_profile", "panel_gaps", "loan_sequence", "orig_snapshot",
    "loan_features", "macro_monthly", "hpi_yoy", "split_assign", "dq_report", "dq_report_all_rules", "dq_summary",
    "impute_medians", "onehot", "stratified_sample", "score_metrics", "calibration", "pr_curve", "outreach_list",
    "attribution_compare",
]


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("key", CHECKED)
def test_query_equals_sql(spark, con, key):
    assert compare(spark, con, key, contract.queries()[key], contract.oracle_sql()[key], SMALL).startswith("ok")


def test_registry_is_consistent():
    only_rows = set(contract.queries()) - set(contract.oracle_sql())
    fits = {"gbt_scores", "joint_scores", "network_history", "importance", "training_curve", "attribution_trees"}
    assert all(k.startswith("op") or k == "pipeline" or k in fits for k in only_rows)
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 27


def test_known_totals(spark):
    panel = tables.panel(spark, MIDDLE)
    row = panel.selectExpr(
        "count(*) n", "count_if(LOAN_AGE = -1) early", "count_if(DLQ_STATUS = 'XX') held",
        "count_if(CURRENT_UPB is null) blank", "count(ZB_CODE) ended", "count(distinct vintage) vintages",
        "count(distinct LOAN_ID, ACT_PERIOD) keys",
    ).first()
    assert tuple(row) == (337_500, 15_000, 1_709, 6_600, 11_000, 27, 337_500)
    out = queries.features(spark, MIDDLE).selectExpr(
        "count(*)", "sum(eligible)", "count_if(eligible = 1 and observed_through_age <= 12)",
        "count_if(rate_incentive is null)", "count_if(est_current_ltv_from_oltv is null)",
        "count_if(hpi_state_growth_1y is null)",
    ).first()
    assert tuple(out) == (15_000, 14_500, 3_500, 257, 300, 141)


def test_labels_by_year(spark):
    got = (
        queries.outcomes(spark, MIDDLE)
        .groupBy("vintage").agg({"y_delinq_90p": "sum", "y_prepay": "sum", "y_default_zb": "sum"})
        .selectExpr("substr(vintage, 1, 4) y", "`sum(y_delinq_90p)` d", "`sum(y_prepay)` p", "`sum(y_default_zb)` z")
        .groupBy("y").sum("d", "p", "z").orderBy("y").collect()
    )
    assert [r[1] for r in got] == [70, 69, 68, 64, 65, 56, 35]
    assert [r[2] for r in got] == [440, 427, 481, 404, 492, 490, 266]
    assert [r[3] for r in got] == [244, 215, 203, 216, 242, 244, 136]
