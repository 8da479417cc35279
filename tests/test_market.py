import datetime as dt

import pytest
from pyspark.sql import functions as F

from loanseason.operators import loans, market
from loanseason.operators.panel import with_effective_age
from loanseason.testbed import queries, tables

from .conftest import month, period

SF = "/root/testdata/sf0.001"


def series(spark, rows):
    data = [(s, dt.date.fromisoformat(d), v) for s, d, v in rows]
    return spark.createDataFrame(data, "series string, date date, value double")


def test_fill_runs_along_the_dates_of_all_series(spark):
    rows = [
        ("mortgage30us", "2018-01-05", 4.0),
        ("dgs10", "2018-02-10", 2.5),
        ("unrate", "2018-01-01", 5.0),
        ("gs3m", "2018-02-01", None),
    ]
    got = {r.period_mmyyyy: r for r in market.monthly_rates(series(spark, rows)).collect()}
    assert got["022018"].mortgage30us == 4.0 and got["022018"].unrate is None
    assert got["022018"].date == dt.date(2018, 2, 10)
    assert got["012018"].dgs10 is None and got["022018"].gs3m is None


def test_change_is_row_based_unless_asked_for_the_calendar(spark):
    quarters = [(2000, 1), (2000, 2), (2000, 3), (2000, 4), (2001, 2), (2001, 3)]
    data = [(" ak ", y, f"Q{q}", float(100 + i)) for i, (y, q) in enumerate(quarters)]
    index = spark.createDataFrame(data, "state string, year int, qtr string, hpi_index double")
    by_row = {r.quarter_key: r.hpi_yoy for r in market.price_index_changes(index).collect()}
    by_date = {r.quarter_key: r.hpi_yoy for r in market.price_index_changes(index, calendar=True).collect()}
    assert by_row[20012] == pytest.approx(104 / 100 - 1)
    assert by_date[20012] == pytest.approx(104 / 101 - 1)
    assert by_row[20004] is None and by_date[20001] is None
    assert market.price_index_changes(index).first().state == "AK"


def test_unknown_keys_give_nulls(spark, panel_rows):
    rates = spark.createDataFrame([(period(3), 3.0, 5.0, 2.0, 1.0)], "period_mmyyyy string, mortgage30us double, unrate double, dgs10 double, gs3m double")
    index = spark.createDataFrame([("AK", 20181, 100.0, 0.1), ("AK", 20182, 110.0, 0.2)], "state string, quarter_key int, hpi_index double, hpi_yoy double")
    rows = [month(a, STATE="AK", ORIG_RATE=4.5, OLTV=80) for a in (0, 3, 5)] + [month(1, loan="2", STATE="ZZ", ORIG_RATE=4.0)]
    got = {r.LOAN_ID: r for r in loans.loan_features(panel_rows(rows), rates, index).collect()}
    assert got["1"].macro_mortgage30us == 3.0 and got["1"].rate_incentive == 1.5
    assert got["1"].macro_term_spread_10y3m == 1.0
    assert (got["1"].hpi_state_curr, got["1"].hpi_state_orig, got["1"].hpi_state_growth_1y) == (110.0, 100.0, 0.2)
    assert got["1"].est_current_ltv_from_oltv == pytest.approx(80 / 1.1)
    assert got["2"].rate_incentive is None and got["2"].hpi_state_curr is None


def test_repeated_keys_never_multiply_rows(spark):
    index = spark.createDataFrame([("AK", 20181, 1.0)] * 2, "state string, quarter_key int, hpi_index double")
    with pytest.raises(ValueError, match="repeats key"):
        market.unique_lookup(index, ["state", "quarter_key"])
    rates = spark.createDataFrame([("012018", dt.date(2018, 1, d), float(d)) for d in (3, 9)], "period_mmyyyy string, date date, v double")
    table, rows = market.unique_lookup(rates, ["period_mmyyyy"], "date")
    assert [r.v for r in table.collect()] == [9.0] and rows == 1


def test_shuffled_join_equals_broadcast_join(spark):
    months = with_effective_age(tables.panel(spark, SF))
    rates, index = queries.rates(spark, SF), queries.price_index(spark, SF)
    wanted = F.col("age") <= 12
    shown = ["LOAN_ID", "age", *market.MARKET_SERIES]
    a = market.with_market(months, rates, index, wanted).select(*shown)
    a = a.cache()
    assert a.count() == months.count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        b = market.with_market(months, rates, index, wanted, broadcast_rows=0).select(*shown)
        plan = b._jdf.queryExecution().sparkPlan().toString()
        assert plan.count("SortMergeJoin [_m_") == 3 and "BroadcastHashJoin [_m_" not in plan
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
