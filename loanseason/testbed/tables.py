"""Loan panel, rate series and price index derived from the order tables.

One order is one loan; its months run from age -1 to a horizon. Each table is
written once as SQL text and rendered for Spark and for DuckDB, so that the
query under test and its oracle start from equal rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..config import EraBound, QualityContract, SplitBands

# The test orders run from 1995 to 2001, so the year bands move accordingly.
BANDS = SplitBands(train=(1995, 1998), val=(1999, 1999), test=(2000, 2000), stress=(2001, 2001))
CONTRACT = QualityContract(
    eras=(EraBound(1995, 1997, 0.001, 0.08), EraBound(1998, 2001, 0.025, 0.25)),
)
CONTRACT_ALL = QualityContract(eras=CONTRACT.eras, all_declared=True)

_SPARK = {
    "str": "STRING",
    "orders": "{orders}",
    "lineitem": "{lineitem}",
    "customer": "{customer}",
    "nation": "{nation}",
    "loan": "{loan}",
    "ages": "explode(sequence(-1, CAST(horizon AS INT)))",
    "div": "div",
    "int": "INT",
}
_DUCK = {
    "str": "VARCHAR",
    "orders": "orders",
    "lineitem": "lineitem",
    "customer": "customer",
    "nation": "nation",
    "ages": "unnest(generate_series(-1, horizon))",
    "div": "//",
    "int": "INTEGER",
}

_LOANS = """
SELECT o.o_orderkey, c.c_custkey, c.c_nationkey, o.o_totalprice, o.o_orderstatus, o.o_orderpriority,
  c.c_mktsegment, n.n_name, li.mx_disc,
  year(o.o_orderdate) * 12 + month(o.o_orderdate) AS om,
  6 + (o.o_orderkey * 31) % 30 AS horizon, (o.o_orderkey * 17) % 28 AS dlq_start,
  CASE WHEN o.o_orderkey % 6 = 0 THEN (o.o_orderkey * 13) % 9 ELSE 0 END AS dlq_len
FROM {orders} o
JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {nation} n ON c.c_nationkey = n.n_nationkey
LEFT JOIN (SELECT l_orderkey, max(l_discount) AS mx_disc FROM {lineitem} GROUP BY l_orderkey) li
  ON li.l_orderkey = o.o_orderkey
"""

# Everything that does not depend on the month is settled once per loan.
_KEYED_LOANS = """
SELECT o_orderkey, o_totalprice, om, horizon, dlq_start, dlq_len, o_orderpriority,
  CAST(o_orderkey AS {str}) AS LOAN_ID,
  concat(CAST((om - 1) {div} 12 AS {str}), 'Q', CAST(((om - 1) % 12) {div} 3 + 1 AS {str})) AS vintage,
  concat(lpad(CAST((om - 1) % 12 + 1 AS {str}), 2, '0'), CAST((om - 1) {div} 12 AS {str})) AS ORIG_DATE,
  concat(lpad(CAST((om + 1) % 12 + 1 AS {str}), 2, '0'), CAST((om + 1) {div} 12 AS {str})) AS FIRST_PAY,
  3.0 + mx_disc * 50 AS ORIG_RATE, o_totalprice AS ORIG_UPB,
  CAST(CASE WHEN o_orderkey % 4 = 0 THEN 180 ELSE 360 END AS {int}) AS ORIG_TERM,
  CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE CAST(40 + o_orderkey % 60 AS {int}) END AS OLTV,
  CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE CAST(40 + o_orderkey % 60 + o_orderkey % 7 AS {int}) END AS OCLTV,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(1 + o_orderkey % 3 AS {int}) END AS NUM_BO,
  CASE WHEN c_custkey % 40 = 0 THEN NULL ELSE CAST(300 + (c_custkey * 37) % 560 AS {int}) END AS CSCORE_B,
  CASE WHEN o_orderkey % 5 = 0 THEN CAST(300 + (o_orderkey * 41) % 550 AS {int}) END AS CSCORE_C,
  CASE WHEN om > 2001 * 12 AND o_orderkey % 7 = 0 THEN 'MH' WHEN o_orderkey % 3 = 0 THEN 'SF'
       WHEN o_orderkey % 3 = 1 THEN 'PU' ELSE 'CO' END AS PROP,
  o_orderstatus AS OCC_STAT,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 4 = 0 THEN 'Y' ELSE 'N' END AS FIRST_FLAG,
  c_mktsegment AS CHANNEL, n_name AS STATE,
  lpad(CAST(c_nationkey * 1000 + c_custkey % 50 AS {str}), 5, '0') AS MSA,
  concat('SELLER_', CAST(o_orderkey % 12 AS {str})) AS SELLER
FROM (""" + _LOANS + """) loan
"""

_PANEL = """
WITH x AS (SELECT *, {ages} AS age FROM {loan}),
y AS (
  SELECT *, om + age AS pm, (o_orderkey * 7919 + age * 104729) % 1000 AS h,
    CASE WHEN age = horizon AND horizon < 30 AND o_orderkey % 10 < 9 THEN 1 ELSE 0 END AS term
  FROM x),
z AS (
  SELECT *, concat(lpad(CAST((pm - 1) % 12 + 1 AS {str}), 2, '0'), CAST((pm - 1) {div} 12 AS {str})) AS act
  FROM y)
SELECT LOAN_ID, vintage, act AS ACT_PERIOD, ORIG_DATE, FIRST_PAY,
  CASE WHEN term = 1 THEN NULL ELSE CAST(age AS {int}) END AS LOAN_AGE,
  CAST(360 - age AS {int}) AS REM_MONTHS,
  CASE WHEN h < 5 THEN 'XX'
       WHEN age >= dlq_start AND age < dlq_start + dlq_len
       THEN lpad(CAST(age - dlq_start + 1 AS {str}), 2, '0') ELSE '00' END AS DLQ_STATUS,
  CASE WHEN term = 1 THEN CASE WHEN o_orderkey % 10 < 6 THEN '01' WHEN o_orderkey % 10 = 6 THEN '02'
       WHEN o_orderkey % 10 = 7 THEN '09' ELSE '16' END END AS ZB_CODE,
  CASE WHEN term = 1 THEN act END AS ZB_DTE,
  CASE WHEN h % 50 = 7 THEN NULL ELSE o_totalprice * (360 - age) / 360 END AS CURRENT_UPB,
  CASE WHEN h BETWEEN 990 AND 994 THEN 'Y' ELSE 'N' END AS MOD_FLAG,
  ORIG_RATE, ORIG_UPB, ORIG_TERM, OLTV, OCLTV, NUM_BO, CSCORE_B, CSCORE_C,
  CASE WHEN o_orderkey % 20 = 0 OR (o_orderkey % 9 = 1 AND age < 2) THEN NULL
       ELSE CAST(10 + o_orderkey % 60 AS {int}) END AS DTI,
  CASE WHEN o_orderkey % 13 = 1 AND age < 1 THEN NULL ELSE o_orderpriority END AS PURPOSE,
  PROP, OCC_STAT, FIRST_FLAG, CHANNEL, STATE, MSA, SELLER,
  concat('SERVICER_', CAST((o_orderkey + CASE WHEN age >= 18 THEN 1 ELSE 0 END) % 9 AS {str})) AS SERVICER,
  CASE WHEN term = 1 THEN act END AS LAST_PAID_INSTALLMENT_DATE,
  CASE WHEN term = 1 AND o_orderkey % 10 IN (6, 7) THEN act END AS FORECLOSURE_DATE,
  CASE WHEN term = 1 AND o_orderkey % 10 IN (6, 7) THEN o_totalprice * 80 / 100 END AS NET_SALES_PROCEEDS,
  CASE WHEN h BETWEEN 990 AND 994 THEN CAST(h AS DOUBLE) END AS NON_INTEREST_BEARING_UPB,
  CASE WHEN term = 1 AND o_orderkey % 10 = 7 THEN CAST(o_orderkey % 1000 AS DOUBLE) END
    AS FORECLOSURE_PRINCIPAL_WRITE_OFF_AMOUNT,
  CASE WHEN h BETWEEN 990 AND 994 THEN CAST(age AS DOUBLE) END AS CURRENT_PERIOD_MODIFICATION_LOSS_AMOUNT,
  CASE WHEN term = 1 AND o_orderkey % 10 IN (6, 7) THEN CAST(o_orderkey % 5000 AS DOUBLE) END
    AS CUMULATIVE_CREDIT_EVENT_NET_GAIN_OR_LOSS
FROM z
"""

_LOAN_MONTHS = """
SELECT vintage, CAST(horizon + 2 AS BIGINT) AS months FROM (""" + _KEYED_LOANS + """) keyed
"""

_SERIES_BY_DATE = """
SELECT CAST(l_shipdate AS DATE) AS dt,
  CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS DOUBLE) / count(*) AS mortgage30us,
  CASE WHEN day(l_shipdate) = 1 AND month(l_shipdate) <> 7
       THEN CAST(sum(CAST(round(l_quantity) AS BIGINT)) AS DOUBLE) / count(*) END AS unrate,
  CASE WHEN day(l_shipdate) % 3 = 0 THEN NULL
       ELSE CAST(sum(CAST(round(l_tax * 100) AS BIGINT)) AS DOUBLE) / count(*) END AS dgs10,
  CASE WHEN day(l_shipdate) % 5 <> 0 THEN NULL
       ELSE CAST(sum(CAST(round(l_tax * 50) AS BIGINT)) AS DOUBLE) / count(*) END AS gs3m
FROM {lineitem} GROUP BY l_shipdate
"""

_INDEX_INPUT = """
SELECT n.n_name AS state, CAST(year(o.o_orderdate) AS {int}) AS year, CAST(quarter(o.o_orderdate) AS {int}) AS qtr,
  CAST(sum(CAST(round(o.o_totalprice) AS BIGINT)) AS DOUBLE) / count(*) AS hpi_index
FROM {orders} o
JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {nation} n ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_name, year(o.o_orderdate), quarter(o.o_orderdate)
"""


def duck(template: str) -> str:
    return template.format(**_DUCK, loan="keyed")


def _spark(spark: SparkSession, sf_dir: str, template: str) -> DataFrame:
    names = [n for n in ("orders", "lineitem", "customer", "nation") if "{" + n + "}" in template]
    tables = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}
    return spark.sql(template.format(**_SPARK), **tables)


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly rows: the core columns plus ``vintage``.

    Loans are spread by their key while they are still one narrow row each. The months
    unfold in place, so a later grouping by loan needs no shuffle of the monthly rows.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    loans = _spark(spark, sf_dir, _KEYED_LOANS).repartition(parts, "vintage", "LOAN_ID")
    return spark.sql(_PANEL.format(**_SPARK), loan=loans)


def loan_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of panel rows each loan must have, taken from the loan attributes."""
    return _spark(spark, sf_dir, _LOAN_MONTHS)


def series_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark(spark, sf_dir, _SERIES_BY_DATE)


def rate_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The series in long form, with gaps, as a merge of source files would give."""
    wide = series_by_date(spark, sf_dir).withColumnRenamed("dt", "date")
    return wide.unpivot(["date"], ["mortgage30us", "unrate", "dgs10", "gs3m"], "series", "value")


def index_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark(spark, sf_dir, _INDEX_INPUT)


PANEL_SQL = f"WITH keyed AS ({duck(_KEYED_LOANS)}), " + duck(_PANEL).strip().removeprefix("WITH ")
LOAN_MONTHS_SQL = duck(_LOAN_MONTHS)
SERIES_SQL = duck(_SERIES_BY_DATE)
INDEX_SQL = duck(_INDEX_INPUT)
