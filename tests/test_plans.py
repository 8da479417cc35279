"""What the physical plans must look like."""

import pytest
from pyspark.sql import functions as F

from loanseason.operators import loans, quality, splits
from loanseason.operators.ranking import running_totals
from loanseason.sources import store
from loanseason.testbed import queries, tables

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def roots(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("stores")
    panel = tables.panel(spark, SF)
    keyed = panel.withColumns({"orig_year": F.substring("vintage", 1, 4).cast("int"), "orig_qtr": F.substring("vintage", 5, 2)})
    store.write_raw(keyed.drop("vintage"), f"{base}/raw")
    store.write_features(loans.loan_features(panel), f"{base}/features")
    return f"{base}/raw", f"{base}/features"


def test_labels_need_one_shuffle_and_no_sort(spark, roots):
    text = plan(loans.labels(store.read_raw(spark, roots[0])))
    assert text.count("Exchange hashpartitioning") == 1
    assert "SortAggregate" not in text and "HashAggregate" in text and "Python" not in text


def test_snapshot_hashes_before_it_sorts(spark, roots):
    text = plan(loans.loan_features(store.read_raw(spark, roots[0])))
    assert text.count("Exchange hashpartitioning") == 2
    # The row-level step reads the scan and is hashed; sorting only sees its output.
    assert text.index("SortAggregate") < text.index("HashAggregate")
    assert text.rindex("Sort [") < text.index("HashAggregate")


def test_unfolded_panel_needs_no_shuffle_of_months(spark):
    text = plan(loans.labels(tables.panel(spark, SF)))
    above = text[: text.index("Generate explode")]
    assert "Exchange hashpartitioning" not in above


def test_column_pruning_reaches_the_scan(spark, roots):
    text = plan(loans.labels(store.read_raw(spark, roots[0])))
    schema = text[text.index("ReadSchema") :]
    assert "ZB_CODE" in schema and "CURRENT_UPB" not in schema and "SELLER" not in schema


def test_split_prunes_partitions_and_pushes_the_filter(spark, roots):
    text = plan(splits.load_split(store.read_features(spark, roots[1]), "val", tables.BANDS, ["DTI"]))
    assert "PartitionFilters: [isnotnull(vintage" in text or "PartitionFilters: [(cast(substring(cast(vintage" in text
    assert "substring" in text[text.index("PartitionFilters") : text.index("PushedFilters")]
    assert "EqualTo(eligible,1)" in text
    assert "ORIG_RATE" not in text[text.index("ReadSchema") :]


def test_quality_is_one_grouping(spark, roots):
    text = plan(quality.quality_report(store.read_features(spark, roots[1])))
    assert text.count("FileScan parquet") == 1 and text.count("Exchange hashpartitioning") == 1


def test_running_totals_never_run_in_one_task(spark):
    frame = spark.range(1000).select(F.lit("a").alias("g"), F.col("id").alias("x"), F.lit(1).alias("v"))
    spread = running_totals(frame, ["g"], [F.asc("x")], ["v"], parts=8)
    assert "SinglePartition" not in plan(spread)
    ranges = spread.select(((F.col("cum_v") - 1) / 125).cast("int").alias("r")).groupBy("r").count().count()
    assert ranges == 8


def test_no_query_runs_rows_through_python(spark):
    for key in ("loan_features", "dq_report", "panel_gaps", "score_metrics", "outreach_list", "onehot"):
        assert "Python" not in plan(queries.QUERIES[key](spark, SF)), key
