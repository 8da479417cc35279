"""Sketches of distinct loans, and categories of very many levels."""

from pyspark.sql import functions as F

from loanseason.operators import loan_counts, prep


def months(spark, vintages, loans=3000):
    rows = spark.range(loans * len(vintages) * 2).select(
        F.get(F.array(*map(F.lit, vintages)), (F.col("id") % len(vintages)).cast("int")).alias("vintage"),
        (F.col("id") % (loans * len(vintages))).cast("string").alias("LOAN_ID"),
    )
    return rows


def test_sketches_merge_over_any_range(spark, tmp_path):
    panel, root = months(spark, ["2018Q1", "2018Q2", "2019Q1"]), f"{tmp_path}/sketches"
    assert loan_counts.refresh_sketches(panel.where("vintage < '2019Q1'"), root) == ["2018Q1", "2018Q2"]
    # What is sketched already is not read again: these rows would double it.
    more = panel.union(panel.withColumn("LOAN_ID", F.concat(F.lit("x"), "LOAN_ID")))
    assert loan_counts.refresh_sketches(more.where("vintage <> '2019Q1'").union(panel.where("vintage = '2019Q1'")), root) == ["2018Q1", "2018Q2", "2019Q1"]
    sketches = loan_counts.read_sketches(spark, root)
    ranges = [("2018Q1", "2018Q1"), ("2018Q1", "2018Q4"), ("2000Q1", "2020Q4"), ("1990Q1", "1991Q4")]
    got = {(r["first"], r["last"]): r for r in loan_counts.loans_in_ranges(sketches, ranges).collect()}
    assert set(got) == set(ranges[:3])
    for (key, n) in zip(ranges, (3000, 6000, 9000)):
        assert got[key].rows == 2 * n and abs(got[key].estimate - n) <= loan_counts.STATED_ERROR * n
    loan_counts.refresh_sketches(more, root, again=["2018Q1"])
    again = loan_counts.loans_in_ranges(loan_counts.read_sketches(spark, root), ranges[:1]).first()
    assert abs(again.estimate - 6000) <= loan_counts.STATED_ERROR * 6000


def test_a_loan_of_two_vintages_counts_once(spark):
    rows = spark.createDataFrame([("2018Q1", "a"), ("2018Q2", "a"), ("2018Q2", "b"), ("2018Q2", None)], "vintage string, LOAN_ID string")
    got = loan_counts.loans_in_ranges(loan_counts.vintage_sketches(rows), [("2018Q1", "2018Q2")]).first()
    assert (got.rows, got.estimate) == (4, 2)


def test_many_levels_do_not_grow_the_plan(spark):
    def fitted(levels):
        train = spark.range(levels).select(F.format_string("l%07d", "id").alias("PURPOSE"), F.lit(None).cast("string").alias("SELLER"))
        return prep.SparseLevels.fit(train, ["PURPOSE", "SELLER"])

    rows = spark.createDataFrame([("l0000007", None), ("unknown", "unknown"), (None, None)], "PURPOSE string, SELLER string")
    few, many = fitted(20), fitted(100_001)
    sizes = [len(e.transform(rows)._jdf.queryExecution().optimizedPlan().toString()) for e in (few, many)]
    assert abs(sizes[0] - sizes[1]) < 200
    got = [r.levels for r in many.transform(rows).collect()]
    assert many.names[7] == "PURPOSE_l0000007" and many.names[-1] == "SELLER___MISSING__" and len(many.names) == 100_002
    assert got[0].size == 100_002 and got[0].indices.tolist() == [7, 100_001]
    assert got[1].indices.tolist() == [] and got[2].indices.tolist() == [100_001]
