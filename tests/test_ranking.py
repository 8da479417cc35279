"""Ranking metrics against brute force, with many ranges so that offsets matter."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanseason.operators import ranking
from loanseason.session import materialise

KEYS = {"model": "m", "task": "delinq", "split": "val"}


def make(spark, rows, **keys):
    named = {**KEYS, **keys}
    data = [(named["model"], named["task"], named["split"], f"{i:05d}", "2018Q1", int(y), float(s)) for i, (y, s) in enumerate(rows)]
    return spark.createDataFrame(data, "model string, task string, split string, LOAN_ID string, vintage string, y_true int, y_score double")


def brute(rows, k):
    y = np.array([r[0] for r in rows], float)
    s = np.array([r[1] for r in rows])
    order = np.lexsort((np.arange(len(s)), -s))
    top = max(1, int(np.ceil(k * len(s))))
    recall = y[order][:top].sum() / max(y.sum(), 1)
    ap = 0.0
    for t in np.unique(s)[::-1]:
        at, above = s == t, s >= t
        ap += y[at].sum() / max(y.sum(), 1) * y[above].mean()
    pos, neg = s[y == 1], s[y == 0]
    auc = None
    if len(pos) and len(neg):
        auc = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    return ap, auc, recall


def rows_with_ties(n, seed, share=0.4):
    rng = np.random.default_rng(seed)
    s = np.round(rng.random(n), 2)
    s[: int(n * share)] = 0.37  # one score holds a large part of all rows
    rng.shuffle(s)
    return list(zip((rng.random(n) < 0.2).astype(int), s))


@pytest.mark.parametrize("parts", [1, 7, 23])
def test_against_brute_force(spark, parts):
    small, large = rows_with_ties(40, 1), rows_with_ties(700, 2)
    scored = materialise(make(spark, small, split="test").unionByName(make(spark, large)))
    groups = ranking.score_groups(scored, parts=parts)
    ap = {r.split: r.average_precision for r in ranking.average_precision(groups).collect()}
    auc = {r.split: r.roc_auc for r in ranking.roc_auc(groups).collect()}
    recalls = {(r.split, r.k): r for r in ranking.recall_at_levels(scored, groups, (0.05, 0.3, 0.9), parts=parts).collect()}
    for split, rows in (("test", small), ("val", large)):
        for k in (0.05, 0.3, 0.9):
            want_ap, want_auc, want_recall = brute(rows, k)
            assert ap[split] == pytest.approx(want_ap, abs=1e-6)
            assert auc[split] == pytest.approx(want_auc, abs=1e-6)
            assert recalls[split, k].recall == pytest.approx(want_recall, abs=1e-6)
            assert recalls[split, k].contacted == max(1, int(np.ceil(k * len(rows))))


def test_outreach_list_is_the_head_of_the_full_order(spark):
    rows = rows_with_ties(300, 4, share=0.7)
    scored = materialise(make(spark, rows))
    got = sorted((r.rank, r.LOAN_ID) for r in ranking.outreach_list(scored, 0.5, parts=9).collect())
    full = sorted(range(300), key=lambda i: (-rows[i][1], i))[:150]
    assert got == [(n + 1, f"{i:05d}") for n, i in enumerate(full)]


def test_one_class_one_row_and_all_tied(spark):
    no_positive = ranking.score_groups(materialise(make(spark, [(0, 0.1), (0, 0.9)])))
    assert ranking.average_precision(no_positive).first().average_precision == 0.0
    assert ranking.roc_auc(no_positive).first().roc_auc is None
    single = materialise(make(spark, [(1, 0.5)]))
    row = ranking.recall_at_levels(single, ranking.score_groups(single), (0.05,)).first()
    assert (row.contacted, row.captured, row.recall) == (1, 1, 1.0)
    tied = materialise(make(spark, [(0, 0.5), (1, 0.5), (1, 0.5), (0, 0.5)]))
    groups = ranking.score_groups(tied)
    assert ranking.roc_auc(groups).first().roc_auc == 0.5
    assert ranking.recall_at_levels(tied, groups, (0.5,)).first().recall == 0.5


def test_running_totals_equal_a_plain_window(spark):
    from pyspark.sql import Window as W

    frame = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("g"),
        F.xxhash64("id").cast("double").alias("x"),
        (F.col("id") % 11).alias("v"),
    )
    w = W.partitionBy("g").orderBy("x")
    plain = frame.withColumns({"total_v": F.sum("v").over(W.partitionBy("g")), "cum_v": F.sum("v").over(w)})
    spread = ranking.running_totals(frame, ["g"], [F.asc("x")], ["v"], parts=13)
    columns = ["g", "x", "v", "cum_v", "total_v"]
    assert spread.select(*columns).exceptAll(plain.select(*columns)).isEmpty()
    assert spread.count() == 5000


def test_calibration_edges(spark):
    rows = [(0, 0.0), (1, 0.3), (0, 0.6), (1, 0.7), (1, 1.0), (0, 0.95)]
    got = {r.bin_lo: (r.bin_hi, r.n) for r in ranking.calibration(make(spark, rows)).collect()}
    assert got == {0.0: (0.1, 1), 0.2: (0.3, 1), 0.5: (0.6, 1), 0.6: (0.7, 1), 0.9: (1.0, 2)}


def test_curves_have_their_end_points(spark):
    groups = ranking.score_groups(materialise(make(spark, [(0, 0.1), (1, 0.9), (1, 0.4)])))
    pr = {(r.threshold, round(r.precision, 4), round(r.recall, 4)) for r in ranking.precision_recall_points(groups).collect()}
    assert pr == {(0.9, 1.0, 0.5), (0.4, 1.0, 1.0), (0.1, 0.6667, 1.0), (None, 1.0, 0.0)}
    roc = {(r.threshold, r.fpr, r.tpr) for r in ranking.roc_points(groups).collect()}
    assert roc == {(0.9, 0.0, 0.5), (0.4, 0.0, 1.0), (0.1, 1.0, 1.0), (None, 0.0, 0.0)}


def test_tie_heavy_table_matches_known_values(spark):
    lines = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    scored = lines.select(
        F.lit("m").alias("model"), F.lit("t").alias("task"), F.lit("all").alias("split"),
        F.round(F.col("l_discount") * 8 + F.col("l_tax") * 2, 2).alias("y_score"),
        (F.col("l_returnflag") == "R").cast("int").alias("y_true"),
    )
    groups = ranking.score_groups(scored)
    assert ranking.average_precision(groups).first().average_precision == 0.336856
    assert ranking.roc_auc(groups).first().roc_auc == 0.502046
