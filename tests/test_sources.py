import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from loanseason.operators import loans
from loanseason.schema import CORE_COLUMNS, panel_schema
from loanseason.session import materialise
from loanseason.sources import catalog, files, landing, market_files, panel_text, parity, published, reports, store
from loanseason.streaming.landing import convert_new_files
from loanseason.testbed import tables

from .conftest import month

SF = "/root/testdata/sf0.001"
NAMES = [f.name for f in panel_schema().fields]


def line(**values):
    return "|".join(str(values.get(n, "")) for n in NAMES)


def put(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{name}"
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


GOOD = [line(LOAN_ID=i, ACT_PERIOD="012018", ORIG_RATE="4.125", LOAN_AGE="0", SELLER="O\"Neil, Inc") for i in (1, 2)]


def test_schema_is_pinned():
    assert len(NAMES) == len(set(NAMES)) == 110
    kinds = [f.dataType.typeName() for f in panel_schema().fields]
    assert (kinds.count("string"), kinds.count("double"), kinds.count("integer")) == (57, 34, 19)
    assert len(CORE_COLUMNS) == 36 and set(CORE_COLUMNS) <= set(NAMES)


def test_text_reader(spark, tmp_path):
    path = put(tmp_path, "2018Q1.csv", GOOD)
    rows = panel_text.read_panel_text(spark, path).orderBy("LOAN_ID").collect()
    assert (rows[0].SELLER, rows[0].ORIG_RATE, rows[0].LOAN_AGE, rows[0].SERVICER) == ('O"Neil, Inc', 4.125, 0, None)
    assert (rows[0].orig_year, rows[0].orig_qtr) == (2018, "Q1")


@pytest.mark.parametrize("bad", ["1|2|3", line(LOAN_ID=9, ORIG_RATE="abc")])
def test_malformed_lines_fail_a_strict_read(spark, tmp_path, bad):
    path = put(tmp_path, "2018Q1.csv", GOOD + [bad])
    with pytest.raises(Exception, match="(?i)malformed"):
        panel_text.read_panel_text(spark, path).collect()


def test_conversion_statuses(spark, tmp_path):
    land, root = f"{tmp_path}/land", f"{tmp_path}/raw"
    for name in ("2017Q4", "2018Q1", "2018Q2"):
        put(land, f"{name}.csv", GOOD)
    put(land, "2018Q3.csv", GOOD + ["1|2|3"])
    put(land, "notes.txt", ["x"])
    first = {r.vintage: (r.status, r.rows, r.bad_lines) for r in landing.convert(spark, land, root, only_years=[2018]).collect()}
    assert first == {"2017Q4": ("FILTER", 0, 0), "2018Q1": ("OK", 2, 0), "2018Q2": ("OK", 2, 0), "2018Q3": ("FAIL", 3, 1)}
    assert store.stored_vintages(spark, root) == ["2018Q1", "2018Q2"]
    again = {r.vintage: r.status for r in landing.convert(spark, land, root).collect()}
    assert again == {"2017Q4": "OK", "2018Q1": "SKIP", "2018Q2": "SKIP", "2018Q3": "FAIL"}
    put(land, "2018Q1.csv", GOOD[:1])
    forced = {r.vintage: r.rows for r in landing.convert(spark, land, root, only_years=[2018], overwrite=True).collect()}
    assert forced["2018Q1"] == 1
    got = {r.vintage: r["count"] for r in store.read_raw(spark, root).groupBy("vintage").count().collect()}
    assert got == {"2017Q4": 2, "2018Q1": 1, "2018Q2": 2}


def test_panel_survives_text_and_store(spark, tmp_path):
    panel = tables.panel(spark, SF)
    text, root = f"{tmp_path}/text", f"{tmp_path}/raw"
    panel_text.write_panel_text(panel, text)
    written = store.write_raw(panel_text.read_panel_text(spark, text), root, compression="zstd", cluster=True)
    assert written == panel.count()
    back = store.read_raw(spark, root).select("vintage", *CORE_COLUMNS)
    assert back.exceptAll(panel.select("vintage", *CORE_COLUMNS)).isEmpty()
    a = loans.loan_features(store.read_raw(spark, root))
    assert a.exceptAll(loans.loan_features(panel)).isEmpty()
    with pytest.raises(Exception, match="already exists"):
        store.write_raw(panel_text.read_panel_text(spark, text), root)
    with pytest.raises(ValueError):
        store.write_raw(panel, root, compression="lz77")


def test_all_files_of_a_vintage_are_converted(spark, tmp_path):
    land, root = f"{tmp_path}/land", f"{tmp_path}/raw"
    put(land, "2018Q1.csv", GOOD)
    put(land, "part2_2018Q1.csv", GOOD[:1])
    put(land, "2018Q2.csv", GOOD)
    put(land, "late_2018Q2.csv", ["1|2|3"])
    got = {r.vintage: (r.status, r.rows, r.bad_lines) for r in landing.convert(spark, land, root).collect()}
    assert got == {"2018Q1": ("OK", 3, 0), "2018Q2": ("FAIL", 3, 1)}
    stored = spark.read.parquet(root)
    assert stored.count() == 3 and len(stored.columns) == 112


def test_stream_and_batch_share_a_store(spark, tmp_path):
    land, root, progress = (f"{tmp_path}/{n}" for n in ("land", "raw", "progress"))
    put(land, "2018Q1.csv", GOOD)
    assert convert_new_files(spark, land, root, progress).awaitTermination(120)
    put(land, "2018Q2.csv", GOOD[:1])
    got = {r.vintage: r.status for r in landing.convert(spark, land, root).collect()}
    assert got == {"2018Q1": "SKIP", "2018Q2": "OK"}
    assert {r.vintage: r["count"] for r in store.read_raw(spark, root).groupBy("vintage").count().collect()} == {"2018Q1": 2, "2018Q2": 1}
    put(land, "more_2018Q1.csv", GOOD[:1])
    assert convert_new_files(spark, land, root, progress).awaitTermination(120)
    assert {r.vintage: r["count"] for r in store.read_raw(spark, root).groupBy("vintage").count().collect()} == {"2018Q1": 3, "2018Q2": 1}


def test_feature_store_adds_refuses_and_replaces(spark, tmp_path, panel_rows):
    root = f"{tmp_path}/features"
    rows = lambda v, n: loans.outcomes(panel_rows([month(0, loan=str(k), vintage=v) for k in range(n)]))
    assert store.write_features(rows("2018Q1", 1), root) == 1
    assert store.write_features(rows("2018Q2", 2), root) == 2
    with pytest.raises(FileExistsError, match="2018Q2"):
        store.write_features(rows("2018Q2", 3), root)
    assert store.write_features(rows("2018Q2", 3), root, overwrite=True) == 3
    got = {r.vintage: r["count"] for r in store.read_features(spark, root).groupBy("vintage").count().collect()}
    assert got == {"2018Q1": 1, "2018Q2": 3}


def test_feature_store_replaces_only_the_vintages_at_hand(spark, tmp_path, panel_rows):
    root = f"{tmp_path}/features"
    both = panel_rows([month(0, vintage="2018Q1"), month(0, vintage="2018Q2")])
    assert store.write_features(loans.outcomes(both), root) == 2
    newer = panel_rows([month(0, loan=x, vintage="2018Q2") for x in ("7", "8", "9")])
    assert store.write_features(loans.outcomes(newer), root, overwrite=True) == 3
    got = {r.vintage: r["count"] for r in store.read_features(spark, root).groupBy("vintage").count().collect()}
    assert got == {"2018Q1": 1, "2018Q2": 3}


def test_streamed_conversion_takes_each_file_once(spark, tmp_path):
    land, root, progress = (f"{tmp_path}/{n}" for n in ("land", "raw", "progress"))
    put(land, "2018Q1.csv", GOOD)
    for expected in (2, 2):
        assert convert_new_files(spark, land, root, progress).awaitTermination(120)
        assert spark.read.parquet(root).count() == expected
    put(land, "2018Q2.csv", GOOD[:1])
    assert convert_new_files(spark, land, root, progress).awaitTermination(120)
    got = {r.orig_qtr: r["count"] for r in spark.read.parquet(root).groupBy("orig_qtr").count().collect()}
    assert got == {"Q1": 2, "Q2": 1}


def test_series_reader(spark, tmp_path):
    a = put(f"{tmp_path}/s", "a.csv", ["DATE,X", "2018-01-05,4.5", "bad,1", "2018-01-12,."])
    got = market_files.read_rate_series(spark, {"mortgage30us": a}).orderBy("date").collect()
    assert [(r.series, r.date, r.value) for r in got] == [
        ("mortgage30us", dt.date(2018, 1, 5), 4.5), ("mortgage30us", dt.date(2018, 1, 12), None)
    ]


@pytest.mark.parametrize(
    "lines",
    [
        ["State,Year,Qtr,index_nsa,index_sa", "AK,2018,1,101.5,9", "AK,2018,2,bad,9"],
        ["extra,st,year,quarter,HPI", "x,AK,2018,Q1,101.5"],
        ["AK,2018,1,101.5"],
    ],
)
def test_price_index_headers(spark, tmp_path, lines):
    row = market_files.read_price_index(spark, put(f"{tmp_path}/h", "h.csv", lines)).first()
    assert (row.state, row.year, row.qtr.strip("Q"), row.hpi_index) == ("AK", 2018, "1", 101.5)


def test_price_index_with_other_columns_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError):
        market_files.read_price_index(spark, put(f"{tmp_path}/h", "h.csv", ["a,b,c", "1,2,3"]))


def test_reports_keep_commas_and_views_count(spark, tmp_path, panel_rows):
    report = spark.createDataFrame([("2018Q1", 'rate=1 outside [0,1] "x"')], "vintage string, violations string")
    reports.write_report_csv(report, f"{tmp_path}/dq")
    back = spark.read.option("header", "true").option("escape", '"').csv(f"{tmp_path}/dq").first()
    assert back.violations == 'rate=1 outside [0,1] "x"'
    reports.write_summary_json(report, f"{tmp_path}/json")
    assert spark.read.json(f"{tmp_path}/json").count() == 1
    scores = spark.createDataFrame([("delinq", "val", "1", 0.5)], "task string, split string, LOAN_ID string, y_score double")
    reports.write_scores(scores, f"{tmp_path}/scores")
    assert spark.read.parquet(f"{tmp_path}/scores").first().LOAN_ID == "1"

    panel = panel_rows([month(0), month(24)])
    features = loans.outcomes(panel)
    names = catalog.register_views(panel, features)
    assert names == ["features", "features_eligible", "features_stress", "features_test", "features_train", "features_val", "raw_monthly"]
    counts = {r.view: r.rows for r in catalog.catalog_counts(panel, features).collect()}
    assert counts == {n: spark.table(n).count() for n in names}
    assert (counts["raw_monthly"], counts["features_test"], counts["features_val"]) == (2, 1, 0)
    checked = catalog.source_check(spark, {"scores": f"{tmp_path}/scores", "none": f"{tmp_path}/none"}).collect()
    assert [(r.source, r.present, r.rows) for r in checked] == [("scores", True, 1), ("none", False, 0)]


def test_text_and_store_are_held_against_each_other(spark, tmp_path):
    land, root = f"{tmp_path}/land", f"{tmp_path}/raw"
    put(land, "2018Q1.csv", GOOD)
    put(land, "late_2018Q1.csv", [*GOOD[:1], "", "  "])
    put(land, "2018Q2.csv", GOOD + ["1|2|3"])
    put(land, "2018Q3.csv", GOOD)
    landing.convert(spark, land, root)
    put(land, "2018Q3.csv", GOOD[:1])
    moved = store.read_raw(spark, root).where("vintage = '2018Q3'").withColumn("orig_year", F.lit(2019)).drop("vintage")
    store.write_raw(materialise(moved), root, overwrite=True)
    got = {r.vintage: (r.text_rows, r.stored_rows, r.difference, r.verdict) for r in parity.ingest_parity(spark, land, root).collect()}
    assert got == {
        "2018Q1": (3, 3, 0, "OK"),
        "2018Q2": (3, None, -3, "NOT STORED"),
        "2018Q3": (1, 2, 1, "DIFFERS"),
        "2019Q3": (None, 2, 2, "NO TEXT"),
    }
    one = parity.ingest_parity(spark, land, root, ["2018Q1"]).collect()
    assert [(r.vintage, r.text_files, r.verdict) for r in one] == [("2018Q1", 2, "OK")]
    assert parity.ingest_parity(spark, f"{tmp_path}/none", root).where("verdict <> 'NO TEXT'").isEmpty()


def test_a_store_by_loan_is_opened_by_another_application(spark, tmp_path):
    panel = tables.panel(spark, SF).withColumns({"orig_year": F.substring("vintage", 1, 4).cast("int"), "orig_qtr": F.substring("vintage", 5, 2)})
    root = f"{tmp_path}/by_loan"
    assert store.write_bucketed(panel.drop("vintage"), root, "by_loan_here", 3) == panel.count()
    back = store.open_bucketed(spark, root, "by_loan_elsewhere").select("vintage", *CORE_COLUMNS)
    assert back.exceptAll(panel.select("vintage", *CORE_COLUMNS)).isEmpty() and back.count() == panel.count()
    for name in ("by_loan_here", "by_loan_elsewhere"):
        text = loans.loan_features(store.open_bucketed(spark, root, name))._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in text and "Bucketed: true" in text


def test_published_partitions_show_as_a_whole(spark, tmp_path):
    root = f"{tmp_path}/features"
    rows = lambda *pairs: spark.createDataFrame(pairs, "vintage string, x int")
    read = lambda: sorted(tuple(r) for r in store.read_features(spark, root).select("vintage", "x").collect())
    assert store.publish_features(rows(("2018Q1", 1), ("2018Q1", 2), ("2018Q2", 3)), root) == 3
    before = store.read_features(spark, root)
    with pytest.raises(FileExistsError):
        store.publish_features(rows(("2018Q2", 9)), root)
    assert read() == [("2018Q1", 1), ("2018Q1", 2), ("2018Q2", 3)]

    breaks = F.udf(lambda x: 1 // 0 if x == 8 else x, "int")
    with pytest.raises(Exception, match="(?i)division"):
        store.publish_features(rows(("2018Q1", 7), ("2018Q1", 8)).repartition(2).withColumn("x", breaks("x")), root, overwrite=True)
    assert read() == [("2018Q1", 1), ("2018Q1", 2), ("2018Q2", 3)]

    assert store.publish_features(rows(("2018Q1", 5), ("2018Q3", 6)), root, overwrite=True) == 2
    assert read() == [("2018Q1", 5), ("2018Q2", 3), ("2018Q3", 6)]
    assert before.count() == 3 and set(before.columns) == {"vintage", "x"}
    assert published.drop_unlisted(spark, root) == []
    store.publish_features(rows(("2018Q2", 4)), root, overwrite=True)
    assert len(published.drop_unlisted(spark, root)) == 1
    assert read() == [("2018Q1", 5), ("2018Q2", 4), ("2018Q3", 6)]


def test_a_writer_takes_over_what_others_publish(spark, tmp_path, monkeypatch):
    root = f"{tmp_path}/raw"
    rows = lambda quarter: spark.createDataFrame([(2018, quarter, 1)], "orig_year int, orig_qtr string, x int")
    put_new, calls = files.put_new, []

    def late(spark, path, text):
        if not calls:
            calls.append(path)
            published.publish(rows("Q2"), root, store.RAW_KEYS)
        return put_new(spark, path, text)

    monkeypatch.setattr(files, "put_new", late)
    published.publish(rows("Q1"), root, store.RAW_KEYS)
    assert store.stored_vintages(spark, root) == ["2018Q1", "2018Q2"]
    assert {r.vintage for r in store.read_raw(spark, root).collect()} == {"2018Q1", "2018Q2"}
    assert not put_new(spark, calls[0], "other")


@pytest.mark.parametrize(
    "path",
    ["file:/a/2018Q1.csv", "file:/a/file=2018Q1.csv/part-0.csv.gz", "file:/Quarters/Q9_2018Q12018Q2.csv", "file:/2016Q1/b/Q2018Q3.csv.gz",
     "file:/a/2017Q4/2018Q1.csv", "file:/a/1Q2.csv", "Q1.csv", "file:/a/2018Q5.csv/2018Q2.csv", "x2018Q4", "file:/a/none.csv"],
)
def test_vintages_of_paths_equal_those_of_the_pattern(spark, path):
    row = spark.createDataFrame([(path,)], "p string").select(
        panel_text.file_vintage(F.col("p")).alias("got"), F.regexp_extract("p", r"(\d{4}Q[1-4])[^/]*(?:/[^/]*)?$", 1).alias("want")
    ).first()
    assert row.got == row.want


def test_conversion_parses_good_lines_once(spark, tmp_path, monkeypatch):
    land, root, looked = f"{tmp_path}/land", f"{tmp_path}/raw", []
    put(land, "2018Q1.csv", [*GOOD, "", " \t"])
    put(land, "2018Q2.csv", [*GOOD, line(LOAN_ID=7, **{[f.name for f in panel_schema().fields if f.dataType.typeName() == "double"][-1]: "x"}), "1|2"])
    monkeypatch.setattr(landing, "read_panel_text", lambda *a, **k: looked.append(a))
    got = {r.vintage: (r.status, r.rows, r.bad_lines) for r in landing.convert(spark, land, root).collect()}
    assert got == {"2018Q1": ("OK", 2, 0), "2018Q2": ("FAIL", 4, 2)} and not looked
    assert {r.vintage: r["count"] for r in store.read_raw(spark, root).groupBy("vintage").count().collect()} == {"2018Q1": 2}
    assert sorted(p.rsplit("/", 1)[1] for p in files.matches(spark, f"{root}/*")) == ["orig_year=2018"]


def test_conversion_of_entries_that_name_two_vintages(spark, tmp_path):
    land, root = f"{tmp_path}/land", f"{tmp_path}/raw"
    put(land, "2017Q4_2018Q1.csv", GOOD)
    put(land, "2018Q2.csv", GOOD[:1])
    landing.convert(spark, land, root).collect()
    assert {r.vintage: r["count"] for r in store.read_raw(spark, root).groupBy("vintage").count().collect()} == {"2017Q4": 2, "2018Q2": 1}
