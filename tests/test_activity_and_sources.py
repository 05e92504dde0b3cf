import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyhawk.operators import activity as A
from tallyhawk.plans.driver_view import raw_transactions
from tallyhawk.plans.queries_history import clean_view
from tallyhawk.schema import RAW_SCHEMA
from tallyhawk.sources import reports, tables
from tallyhawk.sources.commit_log import read_commit_log

LOG = """COMMIT|||a1|||Ann|||2025-01-06|||first COMMIT||| of all
10\t2\tsrc/a.py
-\t-\tlogo.png

COMMIT|||b2|||Bob Stone|||2025-01-07|||no files
COMMIT|||c3|||dependabot[bot]|||2025-01-07|||bump
100\t100\tlock
COMMIT|||broken
5\t5\tx
COMMIT|||d4|||Ann|||2024-12-30|||late
1\t1\ta b.txt
3\t0\tc
"""


@pytest.fixture()
def log(spark, tmp_path):
    (tmp_path / "log.txt").write_text(LOG)
    return read_commit_log(spark, str(tmp_path / "log.txt"))


def test_commit_log(log):
    rows = {r.event: r for r in log.collect()}
    assert set(rows) == {"a1", "b2", "c3", "d4"}
    assert (rows["a1"].added, rows["a1"].deleted) == (10, 2)
    assert rows["a1"].subject == "first COMMIT"
    assert (rows["b2"].actor, rows["b2"].added) == ("Bob Stone", 0)
    assert (rows["d4"].added, rows["d4"].deleted, rows["d4"].day) == (4, 1, dt.date(2024, 12, 30))


def test_totals_shares_and_scope(log):
    people = A.without_automation(log)
    rows = {r.actor: r for r in A.with_shares(A.actor_totals(people)).collect()}
    assert set(rows) == {"Ann", "Bob Stone"}
    ann = rows["Ann"]
    assert (ann.events, ann.added, ann.deleted, ann.active_days, ann.net) == (2, 14, 3, 2, 11)
    assert ann.share == pytest.approx(200 / 3)
    as_of = dt.date(2025, 1, 8)
    assert {r.event for r in A.in_scope(people, "weekly", as_of).collect()} == {"a1", "b2"}
    assert A.in_scope(people, "final", as_of).count() == 3


def test_periods(log):
    keys = log.filter("event = 'd4'").select(
        *[A.period_key(F.col("day"), i) for i in ("weekly", "monthly", "final")]).first()
    # The last days of 2024 belong to the first ISO week of 2025.
    assert tuple(keys) == ("Mon (Dec 30)", "2025-W01", "2024-12")
    matrix = {r.actor: r.asDict() for r in A.period_matrix(A.without_automation(log), "final").collect()}
    assert matrix["Bob Stone"] == {"actor": "Bob Stone", "2024-12": 0, "2025-01": 1}
    assert A.period_rows(A.without_automation(log), "final").count() == 4
    assert [r.event for r in A.actor_log(A.without_automation(log)).collect()] == ["a1", "d4", "b2"]


def test_load_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.load_dataset(spark, str(tmp_path / "none"))
    path = str(tmp_path / "empty")
    tables.write_stage(spark.range(0), path)
    with pytest.raises(ValueError):
        tables.load_dataset(spark, path)


def test_csv_keeps_codes(spark, sf_dir, tmp_path):
    df = clean_view(spark, sf_dir)
    path = str(tmp_path / "csv")
    tables.write_csv(df, path)
    back = tables.read_clean_csv(spark, path, df.schema)
    assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()
    assert tables.with_text_codes(RAW_SCHEMA)["merch_zipcode"].dataType.typeName() == "string"


def test_reports(spark, sf_dir, tmp_path):
    df = clean_view(spark, sf_dir)
    lines = [r.line for r in reports.validation_report(df).orderBy("section", "place").collect()]
    assert lines[:2] == ["# Data Validation Report", "Rows validated: 1,000"]
    assert lines[2] == "- amt <= 0: 0" and lines[-1].startswith("**Note:**")
    path = str(tmp_path / "report")
    reports.write_lines(reports.behaviour_report(df), path)
    text = [r.value for r in spark.read.text(path).collect()]
    assert text[0] == "# Customer Behavioral Analysis"
    assert text[1].startswith("Overall fraud rate: ") and text[1].endswith("of 1,000 transactions)")
    assert text[-1].startswith("- Average amount on normal transactions: ")
    assert sum(t.startswith("- ") and ":00 -> " in t for t in text) == 5


def test_filters_reach_the_scan(spark, sf_dir):
    from tallyhawk.operators.scoring import card_history

    plan = card_history(raw_transactions(spark, sf_dir), "4000000000000008").select("amt")
    scan = plan._jdf.queryExecution().executedPlan().toString()
    assert "props" not in scan.split("ReadSchema")[1]
