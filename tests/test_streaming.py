import time

import pytest
from pyspark.sql import functions as F

from tallyhawk.operators.behaviour import add_behaviour
from tallyhawk.plans import queries_activity
from tallyhawk.plans.driver_view import raw_transactions
from tallyhawk.plans.queries_activity import run_to_end
from tallyhawk.streaming.bursts import stream_bursts
from tallyhawk.streaming.dedup import stream_dedup
from tallyhawk.streaming.features import stream_features
from tests.test_history import random_rows
from tests.helpers import table


def in_time_order(df, folder, files=4):
    """Write rows as files that arrive in time order."""
    rows = df.orderBy("trans_date_trans_time", "trans_num").collect()
    size = -(-len(rows) // files)
    for i in range(files):
        df.sparkSession.createDataFrame(rows[i * size:(i + 1) * size], df.schema).coalesce(1) \
            .write.mode("append").parquet(folder)
        time.sleep(0.05)


def stream(spark, schema, folder):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_stream_features_equal_batch(spark, tmp_path):
    # Whole minutes may meet at a file border, so rows get their own seconds.
    rows = [r for r in random_rows(240, 5) if r[2] is not None and r[1] is not None]
    df = table(spark, rows).withColumn(
        "trans_date_trans_time",
        F.expr("trans_date_trans_time + make_dt_interval(0, 0, 0, cast(substr(trans_num, 2) as int) % 60)"))
    df = df.dropDuplicates(["cc_num", "trans_date_trans_time"])
    folder = str(tmp_path / "in")
    in_time_order(df, folder)
    got = run_to_end(spark, stream_features(stream(spark, df.schema, folder)))
    want = {r.trans_num: r.asDict() for r in add_behaviour(spark.read.parquet(folder)).collect()}
    found = {r.trans_num: r.asDict() for r in got.collect()}
    assert found.keys() == want.keys()
    for name, row in found.items():
        for column, value in row.items():
            if column in ("us", "trans_num", "cc_num"):
                continue
            wanted = want[name][column]
            if wanted is None:
                assert value is None or value != value, (name, column, value)
            else:
                assert value == pytest.approx(wanted, rel=1e-9, abs=1e-9), (name, column)


def test_stream_dedup_keeps_one_of_each(spark, sf_dir, tmp_path):
    df = raw_transactions(spark, sf_dir).select("trans_num", "trans_date_trans_time", "amt")
    df = df.withColumn("trans_date_trans_time", F.col("trans_date_trans_time").cast("timestamp"))
    twice = df.unionByName(df.limit(100))
    folder = str(tmp_path / "in")
    twice.coalesce(1).write.parquet(folder)
    got = run_to_end(spark, stream_dedup(stream(spark, twice.schema, folder)))
    assert got.count() == df.count() and got.exceptAll(df).isEmpty()


def test_stream_bursts_count_closed_windows(spark, sf_dir, tmp_path):
    df = raw_transactions(spark, sf_dir).select("cc_num", "trans_date_trans_time", "amt")
    df = df.withColumn("trans_date_trans_time", F.col("trans_date_trans_time").cast("timestamp"))
    folder = str(tmp_path / "in")
    df.coalesce(1).write.parquet(folder)
    got = run_to_end(spark, stream_bursts(stream(spark, df.schema, folder)))
    batch = df.groupBy(F.window("trans_date_trans_time", "60 minutes", "5 minutes"), "cc_num").agg(
        F.count("amt").alias("n")).select("window.end", "cc_num", "n")
    closed = df.agg(F.max("trans_date_trans_time") - F.expr("interval 1 hour")).first()[0]
    want = {tuple(r) for r in batch.filter(F.col("end") <= closed).collect()}
    assert {(r.window_end, r.cc_num, r.transactions) for r in got.collect()} == want


def test_panes_add_up_to_sliding_windows(spark, monkeypatch):
    """The stream keeps a row per card and pane, and its windows are those of a batch."""
    monkeypatch.setattr(queries_activity, "STEP_ROWS", 150)
    monkeypatch.setattr(queries_activity, "FILE_ROWS", 20)
    df = table(spark, random_rows(400, 11))
    monkeypatch.setattr(queries_activity, "raw_transactions", lambda *_: df)
    held = []

    def panes(stream, **windows):
        held.append(windows)
        return stream_bursts(stream, **windows)

    monkeypatch.setattr(queries_activity, "stream_bursts", panes)
    got = queries_activity._bursts(spark, "")
    assert held == [{"width": "5 minutes"}]
    at = F.col("trans_date_trans_time").cast("timestamp")
    want = df.groupBy(F.window(at, "60 minutes", "5 minutes"), "cc_num").agg(
        F.count("amt").alias("n"), F.sum("amt").alias("s")).select(
        F.unix_micros("window.start").alias("w"), F.unix_micros("window.end"), "cc_num", "n", F.round("s", 4))
    found = got.select("window_start", "window_end", "cc_num", "transactions", F.round("spent", 4))
    key = lambda r: repr(tuple(r))
    assert sorted(map(tuple, found.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
