import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyhawk.operators.behaviour import add_behaviour
from tallyhawk.plans import queries_activity
from tallyhawk.plans.queries_activity import arrivals, run_to_end
from tallyhawk.settings import PROFILE_A
from tallyhawk.streaming import ordered
from tallyhawk.streaming.features import cards_features, history_features
from tallyhawk.streaming.ordered import END, end_marker, stream_ordered_features
from tests.helpers import table
from tests.test_history import random_rows


def same(got, want):
    found = {r.trans_num: r.asDict() for r in got.collect()}
    wanted = {r.trans_num: r.asDict() for r in want.collect()}
    assert found.keys() == wanted.keys() and got.count() == len(found)
    for name, row in found.items():
        for column, value in row.items():
            if column in ("us", "trans_num"):
                continue
            expected = wanted[name][column]
            if expected is None:
                assert value is None or value != value, (name, column, value)
            elif isinstance(expected, str):
                assert value == expected
            else:
                assert value == pytest.approx(expected, rel=1e-9, abs=1e-9), (name, column)


@pytest.mark.parametrize("release", [50_000, 3])
def test_rows_out_of_order_equal_the_batch(spark, monkeypatch, release):
    monkeypatch.setattr(ordered, "RELEASE", release)
    df = table(spark, random_rows(260, release))
    assert not df.where("cc_num is null").isEmpty() and not df.where("trans_date_trans_time is null").isEmpty()
    stream = arrivals(spark, df, steps=4, hours=5)
    same(run_to_end(spark, stream_ordered_features(stream, delay="6 hours")), add_behaviour(df))


def test_nothing_is_released_before_the_watermark(spark, tmp_path):
    df = table(spark, [r for r in random_rows(120, 2) if r[1] is not None and r[2] is not None])
    folder = str(tmp_path / "in")
    df.coalesce(1).write.parquet(folder)
    read = lambda: spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    got = run_to_end(spark, stream_ordered_features(read(), delay="10 hours"))
    last = df.agg(F.max("trans_date_trans_time")).first()[0]
    ready = df.where(F.col("trans_date_trans_time") <= F.lit(last) - F.expr("interval 10 hours"))
    assert 0 < ready.count() < df.count()
    same(got, add_behaviour(df).join(ready.select("trans_num"), "trans_num", "left_semi"))
    time.sleep(0.05)
    end_marker(df).write.mode("append").parquet(folder)
    same(run_to_end(spark, stream_ordered_features(read(), delay="10 hours")), add_behaviour(df))


def test_the_marker_has_the_columns_of_the_rows(spark):
    df = table(spark, random_rows(10, 1))
    row = end_marker(df)
    assert row.schema.simpleString() == df.schema.simpleString()
    assert row.first()["cc_num"] == END and row.first()["trans_num"] is None


def test_steps_of_many_files_lose_no_row(spark, monkeypatch):
    # A step whose files came in two micro-batches left rows behind the watermark.
    monkeypatch.setattr(queries_activity, "FILE_ROWS", 8)
    monkeypatch.setattr(queries_activity, "STEP_ROWS", 100)
    df = table(spark, random_rows(260, 4))
    stream = arrivals(spark, df, steps=2, hours=5)
    same(run_to_end(spark, stream_ordered_features(stream, delay="6 hours")), add_behaviour(df))


def test_cards_together_equal_cards_alone():
    rng = np.random.default_rng(7)
    rows = pd.DataFrame({
        "trans_num": [f"{k:03d}" for k in range(90)], "cc_num": [f"c{k % 4}" for k in range(90)],
        "us": rng.integers(0, 4 * 3_600_000_000, 90), "hour": rng.integers(0, 24, 90),
        "amt": np.where(rng.random(90) < 0.1, np.nan, rng.integers(1, 90, 90) / 4),
        "merch_lat": np.where(rng.random(90) < 0.1, np.nan, 40 + rng.random(90)), "merch_long": -75 + rng.random(90),
    }).assign(units=lambda r: (r["amt"] * 10_000).round())
    rows = rows.sort_values(["cc_num", "us"], ignore_index=True)
    limits = PROFILE_A.limits
    firsts, lasts = rows.groupby("cc_num").head(8), rows.groupby("cc_num").tail(-8).reset_index(drop=True)
    known = {"c1": None}  # a card of which nothing is known beside others
    for card in ("c0", "c2", "c3"):
        known[card] = history_features(firsts[firsts["cc_num"] == card], None, limits)[1]
    starts = np.flatnonzero(~lasts["cc_num"].duplicated().to_numpy())
    got, after = cards_features(lasts, starts, [known[c] for c in lasts["cc_num"][starts]], limits)
    alone = [history_features(part.reset_index(drop=True), known[card], limits) for card, part in lasts.groupby("cc_num")]
    pd.testing.assert_frame_equal(got, pd.concat([a[0] for a in alone], ignore_index=True))
    assert after == [a[1] for a in alone]
    assert ordered._unpack_histories(ordered._pack_histories({"c": after[0]})) == {"c": after[0]}
    assert ordered._unpack_histories(ordered._pack_histories({})) == {}
