import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyhawk.operators.behaviour import (
    add_behaviour,
    add_median_amounts,
    previous_transaction,
    running_amounts,
)
from tallyhawk.settings import PROFILE_A, PROFILE_B, PROFILE_C, SkewPolicy
from tests.helpers import assert_features, at, by_id, table

SLICED = SkewPolicy(hot_rows=5, slice_seconds=600, fine_seconds=60)
POLICIES = [None, SkewPolicy(), SLICED, SkewPolicy(hot_rows=0, slice_seconds=60, fine_seconds=7),
            SkewPolicy(hot_rows=5, slice_seconds=36_000, fine_seconds=600, broadcast_keys=2)]


def random_rows(n, seed, hot_share=0.4):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        card = "hot" if rnd.random() < hot_share else f"c{rnd.randrange(12)}"
        if rnd.random() < 0.03:
            card = None
        # Whole minutes make equal times and exact window borders common.
        when = at(rnd.randrange(0, 3000))
        if rnd.random() < 0.03:
            when = None
        amt = None if rnd.random() < 0.05 else round(rnd.uniform(0, 300), 2)
        lat = None if rnd.random() < 0.05 else rnd.uniform(39, 41)
        rows.append((f"t{i:04d}", card, when, amt, lat, rnd.uniform(-76, -74)))
    return rows


@pytest.mark.parametrize("policy", POLICIES)
def test_features_match_row_by_row_rules(spark, policy):
    rows = [r for r in random_rows(300, 7) if r[2] is not None]
    assert_features(add_behaviour(table(spark, rows), PROFILE_A, policy=policy), rows)


@pytest.mark.parametrize("profile", [PROFILE_A, PROFILE_B])
def test_slicing_never_changes_a_result(spark, profile):
    df = table(spark, random_rows(400, 11))
    whole = by_id(add_behaviour(df, profile, with_card_totals=True, policy=None))
    for policy in POLICIES[1:]:
        cut = by_id(add_behaviour(df, profile, with_card_totals=True, policy=policy))
        assert cut.keys() == whole.keys()
        for name, row in whole.items():
            for column, value in row.items():
                got = cut[name][column]
                if isinstance(value, float):
                    assert got == pytest.approx(value, rel=1e-9, abs=1e-6), (name, column)
                else:
                    assert got == value, (name, column)


def test_only_busy_cards_are_cut(spark):
    from tallyhawk.operators.skew import hot_keys

    df = table(spark, [(f"a{i}", "a", at(i), 1.0) for i in range(9)]
               + [(f"b{i}", "b", at(i), 1.0) for i in range(6)] + [("c", "c", at(), 1.0)])
    for bound in (1, 100):  # a longer list is a plan instead of a broadcast table
        found = hot_keys(df, "cc_num", policy=SkewPolicy(hot_rows=5, broadcast_keys=bound))
        assert sorted((r.cc_num, r["_rows"]) for r in found.collect()) == [("a", 9), ("b", 6)]
    assert hot_keys(df, "cc_num", policy=SkewPolicy(hot_rows=9)) is None


def test_close_large_amounts_keep_their_spread(spark):
    from statistics import stdev

    amounts = [50_000_000.0 + i % 3 / 100 for i in range(200)]
    df = table(spark, [(f"{i:03}", "a", at(i * 40), v) for i, v in enumerate(amounts)])
    for policy in POLICIES:
        got = by_id(add_behaviour(df, PROFILE_B, policy=policy))
        for i in (2, 100, 199):
            want = stdev(amounts[:i])
            assert got[f"{i:03}"]["customer_hist_std_amt"] == pytest.approx(want, rel=1e-3)


def test_amounts_that_are_no_number_count_as_missing(spark):
    rows = [("1", "a", at(0), 10.0), ("2", "a", at(60), float("nan")), ("3", "a", at(90), 20.0), ("4", "a", at(95), 30.0)]
    gaps = [(i, c, t, None if v != v else v) for i, c, t, v in rows]
    for policy in (None, SkewPolicy(hot_rows=0, slice_seconds=60)):
        for profile in (PROFILE_A, PROFILE_B):
            got, want = (
                by_id(add_behaviour(table(spark, r), profile, with_card_totals=True, policy=policy)) for r in (rows, gaps)
            )
            for key in want:
                left = {k: v for k, v in want[key].items() if k != "amt"}
                assert {k: v for k, v in got[key].items() if k != "amt"} == left


def test_first_row_of_a_card(spark):
    row = by_id(add_behaviour(table(spark, [("t", "c", at(), 9.0)])))["t"]
    assert row["time_since_previous_transaction_hours"] is None
    assert row["customer_avg_amt_so_far"] is None
    assert (row["amount_ratio_to_normal_spending"], row["large_transaction_flag"]) == (1.0, 0)
    assert row["customer_relative_amount_deviation"] == 0.0
    model = by_id(add_behaviour(table(spark, [("t", "c", at(), 9.0)]), PROFILE_B))["t"]
    assert None not in model.values()
    assert model["customer_hist_avg_amt"] == 9.0 and model["customer_hist_avg_hour"] == 12.0


def test_rows_of_one_instant_do_not_count_each_other(spark):
    rows = [("a", "c", at(0), 1.0), ("b", "c", at(0), 1.0), ("d", "c", at(5), 1.0),
            ("e", "c", at(5.01), 1.0)]
    found = by_id(add_behaviour(table(spark, rows), groups=("frequency",)))
    assert [found[n]["txn_count_last_5min"] for n in "abde"] == [0, 0, 2, 1]


def test_thresholds_are_strict_or_not_as_specified(spark):
    rows = [
        # A gap of exactly one hour is not rapid, a second less is.
        ("g1", "g", at(0), 10.0, 40.0, -75.0), ("g2", "g", at(60), 10.0, 41.0, -75.0),
        ("h1", "h", at(0), 10.0, 40.0, -75.0), ("h2", "h", at(59.9), 10.0, 41.0, -75.0),
        # Three times the mean is large.
        ("r1", "r", at(0), 10.0), ("r2", "r", at(1), 30.0),
        # Six hours off are not unusual; 23 h and 1 h are two hours apart.
        ("o1", "o", dt.datetime(2025, 1, 1, 6), 1.0), ("o2", "o", dt.datetime(2025, 1, 1, 12), 1.0),
        ("p1", "p", dt.datetime(2025, 1, 1, 1), 1.0), ("p2", "p", dt.datetime(2025, 1, 1, 23), 1.0),
        # A mean of zero gives a ratio of one.
        ("z1", "z", at(0), 0.0), ("z2", "z", at(1), 50.0),
    ]
    found = by_id(add_behaviour(table(spark, rows)))
    assert (found["g2"]["location_changed"], found["g2"]["rapid_location_change"]) == (1, 0)
    assert found["h2"]["rapid_location_change"] == 1
    assert found["r2"]["large_transaction_flag"] == 1
    assert found["o2"]["unusual_transaction_hour"] == 0
    assert found["p2"]["hour_deviation_from_normal_behavior"] == 2.0
    assert found["z2"]["amount_ratio_to_normal_spending"] == 1.0


def test_profiles_disagree_on_night_rapid_count_and_rapid_move(spark):
    rows = [("a", "c", dt.datetime(2025, 1, 1, 23, 0), 1.0, 40.0, -75.0),
            ("b", "c", dt.datetime(2025, 1, 1, 23, 1), 1.0, 40.3, -75.0)]
    code = by_id(add_behaviour(table(spark, rows), PROFILE_A))["b"]
    model = by_id(add_behaviour(table(spark, rows), PROFILE_B))["b"]
    assert (code["night_transaction"], model["night_transaction"]) == (0, 1)
    assert (code["rapid_transaction_flag"], model["rapid_transaction_flag"]) == (0, 1)
    # 33 km in a minute: no change of place, yet faster than any plane.
    assert (code["rapid_location_change"], model["rapid_location_change"]) == (0, 1)
    assert model["location_changed"] == 0


def test_missing_card_or_time_has_no_history(spark):
    rows = [("a", None, at(0), 5.0), ("b", None, at(1), 6.0), ("c", "x", None, 7.0),
            ("d", "x", at(2), 8.0)]
    found = by_id(add_behaviour(table(spark, rows), with_card_totals=True))
    assert all(found[n]["txn_count_last_60min"] == 0 for n in "abcd")
    assert found["b"]["time_since_previous_transaction_hours"] is None
    assert found["b"]["customer_txn_count"] is None
    assert found["d"]["customer_avg_amt_so_far"] is None


def test_running_totals_and_previous_row(spark):
    rows = [("a", "c", at(0), 5.0, 1.0, 2.0), ("b", "c", at(1), None, 3.0, 4.0),
            ("d", "c", at(2), 2.5, 5.0, 6.0)]
    for policy in (None, SkewPolicy(hot_rows=0, slice_seconds=60)):
        runs = by_id(running_amounts(table(spark, rows), policy=policy))
        assert [runs[n]["running_amt"] for n in "abd"] == [5.0, 5.0, 7.5]
        assert [runs[n]["running_rows"] for n in "abd"] == [1, 2, 3]
        prev = by_id(previous_transaction(table(spark, rows), policy=policy))
        assert [prev[n]["prev_lat"] for n in "abd"] == [None, 1.0, 3.0]


def test_medians_are_exact(spark):
    rows = random_rows(300, 3)
    found = by_id(add_median_amounts(table(spark, rows), policy=SLICED))
    import statistics
    for name, card, _, amt, *_ in rows:
        values = [r[3] for r in rows if r[1] == card and r[3] is not None]
        wanted = statistics.median(values) if card is not None and values else None
        assert found[name]["customer_median_amt"] == (
            None if wanted is None else pytest.approx(wanted))
    assert set(by_id(add_behaviour(table(spark, rows), PROFILE_C))) == {r[0] for r in rows}


def test_history_needs_one_shuffle_of_the_table(spark):
    df = table(spark, random_rows(50, 1))
    plan = add_behaviour(df, PROFILE_B, with_card_totals=True, policy=None)
    text = plan._jdf.queryExecution().sparkPlan().toString()
    executed = plan._jdf.queryExecution().executedPlan().toString()
    assert executed.count("Exchange") == 1 and executed.count("Sort [") == 1
    assert "BatchEvalPython" not in text
