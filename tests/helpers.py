"""Small tables and a plain restatement of the history rules for comparison."""

import datetime as dt
import math

SCHEMA = (
    "trans_num string, cc_num string, trans_date_trans_time timestamp_ntz, amt double, "
    "merch_lat double, merch_long double"
)
START = dt.datetime(2025, 1, 1, 12)


def at(minutes=0.0):
    return START + dt.timedelta(minutes=minutes)


def table(spark, rows):
    """Rows of (id, card, time, amount[, lat, long])."""
    full = [tuple(r) + (40.0, -75.0)[: 6 - len(r)] if len(r) < 6 else tuple(r) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def by_id(df):
    return {r["trans_num"]: r.asDict() for r in df.collect()}


def km(lat1, lon1, lat2, lon2):
    lat1, lon1, lat2, lon2 = map(math.radians, (lat1, lon1, lat2, lon2))
    chord = (math.sin((lat2 - lat1) / 2) ** 2
             + math.cos(lat1) * math.cos(lat2) * math.sin((lon2 - lon1) / 2) ** 2)
    return 2 * 6371.0 * math.asin(min(1.0, math.sqrt(chord)))


def expected_history(rows):
    """Profile A features of (id, card, time, amount, lat, long), row by row."""
    out = {}
    for me in rows:
        name, card, when, amt, lat, long = me
        past = sorted(
            (r for r in rows if r[1] == card and card is not None and when is not None
             and r[2] is not None and (r[2], r[0]) < (when, name)),
            key=lambda r: (r[2], r[0]),
        )
        prev = past[-1] if past else None
        known = prev is not None and prev[4] is not None
        moved = 0.0
        if known and None not in (lat, long, prev[5]):
            moved = km(lat, long, prev[4], prev[5])
        gap = (when - prev[2]).total_seconds() / 3600 if prev else None
        changed = moved > 50 and known
        spent = [r[3] or 0.0 for r in past]
        mean = math.fsum(spent) / len(past) if past and amt is not None else None
        ratio = amt / mean if mean else 1.0
        hours = [r[2].hour for r in past]
        usual = sum(hours) / len(hours) if hours else None
        off = 0.0
        if usual is not None:
            off = min(abs(when.hour - usual), 24 - abs(when.hour - usual))
        counts = [
            sum(1 for r in past if r[3] is not None and r[2] < when
                and (when - r[2]).total_seconds() <= m * 60)
            for m in (5, 30, 60)
        ]
        out[name] = {
            "distance_from_previous_transaction_km": moved,
            "time_since_previous_transaction_hours": gap,
            "location_changed": int(changed),
            "rapid_location_change": int(changed and gap is not None and gap < 1),
            "customer_avg_amt_so_far": mean,
            "customer_relative_amount_deviation":
                (None if mean is None else amt - mean) if past else 0.0,
            "amount_ratio_to_normal_spending": ratio,
            "large_transaction_flag": int(ratio >= 3 and bool(past)),
            "customer_usual_transaction_hour": usual,
            "hour_deviation_from_normal_behavior": off,
            "unusual_transaction_hour": int(off > 6 and bool(past)),
            "txn_count_last_5min": counts[0],
            "txn_count_last_30min": counts[1],
            "txn_count_last_60min": counts[2],
            "transaction_velocity": counts[2],
            "rapid_transaction_flag": int(counts[0] >= 2),
        }
    return out


def assert_features(df, rows):
    found, wanted = by_id(df), expected_history(rows)
    assert set(found) == set(wanted)
    for name, features in wanted.items():
        for column, value in features.items():
            got = found[name][column]
            if isinstance(value, float) and got is not None:
                assert got == __import__("pytest").approx(value, rel=1e-9, abs=1e-6), (name, column)
            else:
                assert got == value, (name, column, got, value)
