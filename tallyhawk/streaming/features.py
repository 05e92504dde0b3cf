"""Behaviour features on a stream, with a small state per card.

The state holds running totals, the last place and the times of the last hour.
Rows of one micro-batch are taken in time order, so the result equals the batch
features as long as a card's rows do not arrive after newer rows of an earlier
micro-batch. Such a row sees the history as it stood and no negative gap.

One card's rows of one micro-batch are handled together; the source's rate limit
(``maxFilesPerTrigger`` or ``maxOffsetsPerTrigger``) bounds how many that can be.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tallyhawk.functions.clock import micros
from tallyhawk.functions.geo import EARTH_RADIUS_KM
from tallyhawk.functions.numbers import UNITS_PER_AMOUNT, money_units
from tallyhawk.operators.behaviour import TRAILING
from tallyhawk.schema import AMOUNT, CARD, TIME, TXN
from tallyhawk.session import ship_package
from tallyhawk.settings import PROFILE_A, Thresholds

STATE = (
    "rows bigint, units bigint, hours bigint, lat double, long double, us bigint, "
    "recent array<bigint>"
)
OUTPUT = (
    "trans_num string, cc_num string, us bigint, "
    "distance_from_previous_transaction_km double, "
    "time_since_previous_transaction_hours double, location_changed int, "
    "rapid_location_change int, customer_avg_amt_so_far double, "
    "customer_relative_amount_deviation double, amount_ratio_to_normal_spending double, "
    "large_transaction_flag int, night_transaction int, "
    "customer_usual_transaction_hour double, hour_deviation_from_normal_behavior double, "
    "unusual_transaction_hour int, txn_count_last_5min bigint, txn_count_last_30min bigint, "
    "txn_count_last_60min bigint, transaction_velocity bigint, rapid_transaction_flag int"
)
_KEEP_MICROS = max(TRAILING.values()) * 1_000_000


def _distance(lat1, lon1, lat2, lon2) -> np.ndarray:
    lat1, lon1, lat2, lon2 = (np.radians(v) for v in (lat1, lon1, lat2, lon2))
    chord = (np.sin((lat2 - lat1) / 2) ** 2
             + np.cos(lat1) * np.cos(lat2) * np.sin((lon2 - lon1) / 2) ** 2)
    return 2 * EARTH_RADIUS_KM * np.arcsin(np.sqrt(np.minimum(chord, 1.0)))


def _shifted(first: np.ndarray, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Each row's predecessor; a card's first row gets what its state remembers."""
    out = np.concatenate(([np.nan], values[:-1]))
    out[starts] = first
    return out


def _before(first: np.ndarray, values: np.ndarray, starts: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Sum of what a card's state remembers and of its rows before each row."""
    running = np.cumsum(values) - values
    return first[of] + running - running[starts][of]


def history_features(rows: pd.DataFrame, state: tuple | None, limits: Thresholds):
    """Features of one card's rows in order, and the state after them."""
    out, (remembered,) = cards_features(rows, np.array([0]), [state], limits)
    return out, remembered


def cards_features(rows: pd.DataFrame, starts: np.ndarray, states: list[tuple | None], limits: Thresholds):
    """Features of the rows of several cards, card after card, and the states after them.

    ``starts`` has the place of each card's first row, ``states`` what is known of the card.
    """
    states = [state or (0, 0, 0, None, None, None, []) for state in states]
    seen, units0, hours0 = (np.array([s[i] for s in states], np.int64) for i in range(3))
    nan = float("nan")
    lat0, long0, us0 = (np.array([nan if s[i] is None else float(s[i]) for s in states]) for i in range(3, 6))
    ends = np.append(starts[1:], len(rows))
    of = np.repeat(np.arange(len(starts)), ends - starts)
    us = rows["us"].to_numpy(np.int64)
    amount = rows[AMOUNT].to_numpy(float)
    units = rows["units"].fillna(0).to_numpy(np.int64)
    hour = rows["hour"].to_numpy(np.int64)
    lat, long = rows["merch_lat"].to_numpy(float), rows["merch_long"].to_numpy(float)

    prior = seen[of] + np.arange(len(rows)) - starts[of]
    known = prior > 0
    out = {"trans_num": rows[TXN], "cc_num": rows[CARD], "us": us}

    prev_lat, prev_long = _shifted(lat0, lat, starts), _shifted(long0, long, starts)
    prev_us = _shifted(us0, us.astype(float), starts)
    moved = np.nan_to_num(_distance(lat, long, prev_lat, prev_long), nan=0.0)
    gap = np.maximum(us - prev_us, 0.0) / 3.6e9
    changed = (moved > limits.moved_km) & ~np.isnan(prev_lat)
    out["distance_from_previous_transaction_km"] = moved
    out["time_since_previous_transaction_hours"] = gap
    out["location_changed"] = changed.astype(int)
    out["rapid_location_change"] = (changed & (gap < limits.rapid_move_hours)).astype(int)

    with np.errstate(divide="ignore", invalid="ignore"):
        mean = np.where(known, _before(units0, units, starts, of) / UNITS_PER_AMOUNT / prior, nan)
        mean = np.where(np.isnan(amount), nan, mean)
        ratio = np.where(known & (mean != 0), amount / mean, 1.0)
        usual = np.where(known, _before(hours0, hour, starts, of) / prior, nan)
    ratio = np.where(np.isnan(ratio), 1.0, ratio)
    out["customer_avg_amt_so_far"] = mean
    out["customer_relative_amount_deviation"] = np.where(known, amount - mean, 0.0)
    out["amount_ratio_to_normal_spending"] = ratio
    out["large_transaction_flag"] = ((ratio >= limits.large_ratio) & known).astype(int)

    out["night_transaction"] = (
        (hour >= limits.night_from) & (hour < limits.night_until)
    ).astype(int)
    apart = np.abs(hour - usual)
    deviation = np.where(known, np.minimum(apart, 24 - apart), 0.0)
    out["customer_usual_transaction_hour"] = usual
    out["hour_deviation_from_normal_behavior"] = deviation
    out["unusual_transaction_hour"] = (
        (deviation > limits.odd_hour_deviation) & known
    ).astype(int)

    counts = {name: np.zeros(len(rows), np.int64) for name in TRAILING}
    counted = ~np.isnan(amount)
    units_after, hours_after = np.add.reduceat(units, starts), np.add.reduceat(hour, starts)
    remembered = []
    for k, (start, end) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)):
        mine = us[start:end]
        times = np.sort(np.concatenate((np.array(states[k][6], np.int64), mine[counted[start:end]])))
        before = np.searchsorted(times, mine, "left")
        for name, seconds in TRAILING.items():
            counts[name][start:end] = before - np.searchsorted(times, mine - seconds * 1_000_000, "left")
        last, known_us = int(mine[-1]), states[k][5]
        newest = last if known_us is None else max(last, int(known_us))
        stays = known_us is not None and last < known_us
        place = states[k][3:5] if stays else (_or_none(lat[end - 1]), _or_none(long[end - 1]))
        remembered.append((
            int(seen[k] + end - start), int(units0[k] + units_after[k]), int(hours0[k] + hours_after[k]),
            *place, newest, times[times >= newest - _KEEP_MICROS].tolist(),
        ))
    for name, found in counts.items():
        out[f"txn_count_{name}"] = found
    out["transaction_velocity"] = out["txn_count_last_60min"]
    out["rapid_transaction_flag"] = (
        out["txn_count_last_5min"] >= limits.rapid_count
    ).astype(int)
    return pd.DataFrame(out, index=rows.index), remembered


def _or_none(value: float) -> float | None:
    return None if np.isnan(value) else float(value)


def stream_features(stream: DataFrame, limits: Thresholds = PROFILE_A.limits) -> DataFrame:
    """Profile A features for every transaction of a stream."""
    ship_package(stream.sparkSession)
    columns = [c.strip().split(" ")[0] for c in OUTPUT.split(",")]

    def update(key, chunks: Iterator[pd.DataFrame], state: GroupState):
        rows = pd.concat(list(chunks)).sort_values(["us", TXN], kind="stable")
        out, remembered = history_features(rows, state.get if state.exists else None, limits)
        state.update(remembered)
        yield out[columns]

    needed = stream.filter(F.col(CARD).isNotNull() & F.col(TIME).isNotNull()).select(
        TXN, CARD, micros(F.col(TIME)).alias("us"), F.hour(TIME).alias("hour"), AMOUNT,
        money_units(F.col(AMOUNT)).alias("units"), "merch_lat", "merch_long",
    )
    return needed.groupBy(CARD).applyInPandasWithState(
        update, OUTPUT, STATE, "append", GroupStateTimeout.NoTimeout
    )
