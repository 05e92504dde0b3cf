"""Location, amount, timing and frequency features of a card's history.

Each group states what it needs from the history and how its features follow
from it. Any set of groups is computed in one scan, so four groups cost one
shuffle and one sort, not four.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tallyhawk.functions.clock import circular_hours, hour_within, micros
from tallyhawk.functions.geo import haversine_km
from tallyhawk.functions.numbers import flag, from_units, known, money_units
from tallyhawk.operators.history import HistorySpec, sample_deviation, scan_history
from tallyhawk.operators.quantiles import grouped_quantiles
from tallyhawk.operators.skew import lookup_join
from tallyhawk.schema import AMOUNT, CARD, TIME, TXN
from tallyhawk.settings import DEFAULT_SKEW, PROFILE_A, Profile, SkewPolicy, Thresholds

MICROS_PER_HOUR = 3_600_000_000.0

# Trailing windows in seconds.
TRAILING = {"last_5min": 300, "last_30min": 1800, "last_60min": 3600}


@dataclass(frozen=True)
class FeatureGroup:
    needs: HistorySpec
    features: Callable[[Profile], dict[str, Column]]
    # Values used by several features, in steps that build on each other.
    values: Callable[[Profile], list[dict[str, Column]]] = lambda profile: []


def _has_history() -> Column:
    return F.col("h_rows") > 0


# --- location ---------------------------------------------------------------


def moved_km() -> Column:
    """Distance to the merchant of the card's previous transaction, else 0."""
    prev = F.col("h_prev")
    return F.coalesce(
        haversine_km(F.col("merch_lat"), F.col("merch_long"), prev["lat"], prev["long"]),
        F.lit(0.0),
    )


def gap_hours() -> Column:
    """Hours since the card's previous transaction; null for its first."""
    return (micros(F.col(TIME)) - F.col("h_prev")["us"]) / MICROS_PER_HOUR


def speed_kmh(moved: Column, gap: Column, limits: Thresholds) -> Column:
    """Speed the card would have travelled at; 0 without a previous place."""
    shortest = F.lit(limits.shortest_gap_seconds / 3600.0)
    return F.coalesce(moved / F.greatest(gap, shortest), F.lit(0.0))


def _location_values(profile: Profile) -> list[dict[str, Column]]:
    speed = speed_kmh(F.col("v_moved"), F.col("v_gap"), profile.limits)
    return [{"v_moved": moved_km(), "v_gap": gap_hours()}, {"v_speed": speed}]


def _location(profile: Profile) -> dict[str, Column]:
    limits = profile.limits
    moved, gap, speed = F.col("v_moved"), F.col("v_gap"), F.col("v_speed")
    changed = (moved > limits.moved_km) & F.col("h_prev")["lat"].isNotNull()
    if profile.name == "B":
        return {
            "prev_trans_distance_km": moved,
            "hours_since_prev_trans": F.coalesce(gap, F.lit(0.0)),
            "location_changed": flag(changed),
            "implied_travel_speed_kmh": speed,
            "rapid_location_change": flag(speed > limits.max_speed_kmh),
        }
    rapid = flag(changed & (gap < limits.rapid_move_hours))
    if profile.name == "C":
        return {
            "location_changed": flag(changed),
            "distance_from_previous_location_km": moved,
            "rapid_location_change": rapid,
        }
    return {
        "distance_from_previous_transaction_km": moved,
        "time_since_previous_transaction_hours": gap,
        "location_changed": flag(changed),
        "rapid_location_change": rapid,
    }


# --- amount -----------------------------------------------------------------


def past_mean_amount() -> Column:
    """Mean of the earlier amounts. A missing amount still counts as a row, and a
    row without an amount has no mean to be compared with."""
    mean = from_units(F.col("h_units")) / F.col("h_rows")
    return F.when(_has_history() & known(F.col(AMOUNT)).isNotNull(), mean)


def _amount_values(profile: Profile) -> list[dict[str, Column]]:
    ratio = F.coalesce(F.try_divide(known(F.col(AMOUNT)), F.col("v_mean")), F.lit(1.0))
    return [{"v_mean": past_mean_amount()}, {"v_ratio": ratio}]


def _amount(profile: Profile) -> dict[str, Column]:
    mean, ratio = F.col("v_mean"), F.col("v_ratio")
    deviation = F.when(_has_history(), known(F.col(AMOUNT)) - mean).otherwise(F.lit(0.0))
    large = flag((ratio >= profile.limits.large_ratio) & _has_history())
    if profile.name == "B":
        return {
            "customer_hist_avg_amt": F.coalesce(mean, known(F.col(AMOUNT))),
            "customer_hist_std_amt": F.coalesce(sample_deviation("spent"), F.lit(0.0)),
            "amount_ratio_to_normal": ratio,
            "customer_relative_amount_deviation": deviation,
            "large_transaction_flag": large,
        }
    return {
        "customer_avg_amt_so_far": mean,
        "customer_relative_amount_deviation": deviation,
        "amount_ratio_to_normal_spending": ratio,
        "large_transaction_flag": large,
    }


# --- timing -----------------------------------------------------------------


def past_mean_hour() -> Column:
    return F.when(_has_history(), F.col("h_hours") / F.col("h_rows"))


def _timing_values(profile: Profile) -> list[dict[str, Column]]:
    off = circular_hours(F.col("v_hour").cast("double"), F.col("v_usual"))
    return [{"v_hour": F.hour(TIME), "v_usual": past_mean_hour()},
            {"v_off": F.coalesce(off, F.lit(0.0))}]


def _timing(profile: Profile) -> dict[str, Column]:
    limits = profile.limits
    hour, deviation = F.col("v_hour"), F.col("v_off")
    night = F.coalesce(hour_within(hour, limits.night_from, limits.night_until), F.lit(0))
    odd = flag((deviation > limits.odd_hour_deviation) & _has_history())
    if profile.name == "B":
        usual = F.coalesce(F.col("v_usual"), hour.cast("double"))
        names = ("customer_hist_avg_hour", "hour_deviation_from_normal")
    elif profile.name == "C":
        usual = F.col("v_usual")
        names = ("customer_usual_hour", "hour_deviation_from_customer_pattern")
    else:
        usual = F.col("v_usual")
        names = ("customer_usual_transaction_hour", "hour_deviation_from_normal_behavior")
    return {
        "night_transaction": night,
        names[0]: usual,
        names[1]: deviation,
        "unusual_transaction_hour": odd,
    }


# --- frequency --------------------------------------------------------------


def _frequency(profile: Profile) -> dict[str, Column]:
    rapid = flag(F.col("h_last_5min") >= profile.limits.rapid_count)
    if profile.name == "C":
        return {
            "transactions_last_5min": F.col("h_last_5min"),
            "transactions_last_30min": F.col("h_last_30min"),
            "transactions_last_1hour": F.col("h_last_60min"),
            "rapid_transaction_flag": rapid,
        }
    counts = {f"txn_count_{name}": F.col(f"h_{name}") for name in TRAILING}
    if profile.name == "B":
        velocity = {"transaction_velocity_per_min": F.col("h_last_60min") / 60.0}
    else:
        velocity = {"transaction_velocity": F.col("h_last_60min")}
    return {**counts, **velocity, "rapid_transaction_flag": rapid}


def _amount_needs(profile: Profile) -> HistorySpec:
    moments = {"spent": known(F.col(AMOUNT))} if profile.name == "B" else {}
    return HistorySpec(sums={"units": money_units(known(F.col(AMOUNT)))}, moments=moments)


def feature_groups(profile: Profile) -> dict[str, FeatureGroup]:
    places = {"lat": F.col("merch_lat"), "long": F.col("merch_long")}
    groups = {
        "location": FeatureGroup(HistorySpec(previous=places), _location, _location_values),
        "amount": FeatureGroup(_amount_needs(profile), _amount, _amount_values),
        "timing": FeatureGroup(
            HistorySpec(sums={"hours": F.hour(TIME).cast("bigint")}), _timing, _timing_values
        ),
        "frequency": FeatureGroup(HistorySpec(trailing=TRAILING), _frequency),
    }
    if profile.name == "C":
        del groups["amount"]
    return groups


ALL_GROUPS = ("location", "amount", "timing", "frequency")


def add_behaviour(
    df: DataFrame,
    profile: Profile = PROFILE_A,
    groups: Sequence[str] = ALL_GROUPS,
    *,
    with_card_totals: bool = False,
    tie: Sequence[str] = (TXN,),
    policy: SkewPolicy | None = DEFAULT_SKEW,
) -> DataFrame:
    """Add the chosen feature groups of a profile in one pass over the history.

    ``with_card_totals`` adds the per-card count and mean over the whole table in
    the same pass. Profile C compares amounts with the card's median, which is a
    lookup of its own.
    """
    defined = feature_groups(profile)
    spec = HistorySpec()
    features: dict[str, Column] = {}
    steps: list[dict[str, Column]] = [{}, {}]
    for name in groups:
        if name in defined:
            spec = spec.merge(defined[name].needs)
            features.update(defined[name].features(profile))
            for step, values in zip(steps, defined[name].values(profile)):
                step.update(values)
    if with_card_totals:
        amount = known(F.col(AMOUNT))
        spec = spec.merge(
            HistorySpec(totals={"all_rows": F.when(amount.isNotNull(), 1),
                                "all_units": money_units(amount)})
        )
        steps[0]["v_card_mean"] = F.try_divide(
            from_units(F.col("h_all_units")), F.col("h_all_rows")
        )
        mean = F.col("v_card_mean")
        features["customer_txn_count"] = F.col("h_all_rows")
        features["customer_avg_amt"] = mean
        features["amt_vs_customer_avg"] = amount - mean
    scanned = scan_history(df, spec, tie=tie, policy=policy)
    for step in steps:
        scanned = scanned.withColumns(step)
    out = scanned.select(*df.columns, *[c.alias(n) for n, c in features.items()])
    if profile.name == "C" and "amount" in groups:
        out = add_median_amounts(out, profile, policy=policy)
    return out


def card_medians(df: DataFrame, key: str = CARD, amount: str = AMOUNT) -> DataFrame:
    """Exact median amount per card."""
    medians = grouped_quantiles(df, [key], amount, [0.5])
    return medians.select(key, F.col("quantile").alias("customer_median_amt"))


def add_median_amounts(
    df: DataFrame, profile: Profile = PROFILE_A, *, policy: SkewPolicy | None = DEFAULT_SKEW
) -> DataFrame:
    """Compare each amount with the median of its card."""
    joined = lookup_join(df, card_medians(df), CARD, F.col(TXN), policy)
    median = F.col("customer_median_amt")
    ratio = F.coalesce(F.try_divide(known(F.col(AMOUNT)), median), F.lit(1.0))
    return joined.withColumns(
        {
            "amount_deviation": known(F.col(AMOUNT)) - median,
            "amount_ratio_to_customer_median": ratio,
            "large_transaction_flag": flag(ratio >= profile.limits.large_ratio),
        }
    )


def running_amounts(
    df: DataFrame, *, tie: Sequence[str] = (TXN,), policy: SkewPolicy | None = DEFAULT_SKEW
) -> DataFrame:
    """Running sum of amounts and running row number, the current row included."""
    spec = HistorySpec(sums={"units": money_units(known(F.col(AMOUNT)))})
    scanned = scan_history(df, spec, tie=tie, policy=policy)
    own = F.coalesce(money_units(known(F.col(AMOUNT))), F.lit(0))
    return scanned.withColumns(
        {
            "running_amt": F.when(F.col(CARD).isNotNull(), from_units(F.col("h_units") + own)),
            "running_rows": F.when(F.col(CARD).isNotNull(), F.col("h_rows") + 1),
        }
    ).drop(*spec.columns())


def previous_transaction(
    df: DataFrame, *, tie: Sequence[str] = (TXN,), policy: SkewPolicy | None = DEFAULT_SKEW
) -> DataFrame:
    """Place and time of the card's previous transaction."""
    spec = HistorySpec(previous={"lat": F.col("merch_lat"), "long": F.col("merch_long")})
    scanned = scan_history(df, spec, tie=tie, policy=policy)
    prev = F.col("h_prev")
    return scanned.withColumns(
        {"prev_lat": prev["lat"], "prev_long": prev["long"], "prev_us": prev["us"]}
    ).drop(*spec.columns())
