"""Thresholds and the feature contracts (profiles) they belong to.

Three contracts exist for the same concepts and disagree on names and rules,
so a caller names the one wanted:

* ``A`` the rules of the feature scripts,
* ``B`` the schema a trained model expects, with no nulls,
* ``C`` the names a dataset summary looks for, built on per-card medians.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Thresholds:
    # The thresholds of the feature rules.
    moved_km: float = 50.0
    rapid_move_hours: float = 1.0
    large_ratio: float = 3.0
    odd_hour_deviation: float = 6.0
    night_from: int = 0
    night_until: int = 5
    rapid_count: int = 2
    # Values the contracts leave open; chosen here.
    max_speed_kmh: float = 900.0
    shortest_gap_seconds: float = 1.0


@dataclass(frozen=True)
class Profile:
    name: str
    limits: Thresholds = field(default_factory=Thresholds)


PROFILE_A = Profile("A")
PROFILE_B = Profile("B", Thresholds(night_from=22, night_until=6, rapid_count=1))
PROFILE_C = Profile("C")
PROFILES = {p.name: p for p in (PROFILE_A, PROFILE_B, PROFILE_C)}


@dataclass(frozen=True)
class SkewPolicy:
    """When and how the history of one busy card is cut into time slices.

    A card above ``hot_rows`` rows is cut into slices of ``slice_seconds``, and a
    slice above ``hot_rows`` rows into slices of ``fine_seconds``. Cutting changes the
    plan, never a result. A list of up to ``broadcast_keys`` busy keys is broadcast, a
    longer one is joined like any other table.

    Lookups spread the rows of a busy key over as many partitions as it has times
    ``hot_rows`` rows, and over ``salts`` at least.
    """

    hot_rows: int = 1_000_000
    slice_seconds: int = 60
    fine_seconds: int = 1
    broadcast_keys: int = 10_000
    salts: int = 8


DEFAULT_SKEW = SkewPolicy()
