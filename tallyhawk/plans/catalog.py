"""All registered queries."""

from __future__ import annotations

from tallyhawk.plans import (
    queries_activity,
    queries_clean,
    queries_history,
    queries_profile,
    queries_risk,
    queries_stress,
)
from tallyhawk.plans.registry import Query

QUERIES: dict[str, Query] = {
    **queries_clean.QUERIES,
    **queries_history.QUERIES,
    **queries_profile.QUERIES,
    **queries_risk.QUERIES,
    **queries_activity.QUERIES,
    **queries_stress.QUERIES,
}
