"""Numeric helpers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Currencies have at most four decimals, so amounts are summed as whole
# ten-thousandths: the sum is exact and does not depend on the order of rows.
UNITS_PER_AMOUNT = 10_000


def known(value: Column) -> Column:
    """The value, and null for not-a-number, which counts as missing."""
    return F.when(~F.isnan(value), value)


def money_units(amount: Column) -> Column:
    return F.round(amount * float(UNITS_PER_AMOUNT)).try_cast("bigint")


def from_units(units: Column) -> Column:
    return units.cast("double") / float(UNITS_PER_AMOUNT)


def flag(condition: Column) -> Column:
    """1 or 0; an unknown condition is 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def violates(condition: Column) -> Column:
    """True when ``condition`` does not hold, an unknown one included."""
    return ~F.coalesce(condition, F.lit(False))


def gender_code(c: Column) -> Column:
    return F.when(c == "M", 0).when(c == "F", 1)


def log_amount(amount: Column) -> Column:
    return F.log1p(amount)


def missing(column: str, kind: str) -> Column:
    """True for null and, in a column of fractions, for not-a-number."""
    value = F.col(f"`{column}`")
    if kind in ("double", "float"):
        return value.isNull() | F.isnan(value)
    return value.isNull()
