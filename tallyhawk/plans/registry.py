"""What a registered query is, and the helpers the query modules share."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

DIGITS = 6
# Money means often end in an exact tie at the last digit, where two engines that
# differ in the last bit of a double round apart. The nudge moves ties off it.
NUDGE = 1.2345678e-8


class Query(NamedTuple):
    """A Spark query over the given tables and, where SQL can say it, its twin."""

    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round fractions, so two engines may differ in the last bits of a double."""
    return df.selectExpr(*[
        f"round(`{c}` + {NUDGE}, {digits}) + 0e0 as `{c}`" if t in ("double", "float")
        else f"`{c}`"
        for c, t in df.dtypes
    ])


def round_sql(body: str, *columns: str, digits: int = DIGITS) -> str:
    """The same rounding on the SQL side, for the named columns of a select."""
    changes = ", ".join(f'round("{c}" + {NUDGE}, {digits}) + 0e0 as "{c}"' for c in columns)
    return f"select * replace ({changes}) from ({body}) r"


def rounded_array(values: Column, digits: int = DIGITS) -> Column:
    """An array of doubles with every element rounded."""
    return F.transform(values, lambda v: F.round(v + NUDGE, digits) + 0e0)


def array_sql(items: list[str], digits: int = DIGITS) -> str:
    """The same on the SQL side, from one expression for each element."""
    return "[" + ", ".join(f"round({x} + {NUDGE}, {digits}) + 0e0" for x in items) + "]"
