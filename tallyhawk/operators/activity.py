"""Activity of actors over time: totals, shares, periods and logs.

The input is a table ``actor, day, event, added, deleted, subject``, read from a
commit log or made from any event table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

# Days looked back per interval and marks of automated actors.
LOOK_BACK = {"weekly": 7, "monthly": 30, "final": None}
AUTOMATION_MARKS = ("bot", "github-actions")


def in_scope(df: DataFrame, interval: str, as_of: dt.date, day: str = "day") -> DataFrame:
    """Events of the last 7 or 30 days before ``as_of``, or all of them."""
    days = LOOK_BACK[interval]
    if days is None:
        return df
    return df.filter(F.col(day) >= F.lit(as_of - dt.timedelta(days=days)))


def without_automation(df: DataFrame, actor: str = "actor") -> DataFrame:
    name = F.lower(actor)
    automated = F.lit(False)
    for mark in AUTOMATION_MARKS:
        automated = automated | name.contains(mark)
    return df.filter(~F.coalesce(automated, F.lit(False)))


def actor_totals(df: DataFrame) -> DataFrame:
    """Events, lines and active days per actor.

    Days are counted from per-day totals: those combine before the shuffle, so an
    actor with most of the events sends a few rows per partition.
    """
    per_day = df.groupBy("actor", "day").agg(
        F.count(F.lit(1)).alias("events"), F.sum("added").alias("added"),
        F.sum("deleted").alias("deleted"),
    )
    return per_day.groupBy("actor").agg(
        F.sum("events").alias("events"),
        F.coalesce(F.sum("added"), F.lit(0)).alias("added"),
        F.coalesce(F.sum("deleted"), F.lit(0)).alias("deleted"),
        F.count("day").alias("active_days"),
    )


def with_shares(totals: DataFrame) -> DataFrame:
    """Share of all events and net lines per actor."""
    everything = totals.agg(F.sum("events").alias("_all")).withColumn("_one", F.lit(1))
    return (
        totals.withColumn("_one", F.lit(1)).join(F.broadcast(everything), "_one")
        .withColumns({"share": F.coalesce(F.try_divide(F.col("events") * 100, F.col("_all")),
                                          F.lit(0.0)),
                      "net": F.col("added") - F.col("deleted")})
        .drop("_one", "_all")
    )


def period_key(day: Column, interval: str) -> Column:
    """Day name, ISO week or month, as the interval asks."""
    if interval == "weekly":
        return F.date_format(day, "EEE (MMM dd)")
    if interval == "monthly":
        year = F.extract(F.lit("YEAROFWEEK"), day)
        return F.format_string("%d-W%02d", year.cast("int"), F.weekofyear(day))
    return F.date_format(day, "yyyy-MM")


def period_counts(df: DataFrame, interval: str) -> DataFrame:
    return (
        df.select("actor", period_key(F.col("day"), interval).alias("period"))
        .groupBy("period", "actor").agg(F.count(F.lit(1)).alias("events"))
    )


def period_matrix(df: DataFrame, interval: str) -> DataFrame:
    """One row per actor, one column per period, 0 where an actor did nothing.

    Periods become the columns because there are few of them; actors may be many.
    """
    counts = period_counts(df, interval)
    return counts.groupBy("actor").pivot("period").agg(F.sum("events")).fillna(0)


def period_rows(df: DataFrame, interval: str) -> DataFrame:
    """The matrix in long form: every actor in every period, zeros included."""
    matrix = period_matrix(df, interval)
    periods = [c for c in matrix.columns if c != "actor"]
    return matrix.unpivot(["actor"], periods, "period", "events")


def actor_log(df: DataFrame) -> DataFrame:
    """Events per actor, newest first."""
    return df.select("actor", "day", "event", "subject").orderBy(
        "actor", F.desc("day"), F.desc("event")
    )
