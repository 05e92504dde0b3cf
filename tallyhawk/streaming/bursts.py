"""Sliding-window counts per card on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyhawk.schema import AMOUNT, CARD, TIME


def stream_bursts(stream: DataFrame, *, width: str = "60 minutes", slide: str = "5 minutes",
                  delay: str = "1 hour") -> DataFrame:
    """Transactions per card and sliding window.

    Counts combine before the shuffle, so a busy card sends one row per window
    and input partition.
    """
    return (
        stream.withWatermark(TIME, delay)
        .groupBy(F.window(TIME, width, slide), CARD)
        .agg(F.count(AMOUNT).alias("transactions"), F.sum(AMOUNT).alias("spent"))
        .select(F.col("window.start").alias("window_start"),
                F.col("window.end").alias("window_end"), CARD, "transactions", "spent")
    )


def sliding_totals(panes: DataFrame, *, width: str = "60 minutes", slide: str = "5 minutes") -> DataFrame:
    """Sliding windows from what ``stream_bursts`` gives for windows of ``slide`` that do not overlap.

    A stream then keeps one row per card and slide instead of one per card and window;
    ``width`` is a multiple of ``slide``.
    """
    return (
        panes.groupBy(F.window("window_start", width, slide), CARD)
        .agg(F.sum("transactions").alias("transactions"), F.sum("spent").alias("spent"))
        .select(F.col("window.start").alias("window_start"),
                F.col("window.end").alias("window_end"), CARD, "transactions", "spent")
    )
