"""Duplicate removal on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyhawk.schema import TIME, TXN


def stream_dedup(stream: DataFrame, *, key: str = TXN, time: str = TIME,
                 delay: str = "1 hour") -> DataFrame:
    """Keep one row per key; copies later than ``delay`` apart are not recognised.

    State is kept per key and dropped with the watermark.
    """
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])
