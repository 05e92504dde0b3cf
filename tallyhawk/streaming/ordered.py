"""Behaviour features on a stream whose rows arrive out of order.

A card's rows are held in a state until the watermark has passed them, then released in
the order of their times, so each sees the history it would see in a batch. An event-time
timer wakes cards that get no more rows. Rows without a card or a time have no history;
they pass at once, without state.

Cards share BUCKETS states by a hash, as a call from Spark costs far more than the few rows
of one card in one micro-batch. What is held is bounded by the rows of a bucket's cards
within ``delay``; what a micro-batch releases is worked through ``RELEASE`` rows at a time.
Rows that come later than ``delay`` behind the newest are late for the whole stream and
Spark leaves them out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tallyhawk.functions.clock import micros
from tallyhawk.functions.numbers import money_units
from tallyhawk.schema import AMOUNT, CARD, TIME, TXN
from tallyhawk.session import ship_package
from tallyhawk.settings import PROFILE_A, Thresholds
from tallyhawk.streaming.features import OUTPUT, cards_features

#: Rows that are worked through together.
RELEASE = 50_000
#: States that the cards are dealt to.
BUCKETS = 256
#: Card of the row that ends a stream; see ``end_marker``.
END = "end-of-stream"
_ROW = pa.schema([
    (TXN, pa.string()), (CARD, pa.string()), ("us", pa.int64()), ("hour", pa.int32()), (AMOUNT, pa.float64()),
    ("units", pa.int64()), ("merch_lat", pa.float64()), ("merch_long", pa.float64()),
])
_HISTORY = pa.schema([
    (CARD, pa.string()), ("rows", pa.int64()), ("units", pa.int64()), ("hours", pa.int64()), ("lat", pa.float64()),
    ("long", pa.float64()), ("us", pa.int64()), ("recent", pa.list_(pa.int64())),
])
#: Histories and held rows of a bucket's cards, as Arrow streams.
_STATE = "history binary, held binary"
_COLUMNS = [part.split()[0] for part in OUTPUT.split(", ")]


def _packed(rows: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, rows.schema) as writer:
        writer.write_table(rows)
    return out.getvalue().to_pybytes()


def _unpacked(raw: bytes) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(bytes(raw))).read_all()


def _pack_histories(histories: dict[str, tuple]) -> bytes:
    columns = list(zip(*((card, *history) for card, history in histories.items()), strict=True)) or [()] * len(_HISTORY)
    return _packed(pa.Table.from_arrays(
        [pa.array(column, kind) for column, kind in zip(columns, _HISTORY.types, strict=True)], schema=_HISTORY
    ))


def _unpack_histories(raw: bytes) -> dict[str, tuple]:
    cards, *columns = (column.to_pylist() for column in _unpacked(raw).columns)
    return dict(zip(cards, zip(*columns, strict=True), strict=True))


def _release(rows: pd.DataFrame, histories: dict[str, tuple], limits: Thresholds) -> Iterator[pd.DataFrame]:
    """Features of rows, each card's in order, some at a time; ``histories`` goes along."""
    rows = rows.sort_values([CARD, "us", TXN], kind="stable", ignore_index=True)
    for start in range(0, len(rows), RELEASE):
        part = rows.iloc[start : start + RELEASE].reset_index(drop=True)
        cards = part[CARD].to_numpy()
        starts = np.flatnonzero(np.append(True, cards[1:] != cards[:-1]))
        found, after = cards_features(part, starts, [histories.get(card) for card in cards[starts]], limits)
        histories.update(zip(cards[starts], after, strict=True))
        yield found[_COLUMNS]


def stream_ordered_features(
    stream: DataFrame, delay: str = "1 hour", limits: Thresholds = PROFILE_A.limits
) -> DataFrame:
    """Profile A features of every transaction of a stream, equal to those of a batch.

    A row appears once the watermark (``delay`` behind the newest time seen) has passed it;
    ``end_marker`` releases the last ones of a stream that ends. Rows of one card and time
    follow each other by transaction number, null before all others. Rows without a card or
    a time appear at once, with the features of a row that has no history.
    """
    ship_package(stream.sparkSession)
    event = F.col(TIME).cast("timestamp")
    columns = [
        TXN, CARD, micros(F.col(TIME)).alias("us"), F.hour(TIME).alias("hour"), F.col(AMOUNT).cast("double").alias(AMOUNT),
        money_units(F.col(AMOUNT)).alias("units"), F.col("merch_lat").cast("double").alias("merch_lat"),
        F.col("merch_long").cast("double").alias("merch_long"),
    ]
    known = F.col(CARD).isNotNull() & F.col(TIME).isNotNull()
    timed = stream.filter(known).withColumn("_event", event).withWatermark("_event", delay).select(*columns, "_event")

    def update(key, chunks: Iterator[pd.DataFrame], state: GroupState):
        histories, parts = {}, [chunk[_ROW.names] for chunk in chunks]
        if state.exists:
            history, held = state.get
            histories = _unpack_histories(history)
            parts.insert(0, _unpacked(held).to_pandas())
        parts = [part for part in parts if len(part)]
        rows = pd.concat(parts) if parts else _ROW.empty_table().to_pandas()
        passed = rows["us"].to_numpy(np.int64) <= state.getCurrentWatermarkMs() * 1000
        waiting = rows[~passed]
        yield from _release(rows[passed], histories, limits)
        held = pa.Table.from_pandas(waiting, schema=_ROW, preserve_index=False)
        state.update((_pack_histories(histories), _packed(held)))
        if len(waiting):
            state.setTimeoutTimestamp(int(waiting["us"].min()) // 1000 + 1)

    bucket = F.pmod(F.xxhash64(CARD), F.lit(BUCKETS)).cast("int")
    ordered = timed.withColumn("_bucket", bucket).groupBy("_bucket").applyInPandasWithState(
        update, OUTPUT, _STATE, "append", GroupStateTimeout.EventTimeTimeout
    )

    def alone(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if not len(rows):
                continue
            hour = rows["hour"].to_numpy(float)
            night = (hour >= limits.night_from) & (hour < limits.night_until)
            out = pd.DataFrame({"trans_num": rows[TXN], "cc_num": rows[CARD], "us": rows["us"]})
            for part in OUTPUT.split(", ")[3:]:
                name, kind = part.split()
                out[name] = 0.0 if kind == "double" else 0
            out["night_transaction"] = night.astype(int)
            out["amount_ratio_to_normal_spending"] = 1.0
            for name in (
                "time_since_previous_transaction_hours", "customer_avg_amt_so_far", "customer_usual_transaction_hour"
            ):
                out[name] = np.nan
            yield out[_COLUMNS]

    lonely = stream.filter(~known).select(*columns).mapInPandas(alone, OUTPUT)
    return ordered.unionByName(lonely)


def end_marker(rows: DataFrame, after: str = "3650 days") -> DataFrame:
    """One row with the columns of ``rows``, far behind its last time, for a stream's last file.

    It moves the watermark past all rows and is itself never released.
    """
    last = rows.agg(F.max(TIME).alias(TIME))
    values = {TIME: F.col(TIME) + F.expr(f"interval {after}"), CARD: F.lit(END)}
    return last.select(*[
        values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in rows.schema
    ])
