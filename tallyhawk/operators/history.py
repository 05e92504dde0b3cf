"""What a card did before each of its transactions, without one task per card.

Everything asked of a card's past is a running total over its rows in time
order: sums, counts, the last row seen, and trailing counts as the difference of
two running counts. Running totals can be cut anywhere and joined up again, so
the history of a busy card is cut into time slices. Each slice is scanned on its
own; one small row per slice carries the totals of all earlier slices forward.
An ordinary card is one slice and needs one shuffle and one sort.

Trailing counts of a busy card use leave events: a row that entered at ``t``
leaves the window ``w`` at ``t + w``, in the slice of that moment, so no slice
has to look into another. All frames start at the beginning of the slice and only
grow, so Spark updates them row by row instead of rescanning the window.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhawk.functions.clock import micros
from tallyhawk.functions.numbers import known
from tallyhawk.operators.skew import hot_keys, mark_hot
from tallyhawk.schema import AMOUNT, CARD, TIME, TXN
from tallyhawk.settings import DEFAULT_SKEW, SkewPolicy

_KEY, _AT, _KIND, _HOT, _FINE, _SLICE = "_key", "_at", "_kind", "_hot", "_fine", "_slice"
_COUNTED = "_counted"
_SPREAD = 65_536


@dataclass(frozen=True)
class HistorySpec:
    """What to carry along a card's history.

    ``sums`` and ``totals`` add up bigint columns, over the earlier rows and over
    all rows of the card. ``moments`` gives count, mean and squared deviations of
    earlier values. ``previous`` keeps values of the row right before. ``trailing``
    counts earlier rows with an amount within so many seconds.
    """

    sums: dict[str, Column] = field(default_factory=dict)
    totals: dict[str, Column] = field(default_factory=dict)
    moments: dict[str, Column] = field(default_factory=dict)
    previous: dict[str, Column] = field(default_factory=dict)
    trailing: dict[str, int] = field(default_factory=dict)

    def merge(self, other: "HistorySpec") -> "HistorySpec":
        return HistorySpec(
            {**self.sums, **other.sums},
            {**self.totals, **other.totals},
            {**self.moments, **other.moments},
            {**self.previous, **other.previous},
            {**self.trailing, **other.trailing},
        )

    def columns(self) -> list[str]:
        """Names of the columns :func:`scan_history` adds."""
        names = ["h_rows"]
        names += [f"h_{n}" for n in (*self.sums, *self.totals)]
        names += [f"h_{n}_{part}" for n in self.moments for part in ("n", "mean", "m2")]
        names += ["h_prev"] if self.previous else []
        return names + [f"h_{n}" for n in self.trailing]


def scan_history(
    df: DataFrame,
    spec: HistorySpec,
    *,
    key: str = CARD,
    time: str = TIME,
    tie: Sequence[str] = (TXN,),
    counted: Column | None = None,
    policy: SkewPolicy | None = DEFAULT_SKEW,
) -> DataFrame:
    """Add the history columns of ``spec`` to every row of ``df``.

    Rows are ordered by ``time`` and then ``tie``. A row without key or time has
    no history and belongs to nobody else's. ``policy=None`` states that no key
    is busy and leaves the slicing out of the plan.
    """
    counted = known(F.col(AMOUNT)).isNotNull() if counted is None else counted
    busy = hot_keys(df, key, policy=policy) if policy is not None else None
    sliced = busy is not None
    events = _events(df, spec, key, time, tie, counted, policy, busy)
    scanned = _scan_slices(events, spec, tie, sliced)
    if sliced:
        carried = _carry(events.filter(F.col(_HOT)), spec, tie)
        scanned = scanned.join(carried, [_KEY, _SLICE], "left").filter(F.col(_KIND) == 0)
    return scanned.select(*df.columns, *_combine(spec, sliced))


def _events(df, spec, key, time, tie, counted, policy, busy) -> DataFrame:
    inputs = {f"_in_{n}": c for group in (spec.sums, spec.totals, spec.moments)
              for n, c in group.items()}
    if spec.previous:
        inputs["_in_prev"] = F.struct(
            *[c.alias(n) for n, c in spec.previous.items()], micros(F.col(time)).alias("us")
        )
    staged = df.withColumns(
        {**inputs, _AT: micros(F.col(time)), _COUNTED: F.when(counted, 1)}
    )
    # Rows outside every history are kept apart by their hash, in slices of their own.
    apart = -1 - F.pmod(F.xxhash64(*tie), F.lit(_SPREAD))
    if busy is None:
        # The bare key, so that a table stored in buckets of it is not shuffled.
        outside = F.col(key).isNull() | F.col(_AT).isNull()
        return staged.withColumns(
            {_KEY: F.col(key), _SLICE: F.when(outside, apart).otherwise(F.lit(0).cast("bigint")),
             _KIND: F.lit(0)}
        )
    staged = staged.withColumn(_KEY, F.when(F.col(_AT).isNotNull(), F.col(key)))
    staged = mark_hot(staged, busy.withColumnRenamed(key, _KEY), _HOT)
    widths = [seconds * 1_000_000 for seconds in spec.trailing.values()]
    if widths:
        kinds = F.when(
            F.col(_HOT) & F.col(_COUNTED).isNotNull(),
            F.array(*[F.lit(k) for k in range(len(widths) + 1)]),
        ).otherwise(F.array(F.lit(0)))
        offsets = F.array(F.lit(0).cast("bigint"), *[F.lit(w).cast("bigint") for w in widths])
        entered = F.col(_KIND) == 0
        staged = staged.withColumn(_KIND, F.explode(kinds)).select(
            *[
                F.when(entered, F.col(f"`{c}`")).alias(c)
                for c in (*df.columns, *inputs, _COUNTED)
            ],
            _KEY, _HOT, _KIND,
            (F.col(_AT) + F.element_at(offsets, F.col(_KIND) + 1)).alias(_AT),
        )
    else:
        staged = staged.withColumn(_KIND, F.lit(0))
    # A slice is named by the time it starts at; one that is still too busy gives
    # way to finer ones within the same time.
    staged = staged.withColumn(
        _SLICE, F.when(F.col(_HOT), _start_of(policy.slice_seconds)).otherwise(F.lit(0))
    )
    full = hot_keys(staged.filter(F.col(_HOT)), _KEY, _SLICE, policy=policy)
    staged = staged.withColumn(_FINE, F.lit(False)) if full is None else mark_hot(staged, full, _FINE)
    return staged.withColumn(
        _SLICE,
        F.when(F.col(_KEY).isNull(), apart)
        .when(F.col(_FINE), _start_of(policy.fine_seconds))
        .otherwise(F.col(_SLICE)),
    )


def _start_of(seconds: int) -> Column:
    return F.floor(F.col(_AT) / (seconds * 1_000_000)) * F.lit(seconds * 1_000_000)


def _left(position: int) -> Column:
    """Marks a row that leaves the trailing window at ``position``."""
    return F.when(F.col(_KIND) == position + 1, 1)


def _scan_slices(events: DataFrame, spec: HistorySpec, tie, sliced: bool) -> DataFrame:
    slice_ = Window.partitionBy(_KEY, _SLICE)
    start = Window.unboundedPreceding
    before = slice_.orderBy(_AT, *tie).rowsBetween(start, -1)
    by_row = {"_s_rows": F.count(F.when(F.col(_KIND) == 0, 1)).over(before)}
    for name in spec.sums:
        by_row[f"_s_{name}"] = F.sum(f"_in_{name}").over(before)
    for name in spec.moments:
        value = F.col(f"_in_{name}")
        by_row[f"_s_{name}_n"] = F.count(value).over(before)
        by_row[f"_s_{name}_mean"] = F.avg(value).over(before)
        by_row[f"_s_{name}_var"] = F.var_pop(value).over(before)
    if spec.previous:
        by_row["_s_prev"] = F.last("_in_prev", ignorenulls=True).over(before)
    scanned = events.select("*", *[c.alias(n) for n, c in by_row.items()])

    # Rows of the same instant do not count each other, hence frames over time.
    # This order is a prefix of the one above, so Spark does not sort again.
    by_time = slice_.orderBy(_AT)
    earlier = by_time.rangeBetween(start, -1)
    frames = {}
    if spec.trailing:
        frames["_t_entered"] = F.count(_COUNTED).over(earlier)
    for position, (name, seconds) in enumerate(spec.trailing.items()):
        too_old = by_time.rangeBetween(start, -seconds * 1_000_000 - 1)
        frames[f"_t_old_{name}"] = F.count(_COUNTED).over(too_old)
        if sliced:
            frames[f"_t_left_{name}"] = F.count(_left(position)).over(earlier)
    if frames:
        scanned = scanned.select("*", *[c.alias(n) for n, c in frames.items()])
    if spec.totals:
        scanned = scanned.select(
            "*", *[F.sum(f"_in_{n}").over(slice_).alias(f"_s_{n}") for n in spec.totals]
        )
    return scanned


def _carry(events: DataFrame, spec: HistorySpec, tie) -> DataFrame:
    """One row per slice of a busy card: the totals of all its earlier slices."""
    parts = {"rows": F.count(F.when(F.col(_KIND) == 0, 1))}
    parts |= {n: F.sum(f"_in_{n}") for n in spec.sums}
    if spec.trailing:
        parts["entered"] = F.count(_COUNTED)
        for position, name in enumerate(spec.trailing):
            parts[f"left_{name}"] = F.count(_left(position))
    per_slice = {f"_p_{n}": c for n, c in parts.items()}
    per_slice |= {f"_p_all_{n}": F.sum(f"_in_{n}") for n in spec.totals}
    for name in spec.moments:
        value = F.col(f"_in_{name}")
        per_slice[f"_p_{name}_n"] = F.count(value)
        per_slice[f"_p_{name}_mean"] = F.avg(value)
        per_slice[f"_p_{name}_m2"] = F.var_pop(value) * F.count(value)
    if spec.previous:
        newest = F.struct(F.col(_AT).alias("at"), *tie, F.col("_in_prev").alias("row"))
        per_slice["_p_prev"] = F.max(F.when(F.col(_KIND) == 0, newest))
    slices = events.groupBy(_KEY, _SLICE).agg(*[c.alias(n) for n, c in per_slice.items()])

    card = Window.partitionBy(_KEY)
    before = card.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    slices = _around_first_mean(slices, spec, card.orderBy(_SLICE))
    carried = [F.coalesce(F.sum(f"_p_{n}").over(before), F.lit(0)).alias(f"_c_{n}") for n in parts]
    carried += [F.sum(f"_p_all_{n}").over(card).alias(f"_c_{n}") for n in spec.totals]
    for name in spec.moments:
        carried.append(F.col(f"_p_{name}_base").alias(f"_c_{name}_base"))
        carried += [
            F.coalesce(F.sum(f"_p_{name}_{part}").over(before), F.lit(0)).alias(f"_c_{name}_{part}")
            for part in ("n", "off", "square")
        ]
    if spec.previous:
        carried.append(F.last("_p_prev", ignorenulls=True).over(before)["row"].alias("_c_prev"))
    return slices.select(_KEY, _SLICE, *carried)


def _around_first_mean(slices: DataFrame, spec: HistorySpec, ordered) -> DataFrame:
    """What to add up per slice so that means and squares of large, close values survive.

    Values are taken as differences to the mean of the card's first slice with a value;
    a slice's squares around that base are its own and n times the square of its mean's.
    """
    first = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    for name in spec.moments:
        n, mean, m2 = (F.col(f"_p_{name}_{part}") for part in ("n", "mean", "m2"))
        base = F.first(f"_p_{name}_mean", ignorenulls=True).over(first)
        slices = slices.withColumn(f"_p_{name}_base", base)
        off = F.coalesce(mean - F.col(f"_p_{name}_base"), F.lit(0.0))
        slices = slices.withColumns({
            f"_p_{name}_off": n * off,
            f"_p_{name}_square": F.coalesce(m2, F.lit(0.0)) + n * off * off,
        })
    return slices


def _combine(spec: HistorySpec, sliced: bool) -> list[Column]:
    """Join what a slice saw to what was carried into it."""
    known = F.col(_KEY).isNotNull() & F.col(_AT).isNotNull()

    def carried(name: str) -> Column:
        return F.coalesce(F.col(f"_c_{name}"), F.lit(0)) if sliced else F.lit(0)

    def running(name: str) -> Column:
        whole = F.coalesce(F.col(f"_s_{name}"), F.lit(0)) + carried(name)
        return F.when(known, whole).otherwise(F.lit(0)).alias(f"h_{name}")

    out = [running(n) for n in ("rows", *spec.sums)]
    for name in spec.totals:
        own = F.col(f"_s_{name}")
        whole = F.when(F.col(_HOT), F.col(f"_c_{name}")).otherwise(own) if sliced else own
        out.append(F.when(known, whole).alias(f"h_{name}"))
    for name in spec.moments:
        out += _combine_moments(name, known, carried, sliced)
    if spec.previous:
        prev = F.col("_s_prev")
        if sliced:
            prev = F.coalesce(prev, F.col("_c_prev"))
        out.append(F.when(known, prev).alias("h_prev"))
    for name in spec.trailing:
        gone = F.col(f"_t_old_{name}")
        if sliced:
            left = carried(f"left_{name}") + F.col(f"_t_left_{name}")
            gone = F.when(F.col(_HOT), left).otherwise(gone)
        inside = F.col("_t_entered") + carried("entered") - gone
        out.append(F.when(known, inside).otherwise(F.lit(0)).alias(f"h_{name}"))
    return out


def _combine_moments(name: str, known: Column, carried, sliced: bool) -> list[Column]:
    n2 = F.col(f"_s_{name}_n")
    mean2 = F.coalesce(F.col(f"_s_{name}_mean"), F.lit(0.0))
    m2 = F.coalesce(F.col(f"_s_{name}_var"), F.lit(0.0)) * n2
    n, mean = n2, F.col(f"_s_{name}_mean")
    if sliced:
        n1 = carried(f"{name}_n")
        off1 = F.coalesce(F.try_divide(carried(f"{name}_off"), n1), F.lit(0.0))
        mean1 = F.col(f"_c_{name}_base") + off1
        spread1 = F.greatest(carried(f"{name}_square") - n1 * off1 * off1, F.lit(0.0))
        n = n1 + n2
        apart = F.when(n2 > 0, mean2 - mean1).otherwise(F.lit(0.0))
        between = F.coalesce(F.try_divide(apart * apart * n1 * n2, n), F.lit(0.0))
        m2 = F.when(n1 > 0, spread1 + m2 + between).otherwise(m2)
        mean = F.when(n1 > 0, mean1 + F.coalesce(F.try_divide(apart * n2, n), F.lit(0.0))).otherwise(mean)
    return [
        F.when(known, n).otherwise(F.lit(0)).alias(f"h_{name}_n"),
        F.when(known, mean).alias(f"h_{name}_mean"),
        F.when(known & (n > 0), m2).alias(f"h_{name}_m2"),
    ]


def sample_deviation(name: str) -> Column:
    """Standard deviation of the earlier values; null below two values."""
    n = F.col(f"h_{name}_n")
    return F.when(n > 1, F.sqrt(F.col(f"h_{name}_m2") / (n - 1)))
