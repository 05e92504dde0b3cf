"""Exact quantiles with linear interpolation, for groups of any size.

``percentile`` keeps every distinct value of a group in the memory of one task.
Here equal values are counted first and dealt into stretches of the sorted order
by a range shuffle, so that a stretch holds a bounded number of distinct values
however close together they lie. Counts per stretch tell which one holds a wanted
rank, and only the values of that stretch are looked at one by one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tallyhawk.operators.running import STRETCH, in_stretches, totals_before


def grouped_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], rows: int = STRETCH
) -> DataFrame:
    """Rows ``keys, prob, quantile``. Null and NaN values and null keys are left out.

    A task sorts about ``rows`` distinct values at most.
    """
    number = F.col(value).cast("double")
    usable = number.isNotNull() & ~F.isnan(number)
    for key in keys:
        usable = usable & F.col(key).isNotNull()
    counted = (
        df.filter(usable)
        .groupBy(*keys, number.alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    placed = in_stretches(counted, [*[F.col(k) for k in keys], F.col("_v")], rows)
    holding = _holding_stretches(placed, keys, probs)
    # Ranks count from 0 within the stretch that holds them.
    order = Window.partitionBy(*keys, "prob", "_side").orderBy("_v")
    upto = F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, 0))
    found = (
        placed.join(holding, [*keys, "_part"])
        .withColumn("_upto", upto)
        .filter((F.col("_rank") < F.col("_upto")) & (F.col("_rank") >= F.col("_upto") - F.col("_n")))
    )
    low = F.max(F.when(F.col("_side") == 0, F.col("_v")))
    high = F.max(F.when(F.col("_side") == 1, F.col("_v")))
    return (
        found.groupBy(*keys, "prob")
        .agg(low.alias("_low"), high.alias("_high"), F.max("_share").alias("_share"))
        .select(*keys, "prob",
                (F.col("_low") + F.col("_share") * (F.col("_high") - F.col("_low"))).alias("quantile"))
    )


def _holding_stretches(placed: DataFrame, keys: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """The stretches that hold the two ranks around each wanted position."""
    inside = placed.groupBy("_part", *keys).agg(F.sum("_n").alias("_in"))
    # One row per stretch and group from here on.
    known = inside.join(totals_before(placed, keys, ["_n"]), ["_part", *keys]).withColumn(
        "_total", F.sum("_in").over(Window.partitionBy(*keys))
    )
    wanted = []
    for prob in probs:
        position = (F.col("_total") - 1) * float(prob)
        for side, rank in enumerate((F.floor(position), F.ceil(position))):
            wanted.append(F.struct(
                F.lit(float(prob)).alias("prob"), F.lit(side).alias("_side"),
                (position - F.floor(position)).alias("_share"),
                (rank - F.col("_n_before")).alias("_rank"),
            ))
    here = F.filter(F.array(*wanted),
                    lambda w: (w["_rank"] >= 0) & (w["_rank"] < F.col("_in")))
    return known.select(*keys, "_part", F.explode(here).alias("_w")).select(
        *keys, "_part", "_w.*"
    )
