"""Running totals over a whole table or large groups, without a window over one task.

Rows are range-partitioned by group and order, so a partition holds a stretch of the order
whatever the values are. One small row per partition and group carries the totals forward;
inside a partition a window adds the rest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhawk.session import cut_lineage

#: Rows of a partition, about.
STRETCH = 500_000


def in_stretches(df: DataFrame, order: Sequence[Column], rows: int = STRETCH) -> DataFrame:
    """``df`` stored in stretches of the order of about ``rows`` rows, numbered by ``_part``.

    The numbers ascend with the order. Equal rows share a stretch, so count them first.
    """
    df = cut_lineage(df)
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // rows))
    return cut_lineage(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()))


def totals_before(
    stretches: DataFrame, groups: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Per stretch and group, ``value_before``: the group's total in all earlier stretches."""
    sums = stretches.groupBy("_part", *groups).agg(*[F.sum(v).alias(v) for v in values])
    # One row per stretch and group.
    earlier = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("_part", *groups, *[
        F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"{v}_before") for v in values
    ])


def running_totals(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column], values: Sequence[str], rows: int = STRETCH
) -> DataFrame:
    """``df`` with ``value_upto`` for each of ``values``: the sum up to and with the row.

    Rows of a group follow ``order``; rows equal in it follow each other in any order. Null
    groups are groups too.
    """
    columns = df.columns
    stretches = in_stretches(df, [*[F.col(g) for g in groups], *order], rows)
    before = totals_before(stretches, groups, values)
    # The two sides come from one table, so the names are made to differ.
    keys = ["_part", *groups]
    before = before.toDF(*[f"_key{i}" for i in range(len(keys))], *[f"{v}_before" for v in values])
    match = F.lit(True)
    for i, key in enumerate(keys):
        match = match & F.col(f"`{key}`").eqNullSafe(F.col(f"_key{i}"))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return stretches.join(before, match).select(*columns, *[
        (F.col(f"{v}_before") + F.sum(v).over(inside)).alias(f"{v}_upto") for v in values
    ])


def level_ranks(df: DataFrame, column: str, rows: int = STRETCH) -> DataFrame:
    """``level`` and ``code`` of a column: the place of each level among the sorted ones, from 0.

    As many levels as rows are fine; nulls have no code.
    """
    levels = df.select(F.col(f"`{column}`").cast("string").alias("level")).where("level is not null").distinct()
    numbered = running_totals(levels.withColumn("_one", F.lit(1).cast("long")), [], [F.col("level")], ["_one"], rows)
    return numbered.select("level", (F.col("_one_upto") - 1).alias("code"))


def add_level_ranks(df: DataFrame, columns: Sequence[str], rows: int = STRETCH) -> DataFrame:
    """Add ``column_code`` (long) for columns of any number of levels, by joins."""
    for column in columns:
        ranks = level_ranks(df, column, rows).toDF("_level", f"{column}_code")
        df = df.join(ranks, F.col(f"`{column}`").cast("string") == F.col("_level"), "left").drop("_level")
    return df


def add_active_levels(df: DataFrame, columns: Sequence[str], name: str = "active", rows: int = STRETCH) -> DataFrame:
    """One-hot encoding without a column a level: the sorted positions that are 1.

    Positions run through the levels of the columns in order; as in ``one_hot`` the first
    level of a column has none, and a null is 0 everywhere.
    """
    coded = add_level_ranks(df, columns, rows)
    width = coded.agg(*[F.coalesce(F.max(f"{c}_code"), F.lit(0)).alias(c) for c in columns]).first()
    places, start = [], 0
    for column in columns:
        code = F.col(f"{column}_code")
        places.append(F.when(code > 0, code - 1 + F.lit(start)))
        start += width[column]
    return coded.withColumn(name, F.array_compact(F.array(*places))).drop(*[f"{c}_code" for c in columns])
