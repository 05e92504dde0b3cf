"""Fraud rates, distributions and table summaries.

Every summary is one aggregate over the table; the long tables people read are
made from its single result row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhawk.functions.clock import hour_minute, year_gap
from tallyhawk.functions.numbers import known, missing
from tallyhawk.operators.cleaning import ROW_HASH, numeric_columns, row_hash
from tallyhawk.operators.quantiles import grouped_quantiles
from tallyhawk.schema import AMOUNT, TARGET, TIME


def overall_fraud(df: DataFrame) -> DataFrame:
    return df.agg(
        F.avg(TARGET).alias("fraud_rate"),
        F.sum(F.col(TARGET).cast("bigint")).alias("frauds"),
        F.count(F.lit(1)).alias("transactions"),
    )


def fraud_rate_by(df: DataFrame, group: Column, name: str) -> DataFrame:
    """Fraud rate per group; rows without a group are left out."""
    return (
        df.select(group.alias(name), TARGET)
        .filter(F.col(name).isNotNull())
        .groupBy(name)
        .agg(F.avg(TARGET).alias("fraud_rate"))
    )


def riskiest(rates: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Groups by falling fraud rate, the first ``rows`` of them if given."""
    ordered = rates.orderBy(F.desc("fraud_rate"), name)
    return ordered if rows is None else ordered.limit(rows)


def fraud_rate_by_hour(df: DataFrame) -> DataFrame:
    return fraud_rate_by(df, F.hour(TIME), "hour")


def fraud_rate_profile(
    df: DataFrame,
    dimensions: Sequence[str] = ("category", "gender", "Payment_Method", "Transaction_Type"),
) -> DataFrame:
    """Fraud rates by several dimensions and by hour, in one scan with grouping sets."""
    keys = [*dimensions, "hour"]
    data = df.select(*[F.col(d).cast("string") for d in dimensions],
                     F.hour(TIME).cast("string").alias("hour"), TARGET)
    rates = data.groupingSets([[k] for k in keys], *keys).agg(
        F.avg(TARGET).alias("fraud_rate"),
        F.count(F.lit(1)).alias("transactions"),
        *[F.grouping(k).alias(f"_g{i}") for i, k in enumerate(keys)],
    )
    dimension, level = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, k in enumerate(keys):
        dimension = F.when(F.col(f"_g{i}") == 0, F.lit(k)).otherwise(dimension)
        level = F.when(F.col(f"_g{i}") == 0, F.col(k)).otherwise(level)
    return rates.select(
        dimension.alias("dimension"), level.alias("level"), "fraud_rate", "transactions"
    ).filter(F.col("level").isNotNull())


def amounts_by_class(df: DataFrame) -> DataFrame:
    amount = F.col(AMOUNT)
    return df.agg(
        F.avg(F.when(F.col(TARGET) == 1, amount)).alias("avg_fraud_amt"),
        F.avg(F.when(F.col(TARGET) == 0, amount)).alias("avg_normal_amt"),
    )


def class_distribution(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Rows and share per class; rows without a class are a class of their own."""
    # The window runs over one row per class.
    total = F.sum("transactions").over(Window.partitionBy(F.lit(1)))
    label = (
        F.when(F.col(target) == 1, "Fraud")
        .when(F.col(target) == 0, "Legitimate")
        .otherwise(F.coalesce(F.col(target).cast("string"), F.lit("nan")))
    )
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("transactions"))
    return counts.select(
        target, label.alias("label"), "transactions",
        (F.col("transactions") / total * 100).alias("percentage"),
    )


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins between the least and the largest value, empty bins included.

    The last bin includes its upper edge.
    """
    value = F.col(column)
    low, high = df.agg(F.min(value), F.max(value)).first()
    spark = df.sparkSession
    numbers = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    if low is None:
        return numbers.select("bin", *[F.lit(None).cast("double").alias(c) for c in ("low", "high")],
                              F.lit(0).cast("bigint").alias("transactions")).limit(0)
    low, high = float(low), float(high)
    if low == high:
        # One value only: a bin range of width one around it.
        low, high = low - 0.5, high + 0.5
    place = F.floor((value - low) / (high - low) * bins)
    counts = (
        df.filter(value.isNotNull())
        .groupBy(F.least(place, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("transactions"))
    )
    width = (high - low) / bins
    return numbers.join(counts, "bin", "left").select(
        "bin",
        (F.lit(low) + F.col("bin") * width).alias("low"),
        (F.lit(low) + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("transactions", F.lit(0)).alias("transactions"),
    )


def amount_histogram(df: DataFrame, below: float = 500.0, bins: int = 50) -> DataFrame:
    return histogram(df.filter(F.col(AMOUNT) < below), AMOUNT, bins)


def _per_column(df: DataFrame, columns: Sequence[str], stats: dict) -> DataFrame:
    """One aggregate over all columns, shown as one row per column.

    ``stats`` maps a result name to a function from a column to its aggregate.
    """
    row = df.agg(
        F.array(*[
            F.struct(F.lit(c).alias("column"),
                     *[make(F.col(f"`{c}`")).alias(name) for name, make in stats.items()])
            for c in columns
        ]).alias("_rows")
    )
    return row.select(F.explode("_rows").alias("_row")).select("_row.*")


def null_counts(df: DataFrame) -> DataFrame:
    """Columns that have nulls and how many."""
    row = df.agg(F.array(*[
        F.struct(F.lit(c).alias("column"), F.count_if(missing(c, kind)).alias("nulls"))
        for c, kind in df.dtypes
    ]).alias("_rows"))
    return row.select(F.explode("_rows").alias("_row")).select("_row.*").filter("nulls > 0")


def total_nulls(df: DataFrame) -> DataFrame:
    in_row = sum((missing(c, kind).cast("bigint") for c, kind in df.dtypes), F.lit(0))
    return df.agg(F.coalesce(F.sum(in_row), F.lit(0)).alias("nulls"))


def describe(
    df: DataFrame, columns: Sequence[str] | None = None, digits: int = 3
) -> DataFrame:
    """Least, largest, mean and standard deviation per numeric column, rounded."""
    columns = numeric_columns(df).columns if columns is None else columns
    return _per_column(df, columns, {
        "min": lambda c: F.round(F.min(known(c)).cast("double"), digits),
        "max": lambda c: F.round(F.max(known(c)).cast("double"), digits),
        "mean": lambda c: F.round(F.avg(known(c)), digits),
        "std": lambda c: F.round(F.stddev_samp(known(c)), digits),
    })


def describe_full(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles per column."""
    stats = _per_column(df, columns, {
        "count": lambda c: F.count(known(c)),
        "mean": lambda c: F.avg(known(c)),
        "std": lambda c: F.stddev_samp(known(c)),
        "min": lambda c: F.min(known(c)).cast("double"),
        "max": lambda c: F.max(known(c)).cast("double"),
    })
    values = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "value"
    )
    # Every result here has one row per column, so the joins are tiny.
    quartiles = (
        grouped_quantiles(values, ["column"], "value", [0.25, 0.5, 0.75])
        .groupBy("column")
        .agg(*[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n)
               for p, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))])
    )
    return stats.join(quartiles, "column", "left")


def flag_counts(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    return _per_column(df, flags, {"flagged": lambda c: F.coalesce(F.sum(c.cast("bigint")), F.lit(0))})


def match_rate(a: Column, b: Column) -> Column:
    """Share of rows where two expressions agree; unknown never agrees."""
    return F.avg(F.coalesce(a == b, F.lit(False)).cast("int"))


def match_rates(df: DataFrame) -> DataFrame:
    """How often the given time and age agree with the transaction itself."""
    time = match_rate(hour_minute(F.col(TIME)), F.col("Transaction_Time"))
    age = match_rate(year_gap(F.col(TIME), F.col("dob")), F.col("Customer_Age"))
    return df.agg(F.round(time, 4).alias("time_match_rate"), F.round(age, 4).alias("age_match_rate"))


def type_counts(df: DataFrame) -> DataFrame:
    """Number of columns per data type and of the values they hold."""
    kinds: dict[str, list[str]] = {}
    for column, kind in df.dtypes:
        kinds.setdefault(kind, []).append(column)
    row = df.agg(F.array(*[
        F.struct(
            F.lit(kind).alias("type"), F.lit(len(columns)).alias("columns"),
            sum((F.count(F.col(f"`{c}`")) for c in columns), F.lit(0)).alias("values"),
        )
        for kind, columns in sorted(kinds.items())
    ]).alias("_rows"))
    return row.select(F.explode("_rows").alias("_row")).select("_row.*")


def overview(df: DataFrame) -> DataFrame:
    """Rows, columns, repeated rows and nulls of a table, in one row and one scan.

    Equal rows have equal hashes and equally many nulls, so both come from the same groups.
    """
    nulls = sum((missing(c, kind).cast("bigint") for c, kind in df.dtypes), F.lit(0))
    groups = df.select(*row_hash(df.columns), nulls.cast("bigint").alias("_nulls")).groupBy(
        *ROW_HASH).agg(F.count(F.lit(1)).alias("_n"), F.sum("_nulls").alias("_nulls"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"),
        F.coalesce(F.sum("_nulls"), F.lit(0)).alias("nulls"),
    )
