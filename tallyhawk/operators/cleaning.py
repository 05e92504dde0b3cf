"""Cleaning, duplicates and column pruning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhawk.functions.numbers import violates
from tallyhawk.functions.text import strip_space, whole_number_code, zero_pad
from tallyhawk.schema import (
    CARD,
    CONSUMED_COLUMNS,
    IDENTIFIER_COLUMNS,
    INDEX_COLUMN,
    TARGET,
    TEXT_COLUMNS,
    TIME,
    TXN,
    UNRELIABLE_COLUMNS,
)


def drop_index(df: DataFrame) -> DataFrame:
    return df.drop(INDEX_COLUMN)


def parse_times(df: DataFrame) -> DataFrame:
    """Transaction time and birth date as types; text that is neither becomes null."""
    return df.withColumns(
        {TIME: F.col(TIME).try_cast("timestamp_ntz"), "dob": F.col("dob").try_cast("date")}
    )


def card_to_text(df: DataFrame) -> DataFrame:
    return df.withColumn(CARD, F.col(CARD).cast("string"))


def pad_zip(df: DataFrame) -> DataFrame:
    return df.withColumn("zip", zero_pad(F.col("zip"), 5))


def pad_merchant_zip(df: DataFrame) -> DataFrame:
    return df.withColumn("merch_zipcode", whole_number_code(F.col("merch_zipcode"), 5))


def trim_text(df: DataFrame, columns: Sequence[str] = tuple(TEXT_COLUMNS)) -> DataFrame:
    return df.withColumns({c: strip_space(F.col(c)) for c in columns if c in df.columns})


def upper_state(df: DataFrame) -> DataFrame:
    return df.withColumn("state", F.upper("state"))


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def first_per_key(df: DataFrame, key: str, order: Sequence[str | Column]) -> DataFrame:
    """Keep the first row of each key in the given order.

    Spark limits the rows of a key to one before the shuffle (WindowGroupLimit),
    so a key with very many copies sends one row per input partition.
    """
    first = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")


def clean(df: DataFrame) -> DataFrame:
    """The whole cleaning chain on the raw table.

    Exact copies share their transaction number, so keeping the first row per
    number removes them too, with one shuffle instead of two.
    """
    if TXN in df.columns:
        # File order is the index column; without one any fixed order will do.
        order = [INDEX_COLUMN] if INDEX_COLUMN in df.columns else df.columns
        df = drop_index(first_per_key(df, TXN, [F.col(f"`{c}`") for c in order]))
    else:
        df = distinct_rows(drop_index(df))
    for step in (parse_times, card_to_text, pad_zip, pad_merchant_zip, trim_text, upper_state):
        df = df.transform(step)
    return df


def drop_unreliable(df: DataFrame) -> DataFrame:
    return df.drop(*UNRELIABLE_COLUMNS)


def drop_identifiers(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return df.drop(*[c for c in IDENTIFIER_COLUMNS if c not in keep])


def prune(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Drop what validation found unreliable and what no model can use."""
    return df.transform(drop_unreliable).transform(drop_identifiers, keep)


def drop_consumed(df: DataFrame) -> DataFrame:
    return df.drop(*CONSUMED_COLUMNS)


def target_last(df: DataFrame, target: str = TARGET) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != target], target)


#: Two 64-bit numbers that stand for all values of a row.
ROW_HASH = ("_one", "_two")


def row_hash(columns: Sequence[str]) -> list[Column]:
    """The 128-bit hash of the columns, as two columns named ``ROW_HASH``."""
    # A missing value and an empty one, or a value one column on, must not look alike.
    whole = [x for c in columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return [F.xxhash64(F.lit(k), *whole).alias(name) for k, name in enumerate(ROW_HASH, 1)]


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row: how many rows repeat an earlier one.

    The shuffle moves 16 bytes a distinct row, not the row.
    """
    return duplicate_keys(df.select(*row_hash(df.columns)), ROW_HASH)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many rows repeat an earlier key; null counts as a key."""
    sizes = df.groupBy(*[F.col(f"`{c}`") for c in keys]).agg(F.count(F.lit(1)).alias("_n"))
    return sizes.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


def bad_values(df: DataFrame, column: str, allowed: Column) -> DataFrame:
    """Distinct values of a column that break a rule, null included."""
    return df.filter(violates(allowed)).select(column).distinct()


def preview(df: DataFrame, columns: Sequence[str], order: str, rows: int = 5) -> DataFrame:
    return df.select(*dict.fromkeys([order, *columns])).orderBy(order).limit(rows)


def numeric_columns(df: DataFrame) -> DataFrame:
    """The numeric columns of a table, booleans excluded."""
    wanted = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
    return df.select(*[F.col(f"`{c}`") for c, t in df.dtypes if t.startswith(wanted)])
