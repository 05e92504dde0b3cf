"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhawk.session import cut_lineage, new_folder, ship_package

__all__ = [
    "WORD", "cut_lineage", "new_folder", "null_safe", "read", "ship_package", "spread",
    "uniform", "word_count",
]

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def word_count(text: Column) -> Column:
    """Number of words; a missing text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) that depends on the values alone, so reruns agree."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / F.lit(float(2**53))


def null_safe(left: DataFrame, right: DataFrame, keys: Iterable[str]) -> Column:
    """Join condition under which missing keys meet each other."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition


def spread(df: DataFrame, rows: int | None = None) -> int:
    """How many partitions a shuffle of ``df`` goes to, at least."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows or 1)
