"""Reading a commit log as a table.

The log has a header line per commit, ``COMMIT|||id|||author|||date|||subject``,
followed by one line ``added<TAB>deleted<TAB>path`` per file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Fixed value: what a header line starts with, and what separates its parts.
MARK = "COMMIT|||"
PARTS = r"\|\|\|"
_FILE_LINE = r"^\s*(\d+)\s+(\d+)(\s|$)"


def read_commit_log(spark: SparkSession, path: str) -> DataFrame:
    """One row per commit: ``actor, day, event, added, deleted, subject``.

    Records are split at line starts by the reader, so a large log is read in
    parallel. Headers with fewer than five parts and binary files are ignored.
    """
    records = spark.read.option("lineSep", "\n" + MARK).text(path)
    # The first record still has its mark.
    body = F.regexp_replace("value", r"^\s*COMMIT\|\|\|", "")
    split = records.select(F.split(body, "\n").alias("lines")).select(
        F.split(F.col("lines")[0], PARTS).alias("head"), "lines"
    ).filter(F.size("head") >= 4)
    numbers = F.filter(F.slice("lines", F.lit(2), F.size("lines")), lambda l: l.rlike(_FILE_LINE))

    def total(group: int):
        return F.aggregate(
            numbers, F.lit(0).cast("bigint"),
            lambda acc, l: acc + F.regexp_extract(l, _FILE_LINE, group).cast("bigint"),
        )

    return split.select(
        F.trim(F.col("head")[1]).alias("actor"),
        F.trim(F.col("head")[2]).try_cast("date").alias("day"),
        F.trim(F.col("head")[0]).alias("event"),
        total(1).alias("added"),
        total(2).alias("deleted"),
        F.trim(F.col("head")[3]).alias("subject"),
    )
