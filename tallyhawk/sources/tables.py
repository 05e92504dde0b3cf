"""Reading and writing transaction tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tallyhawk.schema import CARD, RAW_SCHEMA, TIME

# Codes that look like numbers but must keep their leading zeros.
TEXT_CODES = ("zip", "merch_zipcode", "cc_num")


# Quotes are doubled, text keeps its blanks and times their microseconds.
CSV_FORMAT = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "timestampFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
}


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """The raw table, with a header and the known schema; nothing is inferred."""
    return read_csv(spark, path, RAW_SCHEMA)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).options(**CSV_FORMAT).csv(path)


def with_text_codes(schema: T.StructType, codes=TEXT_CODES) -> T.StructType:
    """The same schema with id-like columns as text."""
    return T.StructType([
        T.StructField(f.name, T.StringType() if f.name in codes else f.dataType, f.nullable)
        for f in schema.fields
    ])


def read_clean_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table written by an earlier step."""
    return read_csv(spark, path, with_text_codes(schema))


def load_dataset(spark: SparkSession, path: str, *, format: str = "parquet",
                 schema: T.StructType | None = None) -> DataFrame:
    """Load a table, with a clear error when it is missing or has no rows."""
    reader = spark.read.format(format)
    if schema is not None:
        reader = reader.schema(schema)
    if format == "csv":
        reader = reader.options(**CSV_FORMAT)
    try:
        df = reader.load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no dataset at {path}; run the step that writes it") from error
        raise
    if df.isEmpty():
        raise ValueError(f"the dataset at {path} has no rows")
    return df


def write_stage(df: DataFrame, path: str) -> None:
    """Store a table between two steps: typed, columnar, splittable."""
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_FORMAT).csv(path)


#: Holds the text of a line that cannot be read.
REJECTED_LINE = "_rejected_line"


def read_csv_lines(spark: SparkSession, path: str, schema: T.StructType, *,
                   header: bool = True) -> DataFrame:
    """Every line of a CSV table; ``_rejected_line`` is its text where it is malformed.

    A line is malformed if it has too few or too many fields or a value of a wrong type;
    empty fields are null and blank lines are no lines. ``good_rows`` and
    ``rejected_rows`` take it apart.
    """
    whole = T.StructType([*schema.fields, T.StructField(REJECTED_LINE, T.StringType())])
    return spark.read.schema(whole).options(
        **CSV_FORMAT | {"header": header}, mode="PERMISSIVE", columnNameOfCorruptRecord=REJECTED_LINE,
    ).csv(path)


def _all_parsed(lines: DataFrame) -> Column:
    """True for every row. Needs all columns, as Spark checks only those that are needed."""
    columns = [F.col(f"`{c}`") for c in lines.columns if c != REJECTED_LINE]
    return F.pmod(F.xxhash64(*columns), F.lit(2)) >= 0


def good_rows(lines: DataFrame) -> DataFrame:
    good = F.col(REJECTED_LINE).isNull() & _all_parsed(lines)
    return lines.where(good).drop(REJECTED_LINE)


def rejected_rows(lines: DataFrame) -> DataFrame:
    """``line, reason, columns`` of the malformed lines, repeated lines included.

    ``reason`` is ``fields`` for a wrong number of fields, otherwise ``values``; then
    ``columns`` names those whose text is there but is no value of the type.
    """
    fields = [f for f in lines.schema.fields if f.name != REJECTED_LINE]
    names = [*[f.name for f in fields], REJECTED_LINE]
    text = ", ".join("`{}` string".format(n.replace("`", "``")) for n in names)
    options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECTED_LINE}
    rejected = F.col(REJECTED_LINE).isNotNull() & _all_parsed(lines)
    parsed = lines.where(rejected).withColumn(
        "_text", F.from_csv(REJECTED_LINE, text, options))
    whole = F.col(f"_text.{REJECTED_LINE}").isNull()
    unread = F.array_compact(F.array(*[
        F.when(F.col(f"`{f.name}`").isNull() & (F.col(f"_text.`{f.name}`") != ""), F.lit(f.name))
        for f in fields
    ]))
    return parsed.select(
        F.col(REJECTED_LINE).alias("line"),
        F.when(whole, "values").otherwise("fields").alias("reason"),
        F.when(whole, unread).otherwise(F.array().cast("array<string>")).alias("columns"),
    )


def load_status(spark: SparkSession, path: str, *, format: str = "parquet",
                schema: T.StructType | None = None) -> DataFrame:
    """One row: ``status`` (loaded, empty or missing) and ``rows`` of the table at a path."""
    try:
        rows = load_dataset(spark, path, format=format, schema=schema).agg(
            F.count(F.lit(1)).alias("rows"))
    except FileNotFoundError:
        return spark.range(1).select(F.lit("missing").alias("status"), F.lit(0).cast("bigint").alias("rows"))
    except ValueError:
        return spark.range(1).select(F.lit("empty").alias("status"), F.lit(0).cast("bigint").alias("rows"))
    return rows.select(F.lit("loaded").alias("status"), "rows")


# The number of parts is in the column's name, so that a reader cannot get it wrong.
_PART = "card_part_of_"


def _part(card: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(card.cast("string")), F.lit(parts)).cast("int")


def write_by_card(df: DataFrame, path: str, parts: int = 64) -> None:
    """Store a table so that one card is found without reading the others.

    Cards are dealt into ``parts`` folders by hash and sorted inside a file, so that a
    reader opens one folder and skips row groups by their least and largest card. A part
    larger than the others, as that of a card with a third of all rows, goes to several
    files (a rebalance, which splits what is too large). A null card has a part too.
    """
    name = f"{_PART}{parts}"
    dealt = df.withColumn(name, _part(F.col(CARD), parts)).hint("rebalance", F.col(name))
    order = [name, CARD] + ([TIME] if TIME in df.columns else [])
    dealt.sortWithinPartitions(*order).write.mode("overwrite").partitionBy(name).parquet(path)


def read_card(spark: SparkSession, path: str, card: str) -> DataFrame:
    """All rows of one card from a table stored by ``write_by_card``."""
    df = spark.read.parquet(path)
    names = [c for c in df.columns if c.startswith(_PART)]
    if len(names) != 1:
        raise ValueError(f"the table at {path} is not stored by card")
    part = _part(F.lit(card), int(names[0].removeprefix(_PART)))
    return df.where((F.col(names[0]) == part) & (F.col(CARD) == card)).drop(names[0])


def write_card_buckets(df: DataFrame, table: str, path: str, buckets: int) -> DataFrame:
    """Store a table in buckets of cards and read it: what groups by card does not shuffle.

    Rows go to tasks by card, and a task that gets too many, as those of a card with a
    third of all rows, is split (a rebalance), so a bucket may be several files. Where
    cards are busy, history features cut them into slices of time and shuffle those, as
    one task a bucket would not do.
    """
    (
        df.hint("rebalance", F.col(CARD)).write.mode("overwrite").bucketBy(buckets, CARD)
        .option("path", path).saveAsTable(table)
    )
    return df.sparkSession.table(table)
