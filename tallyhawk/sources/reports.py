"""Reports as tables of text lines, ready to be written as Markdown."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyhawk.functions.text import money, percent, plain_number, thousands
from tallyhawk.operators import profiling
from tallyhawk.operators.quality import validation_values

# Headings and wording of the reports.
BEHAVIOUR_SECTIONS = (
    ("## Fraud rate by category", "category", True),
    ("## Fraud rate by gender", "gender", False),
    ("## Fraud rate by payment method", "Payment_Method", True),
    ("## Fraud rate by transaction type", "Transaction_Type", True),
)
# Chosen here: a column that meets its source in fewer rows than this is not relied on.
RELIABLE_FROM = 0.5
DOUBT = "is met too seldom to rely on the column."

_LINE = "section int, place int, line string"


def validation_report(df: DataFrame) -> DataFrame:
    """Lines of the validation report: ``section, place, line``."""
    spark = df.sparkSession
    whole = F.format_string("- %s: %d", F.col("check"), F.col("value").cast("bigint"))
    rate = F.concat(F.lit("- "), F.col("check"), F.lit(": "), plain_number(F.col("value"), 4))
    is_rate = F.col("check").endswith("(rate)")
    value = F.when(is_rate, rate).otherwise(whole)
    # What the measured rates say: one more line for each that is too low.
    note = F.concat(F.lit("**Note:** "), F.col("check"), F.lit(f" {DOUBT}"))
    lines = F.array_compact(F.array(
        F.struct(F.lit(2).alias("section"), F.col("position").alias("place"), value.alias("line")),
        F.when(is_rate & (F.col("value") < RELIABLE_FROM),
               F.struct(F.lit(3).alias("section"), F.col("position").alias("place"), note.alias("line"))),
    ))
    body = validation_values(df).select(F.explode(lines).alias("_l")).select("_l.*")
    rows = df.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(1).alias("section"), F.lit(1).alias("place"),
        F.concat(F.lit("Rows validated: "), thousands(F.col("n"))).alias("line"),
    )
    fixed = spark.createDataFrame([(0, 1, "# Data Validation Report")], _LINE)
    return fixed.unionByName(rows).unionByName(body)


def behaviour_report(df: DataFrame) -> DataFrame:
    """Lines of the fraud-rate report.

    All rates come from one scan; the line numbers are windows over one row per
    level, partitioned by dimension.
    """
    from pyspark.sql import Window

    spark = df.sparkSession
    rates = profiling.fraud_rate_profile(df)
    rate = percent(F.col("fraud_rate"))
    fixed = [(0, 1, "# Customer Behavioral Analysis")]
    parts = []
    for number, (heading, dimension, falling) in enumerate(BEHAVIOUR_SECTIONS, 2):
        fixed.append((number, 0, heading))
        order = [F.desc("fraud_rate"), F.col("level")] if falling else [F.col("level")]
        place = F.row_number().over(Window.partitionBy("dimension").orderBy(*order))
        parts.append(
            rates.filter(F.col("dimension") == dimension).select(
                F.lit(number).alias("section"), place.alias("place"),
                F.concat(F.lit("- "), F.col("level"), F.lit(": "), rate).alias("line"),
            )
        )
    number += 1
    fixed += [(number, 0, "## Fraud rate by hour of day"), (number + 1, 0, "## Amount comparison")]
    hour = F.col("level").cast("int")
    place = F.row_number().over(Window.partitionBy("dimension").orderBy(F.desc("fraud_rate"), hour))
    parts.append(
        rates.filter(F.col("dimension") == "hour").withColumn("place", place)
        .filter(F.col("place") <= 5)
        .select(F.lit(number).alias("section"), "place",
                F.concat(F.lit("- "), F.col("level"), F.lit(":00 -> "), rate).alias("line"))
    )
    overall = profiling.overall_fraud(df).select(
        F.lit(1).alias("section"), F.lit(1).alias("place"),
        F.concat(F.lit("Overall fraud rate: "), percent(F.col("fraud_rate")), F.lit(" ("),
                 thousands(F.col("frauds")), F.lit(" of "), thousands(F.col("transactions")),
                 F.lit(" transactions)")).alias("line"),
    )
    amounts = profiling.amounts_by_class(df).select(F.explode(F.array(
        F.struct(F.lit(1).alias("place"), F.concat(
            F.lit("- Average amount on fraud transactions: "),
            money(F.col("avg_fraud_amt"))).alias("line")),
        F.struct(F.lit(2).alias("place"), F.concat(
            F.lit("- Average amount on normal transactions: "),
            money(F.col("avg_normal_amt"))).alias("line")),
    )).alias("_l")).select(F.lit(number + 1).alias("section"), "_l.place", "_l.line")
    out = spark.createDataFrame(fixed, _LINE).unionByName(overall).unionByName(amounts)
    for part in parts:
        out = out.unionByName(part)
    return out


def write_lines(lines: DataFrame, path: str) -> None:
    """Write report lines in order as one text file; a report is a few dozen lines."""
    lines.orderBy("section", "place").coalesce(1).select("line").write.mode("overwrite").text(path)


def write_results(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
