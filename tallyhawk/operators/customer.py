"""Features from the whole history of a card."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyhawk.functions.numbers import from_units, known, money_units
from tallyhawk.operators.skew import lookup_join
from tallyhawk.schema import AMOUNT, CARD, TXN
from tallyhawk.settings import DEFAULT_SKEW, SkewPolicy


def card_stats(df: DataFrame, key: str = CARD, amount: str = AMOUNT) -> DataFrame:
    """Number and mean of amounts per card; rows without a card are left out."""
    value = known(F.col(amount))
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(value).alias("customer_txn_count"),
             F.sum(money_units(value)).alias("_units"))
        .select(
            key, "customer_txn_count",
            F.try_divide(from_units(F.col("_units")), F.col("customer_txn_count"))
            .alias("customer_avg_amt"),
        )
    )


def add_customer_behaviour(
    df: DataFrame,
    *,
    key: str = CARD,
    amount: str = AMOUNT,
    row_id: str = TXN,
    policy: SkewPolicy | None = DEFAULT_SKEW,
) -> DataFrame:
    """Join each card's count and mean back to its rows.

    The mean covers later rows too; it describes the card, not its past.
    """
    joined = lookup_join(df, card_stats(df, key, amount), key, F.col(row_id), policy)
    return joined.withColumn("amt_vs_customer_avg", known(F.col(amount)) - F.col("customer_avg_amt"))
