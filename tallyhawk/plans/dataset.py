"""The feature build: from a clean table to a model-ready dataset."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from tallyhawk import schema as S
from tallyhawk.functions.clock import add_temporal_features
from tallyhawk.functions.geo import add_home_distance
from tallyhawk.operators.behaviour import add_behaviour
from tallyhawk.operators.cleaning import clean, drop_consumed, prune, target_last
from tallyhawk.operators.customer import add_customer_behaviour
from tallyhawk.operators.encode import encode_gender, fit_levels, one_hot
from tallyhawk.operators.impute import fill_merchant_zip
from tallyhawk.settings import DEFAULT_SKEW, PROFILE_B, SkewPolicy
from tallyhawk.sources.tables import write_card_buckets


def prepare_transactions(raw: DataFrame) -> DataFrame:
    """Clean the raw table and fill missing merchant zip codes."""
    return fill_merchant_zip(clean(raw))


def engineer_features(
    df: DataFrame,
    levels: Mapping[str, Sequence[str]] | None = None,
    *,
    keep: Sequence[str] = (),
    policy: SkewPolicy | None = DEFAULT_SKEW,
) -> DataFrame:
    """Calendar, distance and whole-history features, encoded, target last.

    ``levels`` are the levels of the one-hot columns; without them they are
    learnt from the table.
    """
    levels = fit_levels(df) if levels is None else levels
    return (
        df.transform(prune, keep=(S.TXN,))
        .transform(add_temporal_features)
        .transform(add_home_distance)
        .transform(add_customer_behaviour, policy=policy)
        .transform(drop_consumed)
        .transform(encode_gender)
        .transform(one_hot, levels)
        .drop(*[c for c in (S.TXN,) if c not in keep])
        .transform(target_last)
    )


def model_dataset(df: DataFrame, *, keep: Sequence[str] = (),
                  policy: SkewPolicy | None = DEFAULT_SKEW) -> DataFrame:
    """All features of the model schema for each transaction, in one lineage.

    Past and whole-history features of a card come from the same scan, so the
    build shuffles the table once. Columns of ``keep`` stand behind the number.
    """
    return (
        df.transform(add_temporal_features)
        .transform(add_home_distance)
        .transform(add_behaviour, PROFILE_B, with_card_totals=True, policy=policy)
        .transform(encode_gender)
        .transform(one_hot, S.MODEL_LEVELS)
        .selectExpr(S.TXN, *[f"`{c}`" for c in [*keep, *S.MODEL_FEATURES]], S.TARGET)
    )


def dataset_from_raw(raw: DataFrame, table: str, path: str, *, buckets: int | None = None,
                     keep: Sequence[str] = (),
                     policy: SkewPolicy | None = DEFAULT_SKEW) -> DataFrame:
    """The whole chain: copies out, cleaned, zips filled, stored by card, features built.

    The stage is stored in buckets of cards as ``table`` at ``path``, which the caller
    owns and drops. Without busy cards nothing behind it is shuffled: history, totals and
    flags of a card find its rows together.
    """
    buckets = buckets or int(raw.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stage = write_card_buckets(prepare_transactions(raw), table, path, buckets)
    return model_dataset(stage, keep=keep, policy=policy)
