"""The same rules where cards are cut into slices, and where every branch is reached.

``*_cut_cards`` run on a policy that takes the busiest cards of the given table for
overfull, so that slices, salts and fine slices are compared with the same SQL as the
ordinary path. ``*_dense_cards`` move the transactions of a card close together, on whole
minutes, and add large first amounts, merchants far from home, missing coordinates and
amounts that are no numbers.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyhawk import schema as S
from tallyhawk.functions.clock import micros
from tallyhawk.operators import behaviour as B, detectors as D
from tallyhawk.operators.customer import add_customer_behaviour
from tallyhawk.plans import history_sql as H, queries_history as history, queries_risk as risk
from tallyhawk.plans.dataset import model_dataset
from tallyhawk.plans.driver_view import raw_transactions, with_txn
from tallyhawk.plans.queries_history import clean_view
from tallyhawk.plans.registry import Query, round_sql, rounded
from tallyhawk.settings import PROFILES, SkewPolicy

#: The busiest cards of the smallest table have about so many rows.
CUT = SkewPolicy(hot_rows=20, slice_seconds=86_400, fine_seconds=3_600, broadcast_keys=10, salts=3)

_START = "timestamp_ntz'2024-01-01 00:00:00'"
_SHOWN = ("flag", "severity", "score")


def _merged_cut(spark, sf_dir):
    df = raw_transactions(spark, sf_dir).select(*history._INPUTS)
    out = B.add_behaviour(df, PROFILES["A"], policy=CUT)
    return rounded(out.drop(*[c for c in history._INPUTS if c != S.TXN]))


def _model_cut(spark, sf_dir):
    return rounded(model_dataset(clean_view(spark, sf_dir), policy=CUT))


def _customer_cut(spark, sf_dir):
    df = raw_transactions(spark, sf_dir).select(S.TXN, S.CARD, S.AMOUNT)
    return rounded(add_customer_behaviour(df, policy=CUT).drop(S.CARD, S.AMOUNT))


def _score_cut(spark, sf_dir):
    found = D.detect(risk._detector_input(spark, sf_dir), policy=CUT)
    return rounded(found.select(S.TXN, "behaviour_score", "behaviour_flags"))


# --- dense cards ------------------------------------------------------------


def dense_view(spark, sf_dir):
    """Transactions sixty times as close, on whole minutes, with gaps and extremes."""
    df = raw_transactions(spark, sf_dir).select(
        F.col("trans_num").cast("bigint").alias("_id"), S.TXN, S.CARD, S.TIME, S.AMOUNT,
        "lat", "long", "merch_lat", "merch_long",
    )
    start = micros(F.expr(_START))
    minutes = F.floor((micros(F.col(S.TIME)) - start) / 60_000_000 / 60)
    when = F.timestamp_micros(start + minutes * 60_000_000).cast("timestamp_ntz")
    no_place = F.col("_id") % 37 == 0
    return df.select(
        S.TXN, S.CARD, when.alias(S.TIME),
        F.when(F.col("_id") % 61 == 0, float("nan")).when(F.col("_id") % 40 == 1, F.col(S.AMOUNT) + 1500)
        .otherwise(F.col(S.AMOUNT)).alias(S.AMOUNT),
        "lat", "long",
        F.when(~no_place, F.when(F.col("_id") % 23 == 0, F.col("merch_lat") + 8).otherwise(F.col("merch_lat")))
        .alias("merch_lat"),
        F.when(~no_place, F.col("merch_long")).alias("merch_long"),
    )


_ID = "cast(trans_num as bigint)"
_DENSE = f"""dense as (
  select trans_num, cc_num,
    make_timestamp(cast(epoch_us(timestamp '2024-01-01') + 60000000 *
      floor((epoch_us(trans_date_trans_time) - epoch_us(timestamp '2024-01-01')) / 60000000 / 60) as bigint))
      as trans_date_trans_time,
    case when {_ID}%61=0 then null when {_ID}%40=1 then amt+1500 else amt end as amt, lat, "long",
    case when {_ID}%37<>0 then case when {_ID}%23=0 then merch_lat+8 else merch_lat end end as merch_lat,
    case when {_ID}%37<>0 then merch_long end as merch_long
  from txn)"""
_DENSE_HISTORY = H.HISTORY.replace("from txn", "from dense")


def _dense_detectors(spark, sf_dir):
    found = D.detect(dense_view(spark, sf_dir))
    return rounded(found.select(
        S.TXN, *[F.col(d)[f].alias(f"{d}_{f}") for d in D.DETECTORS for f in _SHOWN], "behaviour_score",
    ))


_DENSE_DETECTORS = round_sql(with_txn(
    "select trans_num, " + ", ".join(
        f"{d}_score>0 as {d}_flag, {risk._severity_sql(f'{d}_score')} as {d}_severity, {d}_score as {d}_score"
        for d in D.DETECTORS
    ) + f", {risk._BEST} as behaviour_score from scored",
    _DENSE, _DENSE_HISTORY, risk._FOUND), *[f"{d}_score" for d in D.DETECTORS], "behaviour_score")


def _dense_features(policy):
    def build(spark, sf_dir):
        df = dense_view(spark, sf_dir)
        out = B.add_behaviour(df, PROFILES["A"], ("amount", "timing", "frequency"), policy=policy)
        return rounded(out.drop(*[c for c in df.columns if c != S.TXN]))
    return build


# A row without an amount has no mean to be compared with.
_AMOUNT = H.AMOUNT_A.replace("past_mean as", "case when amt is not null then past_mean end as")
_BASICS = H.BASICS.replace("cast(past_units as", "cast(coalesce(past_units,0) as")
_DENSE_FEATURES = round_sql(with_txn(
    f"select trans_num, {_AMOUNT}, {H.TIMING_A}, {H.FREQUENCY_A} from ratios",
    _DENSE, _DENSE_HISTORY, _BASICS, H.RATIOS),
    "customer_avg_amt_so_far", "customer_relative_amount_deviation", "amount_ratio_to_normal_spending",
    "customer_usual_transaction_hour", "hour_deviation_from_normal_behavior")

QUERIES: dict[str, Query] = {
    "W2_W17_features_cut_cards": Query(_merged_cut, history.QUERIES["J5_merged_feature_groups"].sql),
    "E3_E4_model_dataset_cut_cards": Query(_model_cut, history.QUERIES["E3_E4_model_dataset"].sql),
    "J1_W19_customer_cut_cards": Query(_customer_cut, history.QUERIES["J1_W19_customer_behaviour"].sql),
    "H7_behaviour_score_cut_cards": Query(_score_cut, round_sql(with_txn(
        f"select trans_num, {risk._BEST} as behaviour_score, {risk._FLAGS} as behaviour_flags from scored",
        H.HISTORY, risk._FOUND), "behaviour_score")),
    "H1_H7_detectors_dense_cards": Query(_dense_detectors, _DENSE_DETECTORS),
    "W6_W17_features_dense_cards": Query(_dense_features(None), _DENSE_FEATURES),
    "W6_W17_features_dense_cut_cards": Query(_dense_features(CUT), _DENSE_FEATURES),
}
