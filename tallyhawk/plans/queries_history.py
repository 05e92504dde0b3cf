"""Queries on the history of a card, customer features and the model dataset."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyhawk import schema as S
from tallyhawk.operators import behaviour as B, cleaning as C
from tallyhawk.operators.customer import add_customer_behaviour, card_stats
from tallyhawk.operators.encode import align, fit_levels, level_codes, one_hot, vector_input
from tallyhawk.operators.running import add_active_levels, add_level_ranks
from tallyhawk.plans import history_sql as H
from tallyhawk.plans.dataset import engineer_features, model_dataset
from tallyhawk.plans.driver_view import CATEGORIES, raw_transactions, table, with_txn
from tallyhawk.plans.registry import Query, array_sql, round_sql, rounded, rounded_array
from tallyhawk.settings import PROFILES

_INPUTS = [S.TXN, S.CARD, S.TIME, S.AMOUNT, "merch_lat", "merch_long"]


def _history_input(spark, sf_dir):
    return raw_transactions(spark, sf_dir).select(*_INPUTS)


def _features(profile: str, group: str):
    def build(spark, sf_dir):
        df = B.add_behaviour(_history_input(spark, sf_dir), PROFILES[profile], (group,))
        return rounded(df.drop(*[c for c in _INPUTS if c != S.TXN]))
    return build


def _feature_sql(select: str, *fractions: str) -> str:
    return round_sql(with_txn(f"select trans_num, {select} from ratios", *H.PARTS), *fractions)


def _previous(spark, sf_dir):
    out = B.previous_transaction(_history_input(spark, sf_dir))
    return rounded(out.select(S.TXN, "prev_lat", "prev_long", "prev_us"))


def _running(spark, sf_dir):
    out = B.running_amounts(_history_input(spark, sf_dir))
    return rounded(out.select(S.TXN, "running_amt", "running_rows"))


def _ordered(spark, sf_dir):
    """Rows in card and time order, placed by their number within the card."""
    out = B.running_amounts(_history_input(spark, sf_dir))
    return out.select(S.CARD, S.TXN, "running_rows").orderBy(S.CARD, "running_rows")


def _median(spark, sf_dir):
    df = _history_input(spark, sf_dir).select(S.TXN, S.CARD, S.AMOUNT)
    out = B.add_median_amounts(df).drop(S.CARD, S.AMOUNT)
    return rounded(out)


def _summary_profile(spark, sf_dir):
    out = B.add_behaviour(_history_input(spark, sf_dir), PROFILES["C"])
    return rounded(out.drop(*[c for c in _INPUTS if c != S.TXN]))


def _order_history(spark, sf_dir):
    """Amount history of customers' orders, where equal times happen."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey"), F.col("o_custkey").cast("string").alias(S.CARD),
        F.col("o_orderdate").alias(S.TIME), F.col("o_totalprice").alias(S.AMOUNT),
    )
    out = B.add_behaviour(orders, PROFILES["A"], ("amount", "timing", "frequency"),
                          tie=("o_orderkey",))
    return rounded(out.drop(S.CARD, S.TIME, S.AMOUNT))


_ORDER_SQL = round_sql(
    "with txn as (select o_orderkey as trans_num, cast(o_custkey as varchar) as cc_num, "
    "o_orderdate as trans_date_trans_time, o_totalprice as amt, "
    "cast(null as double) as merch_lat, cast(null as double) as merch_long from orders), "
    + ", ".join(H.PARTS)
    + f" select trans_num as o_orderkey, {H.AMOUNT_A}, {H.TIMING_A}, {H.FREQUENCY_A} from ratios",
    "customer_avg_amt_so_far", "customer_relative_amount_deviation",
    "amount_ratio_to_normal_spending", "customer_usual_transaction_hour",
    "hour_deviation_from_normal_behavior",
)


def _stats(spark, sf_dir):
    return rounded(card_stats(raw_transactions(spark, sf_dir)))


def _customer(spark, sf_dir):
    df = raw_transactions(spark, sf_dir).select(S.TXN, S.CARD, S.AMOUNT)
    return rounded(add_customer_behaviour(df).drop(S.CARD, S.AMOUNT))


def _order_customers(spark, sf_dir):
    """Count and mean per customer joined back to the orders."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    out = add_customer_behaviour(orders, key="o_custkey", amount="o_totalprice", row_id="o_orderkey")
    return rounded(out.drop("o_totalprice"))


def _merged(spark, sf_dir):
    """All four groups of the feature scripts, in one scan."""
    out = B.add_behaviour(_history_input(spark, sf_dir), PROFILES["A"])
    return rounded(out.drop(*[c for c in _INPUTS if c != S.TXN]))


# --- encoding and the final tables ------------------------------------------


def clean_view(spark, sf_dir):
    """The view after every cleaning step but the duplicate search; it has none."""
    df = C.drop_index(raw_transactions(spark, sf_dir))
    for step in (C.parse_times, C.card_to_text, C.pad_zip, C.pad_merchant_zip, C.trim_text,
                 C.upper_state):
        df = df.transform(step)
    return df


def _one_hot(spark, sf_dir):
    df = clean_view(spark, sf_dir).select(S.TXN, *S.ENCODED_COLUMNS)
    return one_hot(df, fit_levels(df))


# Sorted levels the view has.
_VIEW_LEVELS = {
    "category": sorted(CATEGORIES),
    "state": ["AK", "CA", "FL", "NY", "TX", "WA"],
    "Transaction_Type": ["In-store", "Online"],
    "Payment_Method": ["Credit Card", "Debit Card", "Mobile Payment"],
}


def _ranks(spark, sf_dir):
    """Codes of columns with as many levels as rows, and with few."""
    df = clean_view(spark, sf_dir).select(S.TXN, "merchant")
    return add_level_ranks(df, [S.TXN, "merchant"]).select(S.TXN, f"{S.TXN}_code", "merchant_code")


def _active(spark, sf_dir):
    """One-hot encoding as the positions that are 1."""
    df = clean_view(spark, sf_dir).select(S.TXN, "category", "gender")
    return add_active_levels(df, ["category", "gender"]).select(S.TXN, "active")


def _codes(spark, sf_dir):
    df = clean_view(spark, sf_dir).select(S.TXN, "category", "gender")
    return level_codes(df, fit_levels(df, ["category", "gender"])).drop("category", "gender")


def _engineered(spark, sf_dir):
    df = clean_view(spark, sf_dir).withColumn(
        "merch_zipcode_missing", F.col("merch_zipcode").isNull()
    )
    return rounded(engineer_features(df, S.MODEL_LEVELS, keep=(S.TXN,)))


_ENGINEERED_SQL = round_sql(
    with_txn(
        f"""select trans_num, amt, {H.GENDER}, lat, "long", city_pop, merch_lat, merch_long,
        "Customer_Satisfaction_Score", "Loyalty_Points_Earned", {H.TEMPORAL}, {H.HOME},
        {H.CUSTOMER}, {H.dummies_sql(S.MODEL_LEVELS)}, is_fraud from txn"""
    ),
    *H.MODEL_FRACTIONS[:8],
)


def flagship(spark, sf_dir):
    """The model dataset: 102 features and the target for every transaction."""
    return rounded(model_dataset(clean_view(spark, sf_dir)))


def _aligned(spark, sf_dir):
    """A batch with too few and too many columns, brought to the model schema."""
    df = clean_view(spark, sf_dir).select(S.TXN, "amt", "city_pop", "city", *S.ENCODED_COLUMNS)
    return rounded(align(one_hot(df, _VIEW_LEVELS), keep=(S.TXN,)))


def _aligned_sql() -> str:
    columns = []
    for name in S.MODEL_FEATURES:
        column = next((c for c in S.ENCODED_COLUMNS if name.startswith(f"{c}_")), None)
        if name in ("amt", "city_pop"):
            columns.append(name)
        elif column is not None and name[len(column) + 1:] in _VIEW_LEVELS[column]:
            level = name[len(column) + 1:]
            columns.append(f"""cast("{column}"='{level}' as int) as "{name}\"""")
        else:
            columns.append(f'0 as "{name}"')
    return with_txn(f"select trans_num, {', '.join(columns)} from txn")


def _vector(spark, sf_dir):
    """The vectors as plain arrays, so that another engine can hold them."""
    from pyspark.ml.functions import vector_to_array

    df = vector_input(model_dataset(clean_view(spark, sf_dir)))
    return df.select(S.TXN, rounded_array(vector_to_array("features")).alias("features"), S.TARGET)


_VECTOR_SQL = with_txn(
    "select trans_num, " + array_sql([f'cast("{c}" as double)' for c in S.MODEL_FEATURES])
    + " as features, is_fraud from model", *H.PARTS, H.MODEL)


_A = {
    "location": (H.LOCATION_A, ("distance_from_previous_transaction_km",
                                "time_since_previous_transaction_hours")),
    "amount": (H.AMOUNT_A, ("customer_avg_amt_so_far", "customer_relative_amount_deviation",
                            "amount_ratio_to_normal_spending")),
    "timing": (H.TIMING_A, ("customer_usual_transaction_hour",
                            "hour_deviation_from_normal_behavior")),
    "frequency": (H.FREQUENCY_A, ()),
}
_B = {
    "location": (H.LOCATION_B, ("prev_trans_distance_km", "hours_since_prev_trans",
                                "implied_travel_speed_kmh")),
    "amount": (H.AMOUNT_B, ("customer_hist_avg_amt", "customer_hist_std_amt",
                            "amount_ratio_to_normal", "customer_relative_amount_deviation")),
    "timing": (H.TIMING_B, ("customer_hist_avg_hour", "hour_deviation_from_normal")),
    "frequency": (H.FREQUENCY_B, ("transaction_velocity_per_min",)),
}


def _group_query(profile: str, group: str) -> Query:
    select, fractions = {"A": _A, "B": _B}[profile][group]
    sql = _feature_sql(select, *fractions) if fractions else with_txn(
        f"select trans_num, {select} from ratios", *H.PARTS)
    return Query(_features(profile, group), sql)


_MEDIAN_SQL = """median as (
  select trans_num, quantile_cont(amt, 0.5) over (partition by cc_num) as customer_median_amt, amt
  from txn), medians as (
  select trans_num, customer_median_amt, amt-customer_median_amt as amount_deviation,
    coalesce(amt/nullif(customer_median_amt,0),1e0) as amount_ratio_to_customer_median,
    cast(coalesce(amt/nullif(customer_median_amt,0),1e0)>=3 as int) as large_transaction_flag
  from median)"""
_MEDIAN_FRACTIONS = ("customer_median_amt", "amount_deviation", "amount_ratio_to_customer_median")

QUERIES: dict[str, Query] = {
    "W1_J4_previous_transaction": Query(_previous, round_sql(with_txn(
        "select trans_num, prev_lat, prev_long, epoch_us(prev_ts) as prev_us from hist",
        H.HISTORY), "prev_lat", "prev_long")),
    "W2_W5_location_change": _group_query("A", "location"),
    "W6_W9_amount_history": _group_query("A", "amount"),
    "W10_W12_odd_timing": _group_query("A", "timing"),
    "W13_W17_transaction_frequency": _group_query("A", "frequency"),
    "W6_W17_order_history_with_ties": Query(_order_history, _ORDER_SQL),
    "W18_running_totals": Query(_running, round_sql(with_txn(
        f"""select trans_num, cast(sum({H.UNITS}) over w as double)/1e4 as running_amt,
        row_number() over w as running_rows from txn
        window w as (partition by cc_num order by trans_date_trans_time, trans_num
                     rows between unbounded preceding and current row)"""), "running_amt")),
    "W20_card_time_order": Query(_ordered, with_txn(
        "select cc_num, trans_num, row_number() over (partition by cc_num "
        "order by trans_date_trans_time, trans_num) as running_rows from txn")),
    "B1_B3_location_model": _group_query("B", "location"),
    "B4_amount_model": _group_query("B", "amount"),
    "B5_B8_timing_model": _group_query("B", "timing"),
    "B6_B7_frequency_model": _group_query("B", "frequency"),
    "B9_median_amounts": Query(_median, round_sql(with_txn(
        "select * from medians", _MEDIAN_SQL), *_MEDIAN_FRACTIONS)),
    "B9_summary_profile": Query(_summary_profile, round_sql(with_txn(
        f"""select r.trans_num, r.location_changed, r.distance_from_previous_location_km,
        r.rapid_location_change, r.night_transaction, r.customer_usual_hour,
        r.hour_deviation_from_customer_pattern, r.unusual_transaction_hour,
        r.transactions_last_5min, r.transactions_last_30min, r.transactions_last_1hour,
        r.rapid_transaction_flag, m.customer_median_amt, m.amount_deviation,
        m.amount_ratio_to_customer_median, m.large_transaction_flag
        from (select trans_num, moved as distance_from_previous_location_km,
          cast(moved>50 and prev_lat is not null as int) as location_changed,
          cast(moved>50 and prev_lat is not null and coalesce(gap<1,false) as int)
            as rapid_location_change,
          cast(hr between 0 and 4 as int) as night_transaction, past_hour as customer_usual_hour,
          hour_off as hour_deviation_from_customer_pattern,
          cast(hour_off>6 and past_rows>0 as int) as unusual_transaction_hour,
          n5 as transactions_last_5min, n30 as transactions_last_30min,
          n60 as transactions_last_1hour, cast(n5>=2 as int) as rapid_transaction_flag
          from ratios) r join medians m on r.trans_num=m.trans_num""", *H.PARTS, _MEDIAN_SQL),
        "distance_from_previous_location_km", "customer_usual_hour",
        "hour_deviation_from_customer_pattern", *_MEDIAN_FRACTIONS)),
    "A1_card_stats": Query(_stats, round_sql(with_txn(
        f"""select cc_num, count(amt) as customer_txn_count,
        cast(sum({H.UNITS}) as double)/1e4/count(amt) as customer_avg_amt
        from txn group by cc_num"""), "customer_avg_amt")),
    "J1_W19_customer_behaviour": Query(_customer, round_sql(with_txn(
        f"select trans_num, {H.CUSTOMER} from txn"), "customer_avg_amt", "amt_vs_customer_avg")),
    "J1_order_customers": Query(_order_customers, round_sql(
        """select o.o_orderkey, o.o_custkey, s.customer_txn_count, s.customer_avg_amt,
        o.o_totalprice-s.customer_avg_amt as amt_vs_customer_avg from orders o
        left join (select o_custkey, count(o_totalprice) as customer_txn_count,
          cast(sum(cast(round(o_totalprice*1e4) as bigint)) as double)/1e4/count(o_totalprice)
            as customer_avg_amt from orders group by o_custkey) s on o.o_custkey=s.o_custkey""",
        "customer_avg_amt", "amt_vs_customer_avg")),
    "J5_merged_feature_groups": Query(_merged, _feature_sql(
        f"{H.LOCATION_A}, {H.AMOUNT_A}, {H.TIMING_A}, {H.FREQUENCY_A}",
        *[f for _, names in _A.values() for f in names])),
    "E1_one_hot": Query(_one_hot, with_txn(
        f"select trans_num, {H.dummies_sql(_VIEW_LEVELS)} from txn")),
    "E3_P11_P12_engineered_features": Query(_engineered, _ENGINEERED_SQL),
    "E4_aligned_batch": Query(_aligned, _aligned_sql()),
    "E5_feature_vectors": Query(_vector, _VECTOR_SQL),
    "E6_level_ranks": Query(_ranks, with_txn(
        """select trans_num, cast(dense_rank() over (order by trans_num)-1 as bigint) as trans_num_code,
          cast(dense_rank() over (order by merchant)-1 as bigint) as merchant_code from txn""")),
    "E1_active_levels": Query(_active, with_txn(
        """select trans_num, list_filter([case when c>0 then c-1 end, case when g>0 then g-1+n end], lambda x: x is not null) as active
        from (select trans_num, dense_rank() over (order by category)-1 as c, dense_rank() over (order by gender)-1 as g,
            (select count(distinct category)-1 from txn) as n from txn) r""")),
    "E6_level_codes": Query(_codes, with_txn(
        """select trans_num, cast(dense_rank() over (order by category)-1 as int) as category_encoded,
        cast(dense_rank() over (order by gender)-1 as int) as gender_encoded from txn""")),
    "E3_E4_model_dataset": Query(flagship, round_sql(
        with_txn("select * from model", *H.PARTS, H.MODEL), *H.MODEL_FRACTIONS)),
}
