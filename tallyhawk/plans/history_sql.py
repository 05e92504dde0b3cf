"""SQL text for the history features, used by the SQL side of the checks."""

from __future__ import annotations

from tallyhawk import schema as S


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    chord = (
        f"pow(sin((radians({lat2})-radians({lat1}))/2),2)"
        f"+cos(radians({lat1}))*cos(radians({lat2}))"
        f"*pow(sin((radians({lon2})-radians({lon1}))/2),2)"
    )
    # least() alone would turn an unknown place into a distance.
    return f"case when {chord} is not null then 2*6371e0*asin(least(1e0,sqrt({chord}))) end"


def _trailing(minutes: int) -> str:
    return (
        "count(amt) over (partition by cc_num order by trans_date_trans_time "
        f"range between interval '{minutes}' minute preceding and current row)"
        " - count(amt) over (partition by cc_num, trans_date_trans_time)"
    )


UNITS = "cast(round(amt*1e4) as bigint)"

# Each row of ``txn`` with what its card did before.
HISTORY = f"""hist as (
  select *, cast(hour(trans_date_trans_time) as int) as hr,
    lag(merch_lat) over w as prev_lat, lag(merch_long) over w as prev_long,
    lag(trans_date_trans_time) over w as prev_ts,
    count(*) over past as past_rows,
    sum({UNITS}) over past as past_units,
    sum(hour(trans_date_trans_time)) over past as past_hours,
    stddev_samp(amt) over past as past_std,
    {_trailing(5)} as n5, {_trailing(10)} as n10, {_trailing(30)} as n30, {_trailing(60)} as n60
  from txn
  window w as (partition by cc_num order by trans_date_trans_time, trans_num),
    past as (partition by cc_num order by trans_date_trans_time, trans_num
             rows between unbounded preceding and 1 preceding))"""

_MOVED = f"coalesce({haversine_sql('merch_lat', 'merch_long', 'prev_lat', 'prev_long')}, 0e0)"

# Named intermediate values the profiles share.
BASICS = f"""basic as (
  select *, {_MOVED} as moved,
    (epoch_us(trans_date_trans_time)-epoch_us(prev_ts))/3.6e9 as gap,
    case when past_rows>0 then cast(past_units as double)/1e4/past_rows end as past_mean,
    case when past_rows>0 then cast(past_hours as double)/past_rows end as past_hour
  from hist)"""
RATIOS = """ratios as (
  select *, coalesce(amt/nullif(past_mean,0), 1e0) as ratio,
    case when past_rows>0 then amt-past_mean else 0e0 end as deviation,
    coalesce(least(abs(hr-past_hour), 24-abs(hr-past_hour)), 0e0) as hour_off,
    coalesce(moved/greatest(coalesce(gap,0e0), 1e0/3600), 0e0) as speed
  from basic)"""
PARTS = (HISTORY, BASICS, RATIOS)

_CHANGED = "cast(moved>50 and prev_lat is not null as int)"
_LARGE = "cast(ratio>=3 and past_rows>0 as int) as large_transaction_flag"
_ODD = "cast(hour_off>6 and past_rows>0 as int) as unusual_transaction_hour"

LOCATION_A = f"""moved as distance_from_previous_transaction_km,
  gap as time_since_previous_transaction_hours, {_CHANGED} as location_changed,
  cast(moved>50 and prev_lat is not null and coalesce(gap<1,false) as int) as rapid_location_change"""
AMOUNT_A = f"""past_mean as customer_avg_amt_so_far, deviation as customer_relative_amount_deviation,
  ratio as amount_ratio_to_normal_spending, {_LARGE}"""
TIMING_A = f"""cast(hr between 0 and 4 as int) as night_transaction,
  past_hour as customer_usual_transaction_hour,
  hour_off as hour_deviation_from_normal_behavior, {_ODD}"""
FREQUENCY_A = """n5 as txn_count_last_5min, n30 as txn_count_last_30min,
  n60 as txn_count_last_60min, n60 as transaction_velocity,
  cast(n5>=2 as int) as rapid_transaction_flag"""

LOCATION_B = f"""moved as prev_trans_distance_km, coalesce(gap,0e0) as hours_since_prev_trans,
  {_CHANGED} as location_changed,
  case when prev_ts is null then 0e0 else speed end as implied_travel_speed_kmh,
  cast(prev_ts is not null and speed>900 as int) as rapid_location_change"""
AMOUNT_B = f"""coalesce(past_mean,amt) as customer_hist_avg_amt,
  coalesce(past_std,0e0) as customer_hist_std_amt, ratio as amount_ratio_to_normal,
  deviation as customer_relative_amount_deviation, {_LARGE}"""
TIMING_B = f"""cast(hr>=22 or hr<6 as int) as night_transaction,
  coalesce(past_hour,cast(hr as double)) as customer_hist_avg_hour,
  hour_off as hour_deviation_from_normal, {_ODD}"""
FREQUENCY_B = """n5 as txn_count_last_5min, n30 as txn_count_last_30min,
  n60 as txn_count_last_60min, n60/60e0 as transaction_velocity_per_min,
  cast(n5>=1 as int) as rapid_transaction_flag"""

TEMPORAL = """cast(floor(date_diff('day', dob, cast(trans_date_trans_time as date))/365) as int)
    as customer_age,
  cast(hour(trans_date_trans_time) as int) as trans_hour,
  cast(isodow(trans_date_trans_time)-1 as int) as trans_day_of_week,
  cast(month(trans_date_trans_time) as int) as trans_month,
  cast(isodow(trans_date_trans_time)>=6 as int) as is_weekend"""
HOME = haversine_sql("lat", "long", "merch_lat", "merch_long") + " as customer_merchant_distance_km"
CUSTOMER = f"""count(amt) over (partition by cc_num) as customer_txn_count,
  cast(sum({UNITS}) over (partition by cc_num) as double)/1e4/count(amt) over (partition by cc_num)
    as customer_avg_amt,
  amt-cast(sum({UNITS}) over (partition by cc_num) as double)/1e4
    /count(amt) over (partition by cc_num) as amt_vs_customer_avg"""


def dummies_sql(levels: dict[str, list[str]]) -> str:
    return ", ".join(
        f"""cast("{column}" is not distinct from '{level}' as int) as "{column}_{level}\""""
        for column, values in levels.items() for level in values[1:]
    )


GENDER = "case gender when 'M' then 0 when 'F' then 1 end as gender"

# All columns of the model dataset.
MODEL = f"""model as (
  select trans_num, amt, {GENDER}, lat, "long", city_pop, merch_lat, merch_long,
    "Customer_Satisfaction_Score", "Loyalty_Points_Earned",
    {TEMPORAL}, {HOME}, {CUSTOMER},
    {LOCATION_B}, {AMOUNT_B}, {TIMING_B}, {FREQUENCY_B},
    {dummies_sql(S.MODEL_LEVELS)}, is_fraud
  from ratios)"""

MODEL_FRACTIONS = [
    "amt", "lat", "long", "merch_lat", "merch_long", "customer_merchant_distance_km",
    "customer_avg_amt", "amt_vs_customer_avg", "prev_trans_distance_km",
    "hours_since_prev_trans", "implied_travel_speed_kmh", "customer_hist_avg_amt",
    "customer_hist_std_amt", "amount_ratio_to_normal", "customer_relative_amount_deviation",
    "customer_hist_avg_hour", "hour_deviation_from_normal", "transaction_velocity_per_min",
]
