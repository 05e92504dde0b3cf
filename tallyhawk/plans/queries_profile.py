"""Queries on fraud rates, table summaries and data-quality suites."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyhawk import schema as S
from tallyhawk.operators import behaviour as B, profiling as P, quality as Q
from tallyhawk.plans import history_sql as H
from tallyhawk.plans.dataset import model_dataset
from tallyhawk.plans.driver_view import raw_transactions, table, with_raw, with_txn
from tallyhawk.plans.queries_clean import COPIED_SQL, with_copies
from tallyhawk.plans.queries_history import clean_view
from tallyhawk.plans.registry import Query, round_sql, rounded
from tallyhawk.settings import PROFILE_A, PROFILES

# --- profiles ---------------------------------------------------------------


def _overall(spark, sf_dir):
    return rounded(P.overall_fraud(raw_transactions(spark, sf_dir)))


def _rate(column: str):
    def build(spark, sf_dir):
        df = clean_view(spark, sf_dir)
        return rounded(P.riskiest(P.fraud_rate_by(df, F.col(column), column), column))
    return build


def _rate_sql(column: str) -> str:
    return round_sql(with_txn(
        f'select "{column}", avg(is_fraud) as fraud_rate from txn group by 1'), "fraud_rate")


def _top_hours(spark, sf_dir):
    return rounded(P.riskiest(P.fraud_rate_by_hour(raw_transactions(spark, sf_dir)), "hour", 5))


def _hours(spark, sf_dir):
    return rounded(P.fraud_rate_by_hour(raw_transactions(spark, sf_dir)).orderBy("hour"))


_HOURS_SQL = with_txn(
    "select cast(hour(trans_date_trans_time) as int) as hour, avg(is_fraud) as fraud_rate "
    "from txn group by 1")


def _rate_profile(spark, sf_dir):
    return rounded(P.fraud_rate_profile(clean_view(spark, sf_dir)))


_PROFILE_SQL = round_sql(with_txn(" union all ".join(
    f"select '{name}' as dimension, cast({expression} as varchar) as level, "
    "avg(is_fraud) as fraud_rate, count(*) as transactions from txn group by 2"
    for name, expression in [(c, c) for c in ("category", "gender", "Payment_Method",
                                              "Transaction_Type")]
    + [("hour", "hour(trans_date_trans_time)")]
)), "fraud_rate")


def _amounts(spark, sf_dir):
    return rounded(P.amounts_by_class(raw_transactions(spark, sf_dir)))


def _classes(spark, sf_dir):
    return rounded(P.class_distribution(raw_transactions(spark, sf_dir)))


def _label_classes(spark, sf_dir):
    """Shares of the quality classes, rows of no class included."""
    documents = table(spark, sf_dir, "documents").select("doc_id")
    joined = documents.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return rounded(P.class_distribution(joined, "quality"))


def _classes_sql(source: str, target: str) -> str:
    return round_sql(
        f"""select {target}, case when {target}=1 then 'Fraud' when {target}=0 then 'Legitimate'
        else coalesce(cast({target} as varchar),'nan') end as label,
        count(*) as transactions, count(*)*100e0/(select count(*) from {source}) as percentage
        from {source} group by {target}""", "percentage")


def _histogram(spark, sf_dir):
    return rounded(P.amount_histogram(raw_transactions(spark, sf_dir)))


_HISTOGRAM_SQL = round_sql(with_raw(
    """select cast(b as int) as bin, lo+b*((hi-lo)/50) as low, lo+(b+1)*((hi-lo)/50) as high,
      count(amt) as transactions
    from (select min(amt) as lo, max(amt) as hi from raw where amt<500) e
    cross join range(50) r(b)
    left join (select amt from raw where amt<500) a
      on least(floor((amt-lo)/(hi-lo)*50), 49)=b
    group by b, lo, hi"""), "low", "high")


def _nulls(spark, sf_dir):
    return P.null_counts(dirty_view(spark, sf_dir))


def _total_nulls(spark, sf_dir):
    return P.total_nulls(dirty_view(spark, sf_dir))


_DESCRIBED = [S.AMOUNT, "lat", "long", "city_pop", "Customer_Age", "merch_zipcode", S.TARGET]


def _describe(spark, sf_dir):
    return rounded(P.describe(raw_transactions(spark, sf_dir), _DESCRIBED))


_DESCRIBE_SQL = round_sql(with_raw(" union all ".join(
    f"""select '{c}' as "column", round(cast(min("{c}") as double),3) as min,
    round(cast(max("{c}") as double),3) as max, round(avg("{c}"),3) as mean,
    round(stddev_samp("{c}"),3) as std from raw""" for c in _DESCRIBED
)), "min", "max", "mean", "std")

_NEW = ["distance_from_previous_transaction_km", "time_since_previous_transaction_hours",
        "amount_ratio_to_normal_spending", "hour_deviation_from_normal_behavior"]
_FLAGS = ["location_changed", "rapid_location_change", "large_transaction_flag",
          "night_transaction", "unusual_transaction_hour", "rapid_transaction_flag"]
_FULL = ["count", "mean", "std", "min", "max", "q25", "q50", "q75"]


def _script_features(spark, sf_dir):
    return B.add_behaviour(raw_transactions(spark, sf_dir), PROFILE_A)


def _describe_full(spark, sf_dir):
    return rounded(P.describe_full(_script_features(spark, sf_dir), _NEW), 5)


def _script_sql() -> str:
    return (f"feat as (select trans_num, {H.LOCATION_A}, {H.AMOUNT_A}, {H.TIMING_A}, "
            f"{H.FREQUENCY_A} from ratios)")


_DESCRIBE_FULL_SQL = round_sql(with_txn(" union all ".join(
    f"""select '{c}' as "column", count({c}) as "count", avg({c}) as mean,
    stddev_samp({c}) as std, min({c}) as min, max({c}) as max, quantile_cont({c},0.25) as q25,
    quantile_cont({c},0.5) as q50, quantile_cont({c},0.75) as q75 from feat""" for c in _NEW
), *H.PARTS, _script_sql()), *[c for c in _FULL if c != "count"], digits=5)


def _flag_counts(spark, sf_dir):
    return P.flag_counts(_script_features(spark, sf_dir), _FLAGS)


_FLAG_SQL = with_txn(" union all ".join(
    f"""select '{c}' as "column", cast(sum({c}) as bigint) as flagged from feat""" for c in _FLAGS
), *H.PARTS, _script_sql())


def _match(spark, sf_dir):
    return rounded(P.match_rates(raw_transactions(spark, sf_dir)))


def _types(spark, sf_dir):
    return P.type_counts(raw_transactions(spark, sf_dir))


# The types of the view's columns.
_KINDS = {
    "bigint": ["Unnamed: 0", "unix_time", "zip", "city_pop", "Customer_Age",
               "Customer_Satisfaction_Score", "Loyalty_Points_Earned"],
    "date": ["dob"],
    "double": ["amt", "lat", "long", "merch_lat", "merch_long", "merch_zipcode"],
    "int": ["is_fraud"],
    "string": ["trans_num", "cc_num", "Transaction_Time", *S.TEXT_COLUMNS],
    "timestamp_ntz": ["trans_date_trans_time"],
}
_KINDS_SQL = with_raw(" union all ".join(
    f"""select '{kind}' as type, {len(columns)} as columns,
    {"+".join(f'count("{c}")' for c in columns)} as "values" from raw"""
    for kind, columns in _KINDS.items()))


def _overview(spark, sf_dir):
    df = with_copies(raw_transactions(spark, sf_dir)).drop(S.INDEX_COLUMN)
    return P.overview(df)


# --- quality ----------------------------------------------------------------

# Rows made wrong on purpose: expressions that mean the same in both engines.
_ID = "cast(trans_num as bigint)"
DIRTY = {
    "amt": f"case when {_ID}%53=0 then -amt when {_ID}%59=0 then null else amt end",
    "Customer_Age": f"case when {_ID}%61=0 then 130 when {_ID}%67=0 then null "
                    "else Customer_Age end",
    "Customer_Satisfaction_Score": f"case when {_ID}%71=0 then 11 "
                                   "else Customer_Satisfaction_Score end",
    "lat": f"case when {_ID}%73=0 then 95e0 when {_ID}%79=0 then null else lat end",
    "long": f"case when {_ID}%83=0 then -200e0 else long end",
    "is_fraud": f"case when {_ID}%89=0 then 2 when {_ID}%97=0 then null else is_fraud end",
    "gender": f"case when {_ID}%101=0 then 'X' else gender end",
}
MODEL_DIRTY = {
    "amt": f"case when {_ID}%53=0 then -1-amt else amt end",
    "lat": f"case when {_ID}%73=0 then 95e0 else lat end",
    "trans_hour": f"case when {_ID}%79=0 then 24 else trans_hour end",
    "is_weekend": f"case when {_ID}%83=0 then 2 else is_weekend end",
    "customer_age": f"case when {_ID}%89=0 then null else customer_age end",
    "prev_trans_distance_km": f"case when {_ID}%97=0 then -1e0 else prev_trans_distance_km end",
    "customer_hist_std_amt": f"case when {_ID}%101=0 then cast('infinity' as double) "
                             "else customer_hist_std_amt end",
    "large_transaction_flag": f"case when {_ID}%103=0 then 3 else large_transaction_flag end",
    "night_transaction": f"case when {_ID}%107=0 then 1-night_transaction "
                         "else night_transaction end",
    "txn_count_last_5min": f"case when {_ID}%109=0 then 99 else txn_count_last_5min end",
    "transaction_velocity_per_min": f"case when {_ID}%113=0 then -5e-1 "
                                    "else transaction_velocity_per_min end",
    "hour_deviation_from_normal": f"case when {_ID}%127=0 then 13e0 "
                                  "else hour_deviation_from_normal end",
    "is_fraud": f"case when {_ID}%131=0 then 7 else is_fraud end",
}


def _replace_sql(name: str, source: str, changes: dict[str, str]) -> str:
    body = ", ".join(f'{e} as "{c}"' for c, e in changes.items())
    return f"{name} as (select * replace ({body}) from {source})"


DIRTY_SQL = _replace_sql("dirty", "txn", DIRTY)
MODEL_DIRTY_SQL = _replace_sql("wrong", "model", MODEL_DIRTY)


def dirty_view(spark, sf_dir):
    df = clean_view(spark, sf_dir)
    return df.withColumns({c: F.expr(e) for c, e in DIRTY.items()})


def dirty_model(spark, sf_dir):
    df = model_dataset(clean_view(spark, sf_dir))
    return df.withColumns({c: F.expr(e) for c, e in MODEL_DIRTY.items()})


def _checks_sql(source: str, checks: list[tuple[str, str]], *more: str) -> str:
    """A suite as SQL: the violations of each check as one aggregate."""
    # A constant needs an aggregate around it, or every row would give a result.
    columns = ", ".join(
        f"{f'max({e})' if e.isdigit() else e} as v{i}" for i, (_, e) in enumerate(checks, 1)
    )
    rows = " union all ".join(
        f"""select {i} as position, '{name.replace("'", "''")}' as "check", v{i}=0 as passed,
        cast(v{i} as bigint) as violations from counted"""
        for i, (name, _) in enumerate(checks, 1)
    )
    return with_txn(rows, *more, f"counted as (select {columns} from {source})")


def _bad(condition: str) -> str:
    return f"count(*) filter (where {condition})"


def _sum(*conditions: str) -> str:
    return "+".join(_bad(c) for c in conditions) or "0"


def _out(column: str, low: float, high: float) -> str:
    return f'not coalesce("{column}" between {low} and {high}, false)'


def _not01(column: str) -> str:
    return f'not coalesce("{column}" in (0,1), false)'


def _copies_of(source: str, columns: str = "*") -> str:
    return f"(select count(*) from {source})-(select count(*) from (select distinct {columns} from {source}))"


def _final_sql(source: str, rows: int, *more: str) -> str:
    numeric = Q.REQUIRED_COLUMNS
    return _checks_sql(source, [
        ("Required columns present", "0"),
        ("'is_fraud' target column exists and is binary", _sum(_not01(S.TARGET))),
        ("Row count matches expected dataset size", f"abs(count(*)-{rows})"),
        ("No duplicate rows", _copies_of(source)),
        ("No missing values",
         _sum(*[f'"{c}" is null' for c in [S.TXN, *S.MODEL_FEATURES, S.TARGET]])),
        ("Numeric feature columns have numeric dtypes", "0"),
        ("Numeric columns contain only finite, valid values",
         _sum(*[f'"{c}" is null or not isfinite(cast("{c}" as double))' for c in numeric])),
        ("Values within expected ranges", _sum(*[_out(c, *b) for c, b in Q.RANGES.items()])),
        ("Binary flag columns contain only 0/1", _sum(*[_not01(c) for c in Q.BINARY_COLUMNS])),
        ("No unexpected negative values", _sum(*[f'"{c}"<0' for c in Q.NON_NEGATIVE_COLUMNS])),
        ("Location-change features internally valid",
         _sum("prev_trans_distance_km<0", "hours_since_prev_trans<0",
              "implied_travel_speed_kmh<0", _not01("location_changed"),
              _not01("rapid_location_change"))),
        ("Transaction-amount anomaly features internally valid",
         _sum("customer_hist_avg_amt<0", "customer_hist_std_amt<0", "amount_ratio_to_normal<0",
              _not01("large_transaction_flag"))),
    ], *H.PARTS, H.MODEL, *more)


def _behaviour_sql(source: str, *more: str) -> str:
    counts = ["txn_count_last_5min", "txn_count_last_30min", "txn_count_last_60min"]
    return _checks_sql(source, [
        ("Required behavioral columns present", "0"),
        ("No duplicate rows", _copies_of(source)),
        ("No missing values in behavioral columns",
         _sum(*[f'"{c}" is null' for c in S.BEHAVIOUR_COLUMNS])),
        ("Binary behavioral flags contain only 0/1", _sum(*[_not01(c) for c in (
            "night_transaction", "unusual_transaction_hour", "rapid_transaction_flag")])),
        ("night_transaction matches trans_hour window (22:00-05:59)",
         _sum("cast(trans_hour>=22 or trans_hour<6 as int)<>night_transaction")),
        ("Timing feature values within expected ranges",
         _sum(_out("customer_hist_avg_hour", 0, 23), _out("hour_deviation_from_normal", 0, 12))),
        ("Transaction frequency/velocity values are non-negative",
         _sum(*[f"{c}<0" for c in [*counts, "transaction_velocity_per_min"]])),
        ("Transaction count columns contain whole numbers",
         _sum(*[f"{c}%1<>0" for c in counts])),
        ("Trailing windows are properly nested (5min <= 30min <= 60min)",
         _sum("txn_count_last_5min>txn_count_last_30min",
              "txn_count_last_30min>txn_count_last_60min")),
        ("transaction_velocity_per_min matches formula (60min count / 60)",
         _sum("round(txn_count_last_60min/60e0,6)<>round(transaction_velocity_per_min,6)")),
        ("rapid_transaction_flag matches 5-minute rule",
         _sum("cast(txn_count_last_5min>=1 as int)<>rapid_transaction_flag")),
    ], *H.PARTS, H.MODEL, *more)


def _behaviour_rules_sql() -> list[tuple[str, str, list[tuple[str, str, list[str]]]]]:
    """Per check of the timing suite: name, detail when passed, (label, condition, columns)."""
    counts = ["txn_count_last_5min", "txn_count_last_30min", "txn_count_last_60min"]
    velocity = "transaction_velocity_per_min"

    def each(condition, columns):
        return [(c, condition(c), [c]) for c in columns]

    return [
        ("Required behavioral columns present", "all expected columns found", []),
        ("No duplicate rows", "0 duplicates", []),
        ("No missing values in behavioral columns", "0 missing values",
         each(lambda c: f'"{c}" is null', S.BEHAVIOUR_COLUMNS)),
        ("Binary behavioral flags contain only 0/1", "all valid", each(_not01, Q.BEHAVIOUR_FLAGS)),
        ("night_transaction matches trans_hour window (22:00-05:59)", "matches for all rows",
         [("mismatched rows", "cast(trans_hour>=22 or trans_hour<6 as int)<>night_transaction",
           ["trans_hour", "night_transaction"])]),
        ("Timing feature values within expected ranges", "all within range",
         [("customer_hist_avg_hour", _out("customer_hist_avg_hour", 0, 23),
           ["customer_hist_avg_hour"]),
          ("hour_deviation_from_normal", _out("hour_deviation_from_normal", 0, 12),
           ["hour_deviation_from_normal"])]),
        ("Transaction frequency/velocity values are non-negative", "all non-negative",
         each(lambda c: f'"{c}"<0', [*counts, velocity])),
        ("Transaction count columns contain whole numbers", "all whole numbers",
         each(lambda c: f'"{c}"%1<>0', counts)),
        ("Trailing windows are properly nested (5min <= 30min <= 60min)", "holds for all rows",
         [("5min count > 30min count", f"{counts[0]}>{counts[1]}", counts),
          ("30min count > 60min count", f"{counts[1]}>{counts[2]}", counts)]),
        (f"{velocity} matches formula (60min count / 60)", "holds for all rows",
         [("mismatched rows", f"round({counts[2]}/60e0,6)<>round({velocity},6)",
           [counts[2], velocity])]),
        ("rapid_transaction_flag matches 5-minute rule", "holds for all rows",
         [("mismatched rows", f"cast({counts[0]}>=1 as int)<>rapid_transaction_flag",
           [counts[0], "rapid_transaction_flag"])]),
    ]


def _final_rules_sql() -> dict[int, tuple[str, list[tuple[str, str, list[str]]]]]:
    """Place of each check of the final suite that rows can break: name and conditions."""
    def each(condition, columns):
        return [(c, condition(c), [c]) for c in columns]

    def group(never_negative, binary):
        return ([(f"{c} has negative values", f'"{c}"<0', [c]) for c in never_negative]
                + [(f"{c} has non-binary values", _not01(c), [c]) for c in binary])

    finite = []
    for c in Q.REQUIRED_COLUMNS:
        value = f'cast("{c}" as double)'
        finite.append((f"{c} inf", f"isinf({value})", [c]))
        finite.append((f"{c} nan", f"{value} is null or isnan({value})", [c]))
    return {
        2: ("'is_fraud' target column exists and is binary",
            [("values other than 0/1", _not01(S.TARGET), [S.TARGET])]),
        5: ("No missing values",
            each(lambda c: f'"{c}" is null', [S.TXN, *S.MODEL_FEATURES, S.TARGET])),
        7: ("Numeric columns contain only finite, valid values", finite),
        8: ("Values within expected ranges", [(c, _out(c, *b), [c]) for c, b in Q.RANGES.items()]),
        9: ("Binary flag columns contain only 0/1", each(_not01, Q.BINARY_COLUMNS)),
        10: ("No unexpected negative values",
             each(lambda c: f'"{c}"<0', Q.NON_NEGATIVE_COLUMNS)),
        11: ("Location-change features internally valid",
             group(["prev_trans_distance_km", "hours_since_prev_trans",
                    "implied_travel_speed_kmh"], ["location_changed", "rapid_location_change"])),
        12: ("Transaction-amount anomaly features internally valid",
             group(["customer_hist_avg_amt", "customer_hist_std_amt", "amount_ratio_to_normal"],
                   ["large_transaction_flag"])),
    }


def _bad_values(spark, sf_dir):
    """What breaks both suites. Fractions are shown in millionths: engines write them apart."""
    df = dirty_model(spark, sf_dir)
    shown = F.transform("values", lambda v: F.coalesce(
        F.when(v.isin("Infinity", "NaN"), v),
        F.round(v.try_cast("double") * 1e6).cast("bigint").cast("string"), F.lit("")))
    out = None
    for suite, rules in (("final", Q.final_rules(df, EXPECTED)), ("behaviour", Q.behaviour_rules(df))):
        part = Q.bad_value_counts(df, rules).withColumn("suite", F.lit(suite))
        out = part if out is None else out.unionByName(part)
    return out.withColumns({"columns": F.array_join("columns", ","),
                            "values": F.array_join(shown, ",")})


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _bad_values_sql() -> str:
    def show(column: str) -> str:
        x = f'try_cast("{column}" as double)'
        return (f"case when {x} is null then '' when isnan({x}) then 'NaN' "
                f"when isinf({x}) then 'Infinity' "
                f"else cast(cast(round({x}*1e6) as bigint) as varchar) end")

    checks = [("final", i, name, rules) for i, (name, rules) in _final_rules_sql().items()]
    checks += [("behaviour", i, name, rules)
               for i, (name, _, rules) in enumerate(_behaviour_rules_sql(), 1)]
    cases = ", ".join(
        f"case when {bad} then struct_pack(suite := '{suite}', position := {i}, "
        f"name := {_quoted(name)}, label := '{label}', cols := '{','.join(columns)}', "
        f"vals := {'||chr(44)||'.join(show(c) for c in columns)}) end"
        for suite, i, name, rules in checks for label, bad, columns in rules)
    return with_txn(
        """select v.suite as suite, cast(v.position as int) as position, v.name as "check",
          v.label as label, v.cols as "columns", v.vals as "values", count(*) as rows
        from found where v is not null group by all""",
        *H.PARTS, H.MODEL, MODEL_DIRTY_SQL, f"found as (select unnest([{cases}]) as v from wrong)")


# Fixed value: the row count the final suite is told to expect.
EXPECTED = 10_000


def _suite(source, suite, **settings):
    def build(spark, sf_dir):
        return suite(source(spark, sf_dir), **settings).drop("detail")
    return build


def _model(spark, sf_dir):
    return model_dataset(clean_view(spark, sf_dir))


def _values(spark, sf_dir):
    df = dirty_view(spark, sf_dir)
    copies = F.expr(f"case when {_ID}%100=0 then array(0,1) else array(0) end")
    return rounded(Q.validation_values(df.withColumn("_c", F.explode(copies)).drop("_c")))


def _values_sql() -> str:
    checks = [
        ("amt <= 0", _bad("amt<=0")),
        ("Customer_Age outside 0-120", _bad(_out("Customer_Age", 0, 120))),
        ("Customer_Satisfaction_Score outside 1-10",
         _bad(_out("Customer_Satisfaction_Score", 1, 10))),
        ("lat outside -90..90", _bad(_out("lat", -90, 90))),
        ("long outside -180..180", _bad(_out("long", -180, 180))),
        ("is_fraud not in {0,1}", _bad(_not01("is_fraud"))),
        ("gender not in {M,F}", _bad("not coalesce(gender in ('M','F'), false)")),
        ("duplicate trans_num", "count(*)-count(distinct trans_num)"),
        ("Transaction_Time matches real timestamp (rate)",
         "round(avg(cast(coalesce(strftime(trans_date_trans_time,'%H:%M')=\"Transaction_Time\","
         "false) as int)),4)"),
        ("Customer_Age matches dob-derived age (rate)",
         "round(avg(cast(coalesce(year(trans_date_trans_time)-year(dob)=\"Customer_Age\",false) "
         "as int)),4)"),
    ]
    columns = ", ".join(f"{e} as v{i}" for i, (_, e) in enumerate(checks, 1))
    rows = " union all ".join(
        f"""select {i} as position, '{n}' as "check", cast(v{i} as double) as value from counted"""
        for i, (n, _) in enumerate(checks, 1))
    return round_sql(with_txn(
        rows, DIRTY_SQL,
        f"""again as (select dirty.* from dirty join (values (0),(1)) t(c)
          on c=0 or {_ID}%100=0)""",
        f"counted as (select {columns} from again)"), "value")


def _ready(spark, sf_dir):
    return Q.readiness_checks(dirty_view(spark, sf_dir)).drop("detail")


_READY_SQL = _checks_sql("dirty", [
    ("Dataset is not empty", "case when count(*)>0 then 0 else 1 end"),
    ("Target column exists", "0"),
    ("No duplicate rows", _copies_of("dirty")),
    ("No missing values", "({})".format("+".join(
        f'count(*)-count("{c}")' for c in [f.name for f in S.RAW_SCHEMA.fields]
        if c != S.INDEX_COLUMN))),
    ("Target contains only 0/1", _bad("is_fraud not in (0,1)")),
], DIRTY_SQL)


def _presence(spark, sf_dir):
    """Which summary columns the three profiles have, and in how many rows filled."""
    df = raw_transactions(spark, sf_dir)
    out = None
    for name in ("A", "B", "C"):
        featured = B.add_behaviour(df, PROFILES[name])
        groups = Q.feature_group_presence(featured).withColumn("profile", F.lit(name))
        filled = featured.agg(F.array(*[
            F.struct(F.lit(group).alias("feature_group"), F.count_if(_all_filled(
                [c for c in columns if c in featured.columns])).alias("filled_rows"))
            for group, columns in Q.SUMMARY_GROUPS.items()
        ]).alias("_g")).select(F.explode("_g").alias("_g")).select("_g.*")
        found = groups.join(filled, "feature_group")
        out = found if out is None else out.unionByName(found)
    return out


def _all_filled(columns: list[str]):
    filled = F.lit(bool(columns))
    for c in columns:
        filled = filled & F.col(c).isNotNull()
    return filled


def _schema_checks(spark, sf_dir):
    """Suites on a table that lacks most columns: they fail or skip, as specified."""
    df = clean_view(spark, sf_dir).select(S.TXN, S.AMOUNT, "gender", S.TARGET)
    return Q.final_checks(df).unionByName(Q.behaviour_checks(df)).drop("detail")


def _schema_checks_sql() -> str:
    slim = "slim as (select trans_num, amt, gender, is_fraud from txn)"
    final = _checks_sql("slim", [
        ("Required columns present", str(len(Q.REQUIRED_COLUMNS) - 3)),
        ("'is_fraud' target column exists and is binary", _sum(_not01(S.TARGET))),
        ("Row count matches expected dataset size", "abs(count(*)-100000)"),
        ("No duplicate rows", _copies_of("slim")),
        ("No missing values",
         _sum("trans_num is null", "amt is null", "gender is null", "is_fraud is null")),
        # Gender is still text here: a wrong type, and never 0 or 1.
        ("Numeric feature columns have numeric dtypes", "1"),
        ("Numeric columns contain only finite, valid values",
         _sum("amt is null or not isfinite(amt)", "is_fraud is null")),
        ("Values within expected ranges", "0"),
        ("Binary flag columns contain only 0/1", f"count(*)+{_sum(_not01(S.TARGET))}"),
        ("No unexpected negative values", _sum("amt<0")),
        ("Location-change features internally valid", "5"),
        ("Transaction-amount anomaly features internally valid", "5"),
    ], slim)
    behaviour = _checks_sql("slim", [
        ("Required behavioral columns present", "9"),
        ("No duplicate rows", _copies_of("slim")),
        ("No missing values in behavioral columns", "0"),
        ("Binary behavioral flags contain only 0/1", "0"),
        ("night_transaction matches trans_hour window (22:00-05:59)", "0"),
        ("Timing feature values within expected ranges", "0"),
        ("Transaction frequency/velocity values are non-negative", "0"),
        ("Transaction count columns contain whole numbers", "0"),
        ("Trailing windows are properly nested (5min <= 30min <= 60min)", "3"),
        ("transaction_velocity_per_min matches formula (60min count / 60)", "2"),
        ("rapid_transaction_flag matches 5-minute rule", "2"),
    ], slim)
    return f"select * from ({final}) f union all select * from ({behaviour}) b"


def _verdicts(spark, sf_dir):
    good = Q.verdict(Q.behaviour_checks(_model(spark, sf_dir)))
    wrong = Q.verdict(Q.behaviour_checks(dirty_model(spark, sf_dir)))
    return good.withColumn("data", F.lit("model")).unionByName(
        wrong.withColumn("data", F.lit("wrong")))


def _verdict_sql() -> str:
    def one(name: str, body: str) -> str:
        return (f"select bool_and(passed) as all_passed, count(*) filter (where not passed) as failed, "
                f"count(*) as checks, '{name}' as data from ({body}) s")
    return (one("model", _behaviour_sql("model")) + " union all "
            + one("wrong", _behaviour_sql("wrong", MODEL_DIRTY_SQL)))


def _lines(spark, sf_dir):
    return Q.check_lines(Q.behaviour_checks(dirty_model(spark, sf_dir)))


def _lines_sql() -> str:
    """One line a check, with the count of each broken rule."""
    rules = _behaviour_rules_sql()
    counts = ", ".join(f"count(*) filter (where {bad}) as v{i}_{k}"
                       for i, (_, _, labels) in enumerate(rules, 1)
                       for k, (_, bad, _) in enumerate(labels))
    lines = []
    for i, (name, ok, labels) in enumerate(rules, 1):
        total = "+".join(f"v{i}_{k}" for k in range(len(labels))) or "0"
        found = ", ".join(f"case when v{i}_{k}>0 then {_quoted(label + ': ')}||v{i}_{k} end"
                          for k, (label, _, _) in enumerate(labels)) or "''"
        lines.append(
            f"select {i} as position, case when {total}=0 "
            f"then {_quoted(f'  [PASS] {name} — {ok}')} "
            f"else {_quoted(f'  [FAIL] {name} — ')}||concat_ws('; ', {found}) end as line "
            "from counted")
    return with_txn(" union all ".join(lines), *H.PARTS, H.MODEL, MODEL_DIRTY_SQL,
                    f"counted as (select {counts} from wrong)")


QUERIES: dict[str, Query] = {
    "A2_overall_fraud": Query(_overall, round_sql(with_raw(
        """select avg(is_fraud) as fraud_rate, cast(sum(is_fraud) as bigint) as frauds,
        count(*) as transactions from raw"""), "fraud_rate")),
    "A3_fraud_by_category": Query(_rate("category"), _rate_sql("category")),
    "A4_fraud_by_gender": Query(_rate("gender"), _rate_sql("gender")),
    "A5_fraud_by_payment": Query(_rate("Payment_Method"), _rate_sql("Payment_Method")),
    "A6_fraud_by_type": Query(_rate("Transaction_Type"), _rate_sql("Transaction_Type")),
    "A3_A8_fraud_profile": Query(_rate_profile, _PROFILE_SQL),
    "A7_riskiest_hours": Query(_top_hours, round_sql(
        f"select * from ({_HOURS_SQL}) h order by fraud_rate desc, hour limit 5", "fraud_rate")),
    "A8_fraud_by_hour": Query(_hours, round_sql(_HOURS_SQL, "fraud_rate")),
    "A9_amount_by_class": Query(_amounts, round_sql(with_raw(
        """select avg(amt) filter (where is_fraud=1) as avg_fraud_amt,
        avg(amt) filter (where is_fraud=0) as avg_normal_amt from raw"""),
        "avg_fraud_amt", "avg_normal_amt")),
    "A10_class_distribution": Query(_classes, with_raw(_classes_sql("raw", "is_fraud"))),
    "A10_label_distribution": Query(_label_classes, _classes_sql(
        "(select d.doc_id, l.quality from documents d left join labels l using (doc_id)) x",
        "quality")),
    "A11_amount_histogram": Query(_histogram, _HISTOGRAM_SQL),
    "A12_null_counts": Query(_nulls, with_txn(
        "select * from (" + " union all ".join(
            f"""select '{c}' as "column", count(*)-count("{c}") as nulls from dirty"""
            for c in S.RAW_SCHEMA.fieldNames() if c != S.INDEX_COLUMN
        ) + ") n where nulls>0", DIRTY_SQL)),
    "A13_total_nulls": Query(_total_nulls, with_txn(
        "select " + "+".join(f'count(*)-count("{c}")' for c in S.RAW_SCHEMA.fieldNames()
                             if c != S.INDEX_COLUMN) + " as nulls from dirty", DIRTY_SQL)),
    "A14_describe": Query(_describe, _DESCRIBE_SQL),
    "A15_describe_features": Query(_describe_full, _DESCRIBE_FULL_SQL),
    "A16_flag_counts": Query(_flag_counts, _FLAG_SQL),
    "A17_match_rates": Query(_match, round_sql(with_raw(
        """select round(avg(cast(strftime(trans_date_trans_time,'%H:%M')="Transaction_Time"
          as int)),4) as time_match_rate,
        round(avg(cast(year(trans_date_trans_time)-year(dob)="Customer_Age" as int)),4)
          as age_match_rate from raw"""), "time_match_rate", "age_match_rate")),
    "A18_column_types": Query(_types, _KINDS_SQL),
    "A19_overview": Query(_overview, with_raw(
        f"""select count(*) as rows, {len(S.RAW_SCHEMA) - 1} as columns,
        {_copies_of("copied", '* exclude ("Unnamed: 0")')} as duplicate_rows,
        count(*)-count(merch_zipcode) as nulls from copied""", COPIED_SQL)),
    "Q1_Q10_validation_values": Query(_values, _values_sql()),
    "Q11_Q22_final_checks": Query(
        _suite(_model, Q.final_checks, expected_rows=EXPECTED), _final_sql("model", EXPECTED)),
    "Q11_Q22_final_checks_wrong_data": Query(
        _suite(dirty_model, Q.final_checks, expected_rows=EXPECTED),
        _final_sql("wrong", EXPECTED, MODEL_DIRTY_SQL)),
    "Q23_Q32_behaviour_checks": Query(_suite(_model, Q.behaviour_checks), _behaviour_sql("model")),
    "Q23_Q32_behaviour_checks_wrong_data": Query(
        _suite(dirty_model, Q.behaviour_checks), _behaviour_sql("wrong", MODEL_DIRTY_SQL)),
    "Q11_Q32_missing_columns": Query(_schema_checks, _schema_checks_sql()),
    "Q12_Q19_Q25_bad_values": Query(_bad_values, _bad_values_sql()),
    "Q33_readiness": Query(_ready, _READY_SQL),
    "Q34_feature_groups": Query(_presence),
    "Q35_verdict": Query(_verdicts, _verdict_sql()),
    "Q35_check_lines": Query(_lines, _lines_sql()),
}
