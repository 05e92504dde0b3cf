"""Data-quality suites: a list of rules, checked in a single aggregate.

A suite returns one row per check: ``position, check, passed, violations,
detail``. The caller decides what a failure means.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from tallyhawk import schema as S
from tallyhawk.functions.clock import hour_minute, year_gap
from tallyhawk.functions.numbers import missing, violates
from tallyhawk.operators.cleaning import ROW_HASH, duplicate_keys, row_hash
from tallyhawk.operators.profiling import match_rate

CHECK_SCHEMA = "position int, check string, passed boolean, violations bigint, detail string"

# Bounds and column lists of the checks.
RANGES = {
    "lat": (-90, 90),
    "merch_lat": (-90, 90),
    "long": (-180, 180),
    "merch_long": (-180, 180),
    "Customer_Satisfaction_Score": (1, 10),
    "trans_hour": (0, 23),
    "trans_day_of_week": (0, 6),
    "trans_month": (1, 12),
    "customer_age": (0, 120),
}
BINARY_COLUMNS = [
    "gender", "is_weekend", "location_changed", "rapid_location_change",
    "large_transaction_flag", "night_transaction", "unusual_transaction_hour",
    "rapid_transaction_flag", "is_fraud",
]
NON_NEGATIVE_COLUMNS = [
    "amt", "city_pop", "Loyalty_Points_Earned", "customer_age",
    "customer_merchant_distance_km", "customer_txn_count", "customer_avg_amt",
    "prev_trans_distance_km", "hours_since_prev_trans", "implied_travel_speed_kmh",
    "customer_hist_avg_amt", "customer_hist_std_amt", "amount_ratio_to_normal",
    "customer_hist_avg_hour", "hour_deviation_from_normal", "txn_count_last_5min",
    "txn_count_last_30min", "txn_count_last_60min", "transaction_velocity_per_min",
]
REQUIRED_COLUMNS = [*S.NUMERIC_FEATURES, S.TARGET]
COUNT_COLUMNS = S.FREQUENCY_COLUMNS[:3]
BEHAVIOUR_FLAGS = ["night_transaction", "unusual_transaction_hour", "rapid_transaction_flag"]
SUMMARY_GROUPS = {
    "Location Change": [
        "location_changed", "distance_from_previous_location_km", "rapid_location_change",
    ],
    "Large Amount": [
        "customer_median_amt", "amount_deviation", "amount_ratio_to_customer_median",
        "large_transaction_flag",
    ],
    "Odd Timing": [
        "night_transaction", "unusual_transaction_hour", "customer_usual_hour",
        "hour_deviation_from_customer_pattern",
    ],
    "Transaction Frequency": [
        "transactions_last_5min", "transactions_last_30min", "transactions_last_1hour",
        "rapid_transaction_flag",
    ],
}


@dataclass(frozen=True)
class Check:
    """A named check. ``broken`` maps a label to the condition of a bad row."""

    name: str
    broken: dict[str, Column] = field(default_factory=dict)
    # Columns without which the check fails outright.
    needs: Sequence[str] = ()
    ok: str = "no violations"
    # A result known without reading data: (passed, violations, detail).
    known: tuple[bool, int, str] | None = None
    # Violations from the number of rows instead of row conditions.
    of_rows: Callable[[Column], Column] | None = None
    # Counts rows that repeat an earlier one.
    repeats: bool = False
    # The columns whose bad values a label speaks of, where they are not the label itself.
    shows: dict[str, Sequence[str]] = field(default_factory=dict)


def _number(column: str) -> Column:
    """The column as a number; text that is none becomes null and breaks the rule."""
    return F.col(f"`{column}`").try_cast("double")


def not_in(column: str, *allowed: int) -> Column:
    return violates(_number(column).isin(*[float(a) for a in allowed]))


def outside(column: str, low: float, high: float) -> Column:
    return violates(_number(column).between(low, high))


def negative(column: str) -> Column:
    """Null is not negative."""
    return _number(column) < 0


#: Conditions packed into one number while equal rows are counted.
_BITS = 60


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Evaluate all checks with one pass over the data.

    Looking for repeated rows needs them side by side. Rows are told apart by a 128-bit
    hash of all columns and carry their broken rules as bits, so the shuffle moves a few
    numbers of a row, not the row; the bits of equal rows are the same.
    """
    conditions: dict[tuple[int, str], Column] = {}
    absent = [[c for c in check.needs if c not in df.columns] for check in checks]
    for i, check in enumerate(checks):
        if check.known is None and not absent[i]:
            conditions.update({(i, label): bad for label, bad in check.broken.items()})
    if any(c.repeats for c in checks):
        df, weight = _distinct_rows(df, list(conditions.values()))
        conditions = {key: _bit(n) for n, key in enumerate(conditions)}
        counts = {key: F.coalesce(F.sum(F.when(bad, weight)), F.lit(0)) for key, bad in conditions.items()}
        rows = F.coalesce(F.sum(weight), F.lit(0))
        repeated = F.coalesce(F.sum(weight - 1), F.lit(0))
    else:
        counts = {key: F.count_if(bad) for key, bad in conditions.items()}
        rows, repeated = F.count(F.lit(1)), F.lit(0)
    found = [
        _row(i, c, absent[i], {k[1]: n for k, n in counts.items() if k[0] == i}, rows, repeated)
        for i, c in enumerate(checks)
    ]
    return (
        df.agg(F.array(*found).alias("_checks"))
        .select(F.explode("_checks").alias("_check"))
        .select("_check.*")
    )


def bad_value_counts(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """What breaks the checks: ``position, check, label, columns, values, rows``.

    One row for each distinct bad value of each rule, all of them, with the number of
    rows that hold it. ``values`` are the rule's columns as text, null where the value
    is missing. The table is read once; a row goes out once for each rule it breaks, and
    equal values are counted before the shuffle. Rules on the whole table, on repeated
    rows or on absent columns have no value to show and no row here.
    """
    found = []
    for i, check in enumerate(checks):
        if check.known is not None or any(c not in df.columns for c in check.needs):
            continue
        for label, bad in check.broken.items():
            columns = check.shows.get(label, (label.split()[0],))
            columns = [c for c in columns if c in df.columns]
            found.append(F.when(bad, F.struct(
                F.lit(i + 1).alias("position"), F.lit(check.name).alias("check"),
                F.lit(label).alias("label"),
                F.array(*[F.lit(c) for c in columns]).cast("array<string>").alias("columns"),
                F.array(*[F.col(f"`{c}`").cast("string") for c in columns])
                .cast("array<string>").alias("values"),
            )))
    if not found:
        none = df.limit(0).select(F.lit(0).alias("position"))
        return none.selectExpr("position", "'' as check", "'' as label",
                               "array('') as columns", "array('') as values", "0L as rows")
    broken = df.select(F.explode(F.array_compact(F.array(*found))).alias("_v")).select("_v.*")
    return broken.groupBy("position", "check", "label", "columns", "values").agg(
        F.count(F.lit(1)).alias("rows"))


def _bit(n: int) -> Column:
    return F.shiftright(F.col(f"_bits{n // _BITS}"), n % _BITS).bitwiseAND(F.lit(1)) == 1


def _distinct_rows(df: DataFrame, conditions: Sequence[Column]) -> tuple[DataFrame, Column]:
    """Distinct rows as bits of ``conditions``, and how often each comes."""
    packed = {}
    for start in range(0, max(1, len(conditions)), _BITS):
        bits = F.lit(0).cast("bigint")
        for k, bad in enumerate(conditions[start : start + _BITS]):
            set_ = F.when(bad, F.lit(1 << k)).otherwise(F.lit(0)).cast("bigint")
            bits = bits.bitwiseOR(set_)
        packed[f"_bits{start // _BITS}"] = bits
    hashed = df.select(
        *row_hash(df.columns), *[bits.alias(name) for name, bits in packed.items()]
    )
    copies = hashed.groupBy(*ROW_HASH).agg(
        F.count(F.lit(1)).alias("_copies"), *[F.max(name).alias(name) for name in packed]
    )
    return copies, F.col("_copies")


def _row(position: int, check: Check, absent: Sequence[str], counts: dict[str, Column], rows: Column,
         repeated: Column) -> Column:
    if check.known is not None:
        passed, bad, detail = check.known
        result = (F.lit(passed), F.lit(bad), F.lit(detail))
    elif absent:
        result = (F.lit(False), F.lit(len(absent)), F.lit(f"missing: {', '.join(absent)}"))
    elif check.repeats:
        detail = F.when(repeated == 0, F.lit(check.ok)).otherwise(
            F.format_string("%d duplicate row(s) found", repeated))
        result = (repeated == 0, repeated, detail)
    elif check.of_rows is not None:
        bad = check.of_rows(rows)
        expected = f"{check.ok}, " if check.ok.startswith("expected") else ""
        detail = F.when(bad == 0, F.lit(check.ok)).otherwise(
            F.format_string(f"{expected}found %,d", rows))
        result = (bad == 0, bad, detail)
    else:
        total = sum(counts.values(), F.lit(0).cast("bigint"))
        found = F.concat_ws("; ", *[
            F.when(n > 0, F.format_string(f"{_plain(label)}: %d", n)) for label, n in counts.items()
        ])
        detail = F.when(total == 0, F.lit(check.ok)).otherwise(found)
        result = (total == 0, total, detail)
    passed, bad, detail = result
    return F.struct(
        F.lit(position + 1).alias("position"),
        F.lit(check.name).alias("check"),
        passed.alias("passed"),
        bad.cast("bigint").alias("violations"),
        detail.alias("detail"),
    )


def _plain(label: str) -> str:
    return label.replace("%", "%%")


_NO_REPEATS = Check("No duplicate rows", repeats=True, ok="0 duplicates")


def _required(df: DataFrame, name: str, columns: Sequence[str]) -> Check:
    absent = [c for c in columns if c not in df.columns]
    detail = f"missing: {', '.join(absent)}" if absent else "all expected columns found"
    return Check(name, known=(not absent, len(absent), detail))


def _is_numeric(df: DataFrame, column: str) -> bool:
    kind = dict(df.dtypes)[column]
    return kind.startswith(("tinyint", "smallint", "int", "bigint", "float", "double",
                            "decimal", "boolean"))


def _not_finite(column: str) -> dict[str, Column]:
    value = F.col(f"`{column}`").cast("double")
    return {
        f"{column} inf": F.abs(value) == float("inf"),
        f"{column} nan": value.isNull() | F.isnan(value),
    }


def final_rules(df: DataFrame, expected_rows: int = 100_000) -> list[Check]:
    """The rules of the suite for the model dataset: twelve checks."""
    present = [c for c in REQUIRED_COLUMNS if c in df.columns]
    numeric = [c for c in present if _is_numeric(df, c)]
    wrong_type = [c for c in present if c not in numeric]
    finite: dict[str, Column] = {}
    for c in numeric:
        finite.update(_not_finite(c))
    return [
        _required(df, "Required columns present", REQUIRED_COLUMNS),
        Check("'is_fraud' target column exists and is binary",
              {"values other than 0/1": not_in(S.TARGET, 0, 1)} if S.TARGET in df.columns else {},
              needs=[S.TARGET], ok="contains only 0/1",
              shows={"values other than 0/1": [S.TARGET]}),
        Check("Row count matches expected dataset size",
              of_rows=lambda n: F.abs(n - expected_rows), ok=f"expected {expected_rows:,}"),
        _NO_REPEATS,
        Check("No missing values", {c: missing(c, kind) for c, kind in df.dtypes},
              ok="0 missing values"),
        Check("Numeric feature columns have numeric dtypes",
              known=(not wrong_type, len(wrong_type),
                     f"non-numeric: {', '.join(wrong_type)}" if wrong_type
                     else "all numeric columns correctly typed")),
        Check("Numeric columns contain only finite, valid values", finite, ok="no inf/NaN found"),
        Check("Values within expected ranges",
              {c: outside(c, *RANGES[c]) for c in RANGES if c in df.columns},
              ok="all within range"),
        Check("Binary flag columns contain only 0/1",
              {c: not_in(c, 0, 1) for c in BINARY_COLUMNS if c in df.columns},
              ok="all binary flags valid"),
        Check("No unexpected negative values",
              {c: negative(c) for c in NON_NEGATIVE_COLUMNS if c in df.columns},
              ok="no negative values"),
        _group_check("Location-change features internally valid", df, S.LOCATION_COLUMNS,
                     S.LOCATION_COLUMNS[:2] + S.LOCATION_COLUMNS[3:4],
                     ["location_changed", "rapid_location_change"]),
        _group_check("Transaction-amount anomaly features internally valid", df, S.AMOUNT_COLUMNS,
                     S.AMOUNT_COLUMNS[:3], ["large_transaction_flag"]),
    ]


def final_checks(df: DataFrame, expected_rows: int = 100_000) -> DataFrame:
    """The suite for the model dataset."""
    return run_checks(df, final_rules(df, expected_rows))


def _group_check(name, df, needs, never_negative, binary) -> Check:
    if not set(needs) <= set(df.columns):
        return Check(name, needs=needs)
    broken = {f"{c} has negative values": negative(c) for c in never_negative}
    broken |= {f"{c} has non-binary values": not_in(c, 0, 1) for c in binary}
    shows = {label: [label.split()[0]] for label in broken}
    return Check(name, broken, ok="all checks passed", shows=shows)


def behaviour_rules(df: DataFrame) -> list[Check]:
    """The rules of the suite for timing and frequency features: eleven checks."""
    have = set(df.columns)
    present = [c for c in S.BEHAVIOUR_COLUMNS if c in have]
    counts = [c for c in COUNT_COLUMNS if c in have]
    return [
        _required(df, "Required behavioral columns present", S.BEHAVIOUR_COLUMNS),
        _NO_REPEATS,
        Check("No missing values in behavioral columns",
              {c: missing(c, kind) for c, kind in df.dtypes if c in present},
              ok="0 missing values"),
        Check("Binary behavioral flags contain only 0/1",
              {c: not_in(c, 0, 1) for c in BEHAVIOUR_FLAGS if c in have}, ok="all valid"),
        _night_check(have),
        Check("Timing feature values within expected ranges",
              {c: outside(c, 0, top)
               for c, top in (("customer_hist_avg_hour", 23), ("hour_deviation_from_normal", 12))
               if c in have}, ok="all within range"),
        Check("Transaction frequency/velocity values are non-negative",
              {c: negative(c) for c in [*counts, "transaction_velocity_per_min"] if c in have},
              ok="all non-negative"),
        Check("Transaction count columns contain whole numbers",
              {c: F.coalesce(F.col(c).cast("double") % 1 != 0, F.lit(True)) for c in counts},
              ok="all whole numbers"),
        _formula("Trailing windows are properly nested (5min <= 30min <= 60min)", have,
                 COUNT_COLUMNS, lambda: {
                     "5min count > 30min count":
                         F.col("txn_count_last_5min") > F.col("txn_count_last_30min"),
                     "30min count > 60min count":
                         F.col("txn_count_last_30min") > F.col("txn_count_last_60min"),
                 }),
        _formula("transaction_velocity_per_min matches formula (60min count / 60)", have,
                 ["txn_count_last_60min", "transaction_velocity_per_min"], lambda: {
                     "mismatched rows": violates(
                         F.round(F.col("txn_count_last_60min") / 60.0, 6)
                         == F.round("transaction_velocity_per_min", 6))
                 }),
        _formula("rapid_transaction_flag matches 5-minute rule", have,
                 ["txn_count_last_5min", "rapid_transaction_flag"], lambda: {
                     "mismatched rows": violates(
                         F.coalesce(F.col("txn_count_last_5min") >= 1, F.lit(False)).cast("int")
                         == F.col("rapid_transaction_flag"))
                 }),
    ]


def behaviour_checks(df: DataFrame) -> DataFrame:
    """The suite for timing and frequency features."""
    return run_checks(df, behaviour_rules(df))


def _night_check(have: set[str]) -> Check:
    name = "night_transaction matches trans_hour window (22:00-05:59)"
    if not {"trans_hour", "night_transaction"} <= have:
        return Check(name, known=(True, 0, "skipped: trans_hour not present in this file"))
    night = F.coalesce((F.col("trans_hour") >= 22) | (F.col("trans_hour") < 6), F.lit(False))
    return Check(name, {"mismatched rows": violates(night.cast("int") == F.col("night_transaction"))},
                 ok="matches for all rows",
                 shows={"mismatched rows": ["trans_hour", "night_transaction"]})


def _formula(name: str, have: set[str], needs: Sequence[str], broken) -> Check:
    if not set(needs) <= have:
        return Check(name, needs=needs)
    rules = broken()
    return Check(name, rules, ok="holds for all rows", shows={label: needs for label in rules})


def readiness_checks(df: DataFrame) -> DataFrame:
    """The gate before modelling: five checks, four without a target column."""
    target = S.TARGET in df.columns
    checks = [
        Check("Dataset is not empty", of_rows=lambda n: F.when(n > 0, 0).otherwise(1)),
        Check("Target column exists", known=(target, int(not target), "")),
        _NO_REPEATS,
        Check("No missing values", {c: missing(c, kind) for c, kind in df.dtypes}),
    ]
    if target:
        # A missing target is the business of the check before.
        checks.append(Check("Target contains only 0/1",
                            {"values other than 0/1": ~F.col(S.TARGET).isin(0, 1)}))
    return run_checks(df, checks)


def feature_group_presence(df: DataFrame) -> DataFrame:
    """Which columns of each summary group a table has."""
    rows = [(group, len(names), [c for c in names if c in df.columns],
             [c for c in names if c not in df.columns])
            for group, names in SUMMARY_GROUPS.items()]
    return df.sparkSession.createDataFrame(
        rows, "feature_group string, expected int, found array<string>, missing array<string>"
    )


def verdict(checks: DataFrame) -> DataFrame:
    """One row: did all checks pass, and how many did not."""
    return checks.agg(
        F.bool_and("passed").alias("all_passed"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.count(F.lit(1)).alias("checks"),
    )


def check_lines(checks: DataFrame) -> DataFrame:
    """One line of text per check."""
    status = F.when(F.col("passed"), "PASS").otherwise("FAIL")
    line = F.format_string("  [%s] %s", status, F.col("check"))
    detail = F.when(F.col("detail") != "", F.concat(F.lit(" — "), F.col("detail")))
    return checks.select("position", F.concat(line, F.coalesce(detail, F.lit(""))).alias("line"))


def validation_values(df: DataFrame) -> DataFrame:
    """Sanity counts and match rates of the cleaned table: ``position, check, value``."""
    rates = {
        "Transaction_Time matches real timestamp (rate)":
            match_rate(hour_minute(F.col(S.TIME)), F.col("Transaction_Time")),
        "Customer_Age matches dob-derived age (rate)":
            match_rate(year_gap(F.col(S.TIME), F.col("dob")), F.col("Customer_Age")),
    }
    counts = {
        "amt <= 0": F.col(S.AMOUNT) <= 0,
        "Customer_Age outside 0-120": outside("Customer_Age", 0, 120),
        "Customer_Satisfaction_Score outside 1-10": outside("Customer_Satisfaction_Score", 1, 10),
        "lat outside -90..90": outside("lat", -90, 90),
        "long outside -180..180": outside("long", -180, 180),
        "is_fraud not in {0,1}": not_in(S.TARGET, 0, 1),
        "gender not in {M,F}": violates(F.col("gender").isin("M", "F")),
    }
    values = [(n, F.count_if(bad).cast("double")) for n, bad in counts.items()]
    repeated = len(values) + 1
    places = [*range(1, repeated), repeated + 1, repeated + 2]
    values += [(n, F.round(rate, 4)) for n, rate in rates.items()]
    rows = F.array(*[
        F.struct(F.lit(p).alias("position"), F.lit(n).alias("check"), v.alias("value"))
        for p, (n, v) in zip(places, values)
    ])
    one_pass = df.agg(rows.alias("_rows")).select(F.explode("_rows").alias("_r")).select("_r.*")
    copies = duplicate_keys(df, [S.TXN]).select(
        F.lit(repeated).alias("position"), F.lit("duplicate trans_num").alias("check"),
        F.col("duplicates").cast("double").alias("value"),
    )
    return one_pass.unionByName(copies)
