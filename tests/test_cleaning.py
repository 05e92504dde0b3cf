import datetime as dt

from pyspark.sql import Row, functions as F

from tallyhawk.functions import clock, geo, numbers, text
from tallyhawk.operators import cleaning as C
from tallyhawk.plans.driver_view import raw_transactions
from tallyhawk.plans.queries_clean import with_copies
from tests.helpers import km


def one(spark, value, kind, make):
    return spark.createDataFrame([(value,)], f"v {kind}").select(make(F.col("v"))).first()[0]


def test_text_rules(spark):
    assert one(spark, "\t a b　\n", "string", text.strip_space) == "a b"
    pad = lambda c: text.zero_pad(c, 5)
    assert one(spark, 123, "bigint", pad) == "00123"
    assert one(spark, "1234567", "string", pad) == "1234567"
    assert one(spark, None, "string", pad) is None
    assert one(spark, 2114.0, "double", lambda c: text.whole_number_code(c, 5)) == "02114"
    assert one(spark, "customer_avg_amt", "string", text.title_words) == "Customer Avg Amt"
    assert one(spark, 0.00598, "double", text.percent) == "0.598%"
    assert one(spark, 1234567, "bigint", text.thousands) == "1,234,567"
    for value, shown in ((0.0007, "0.0007"), (0.017, "0.017"), (1.0, "1.0"), (2e9, "2000000000.0")):
        assert one(spark, value, "double", lambda c: text.plain_number(c, 4)) == shown


def test_clock_rules(spark):
    ts = dt.datetime(2025, 1, 6, 3, 15)  # a Monday
    df = spark.createDataFrame([(ts, dt.date(2000, 1, 7))], "ts timestamp_ntz, dob date")
    row = df.select(
        F.weekday("ts"), clock.is_weekend(F.col("ts")), clock.age_years(F.col("ts"), F.col("dob")),
        clock.hour_minute(F.col("ts")), clock.year_gap(F.col("ts"), F.col("dob")),
        clock.hour_within(F.hour("ts"), 22, 6), clock.hour_within(F.hour("ts"), 0, 3),
    ).first()
    # 9,131 days are 25 years of 365 days, though the birthday is a day away.
    assert tuple(row) == (0, 0, 25, "03:15", 25, 1, 0)


def test_distances(spark):
    df = spark.createDataFrame(
        [("35.7796", -78.6382, 40.7128, -74.0060), ("bad", None, 35.0, -78.0),
         ("35.0", -78.0, 35.0, -78.0), ("0", 0.0, 0.0, 180.0)],
        "a string, b double, c double, d double")
    rows = [r[0] for r in df.select(geo.safe_haversine_km(*[F.col(x) for x in "abcd"])).collect()]
    assert 650 <= rows[0] <= 750 and abs(rows[0] - km(35.7796, -78.6382, 40.7128, -74.006)) < 1e-9
    assert rows[1:3] == [0.0, 0.0] and abs(rows[3] - 20015.0868) < 1e-3
    assert df.select(geo.haversine_km(F.lit(None).cast("double"), *[F.col(x) for x in "bcd"])).first()[0] is None


def test_flags_treat_unknown_as_specified(spark):
    df = spark.createDataFrame([(None,), (1,), (5,)], "v int")
    assert [r[0] for r in df.select(numbers.violates(F.col("v").between(0, 2))).collect()] == [
        True, False, True]
    assert [r[0] for r in df.select(numbers.flag(F.col("v") < 2)).collect()] == [0, 1, 0]


def test_clean_keeps_the_first_of_copies(spark, sf_dir):
    raw = raw_transactions(spark, sf_dir)
    copied = with_copies(raw)
    assert copied.count() > raw.count()
    cleaned = C.clean(copied.orderBy(F.rand(1)))
    assert cleaned.count() == raw.count()
    assert "Unnamed: 0" not in cleaned.columns
    first = cleaned.orderBy(F.col("trans_num").cast("bigint")).first()
    assert (first.state, len(first.zip), first.merchant[0]) == (first.state.strip().upper(), 5, "f")
    amounts = raw.select("trans_num", "amt").exceptAll(cleaned.select("trans_num", "amt"))
    assert amounts.isEmpty()


def test_copies_collapse_before_the_shuffle(spark, sf_dir):
    plan = C.first_per_key(raw_transactions(spark, sf_dir), "trans_num", ["Unnamed: 0"])
    text_plan = plan._jdf.queryExecution().executedPlan().toString()
    assert text_plan.count("WindowGroupLimit") == 2 and "Partial" in text_plan


def test_clean_without_numbers_drops_exact_copies(spark, sf_dir):
    raw = raw_transactions(spark, sf_dir).drop("trans_num")
    assert C.clean(raw.union(raw)).count() == raw.drop("Unnamed: 0").distinct().count()


def test_bad_times_become_null(spark):
    df = spark.createDataFrame([Row(trans_date_trans_time="2025-01-01 10:00:00", dob="1980-02-03"),
                                Row(trans_date_trans_time="soon", dob="")])
    rows = C.parse_times(df).collect()
    assert rows[0] == Row(trans_date_trans_time=dt.datetime(2025, 1, 1, 10), dob=dt.date(1980, 2, 3))
    assert tuple(rows[1]) == (None, None)


def test_duplicate_counts(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), (None, 1), (None, 1)], "k string, v int")
    assert C.duplicate_rows(df).first()[0] == 2
    assert C.duplicate_keys(df, ["k"]).first()[0] == 3
    assert {r[0] for r in C.bad_values(df, "k", F.col("k") == "b").collect()} == {"a", None}
