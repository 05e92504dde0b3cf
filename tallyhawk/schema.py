"""Column names and types of the raw table and of the model dataset."""

from __future__ import annotations

from pyspark.sql import types as T

CARD = "cc_num"
TXN = "trans_num"
TIME = "trans_date_trans_time"
AMOUNT = "amt"
TARGET = "is_fraud"

# Raw column order and the type each column has after reading.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("Unnamed: 0", T.LongType()),
        T.StructField("trans_num", T.StringType()),
        T.StructField("trans_date_trans_time", T.StringType()),
        T.StructField("unix_time", T.LongType()),
        T.StructField("cc_num", T.StringType()),
        T.StructField("dob", T.StringType()),
        T.StructField("amt", T.DoubleType()),
        T.StructField("merchant", T.StringType()),
        T.StructField("first", T.StringType()),
        T.StructField("last", T.StringType()),
        T.StructField("street", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("job", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("zip", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("long", T.DoubleType()),
        T.StructField("merch_lat", T.DoubleType()),
        T.StructField("merch_long", T.DoubleType()),
        T.StructField("merch_zipcode", T.DoubleType()),
        T.StructField("city_pop", T.LongType()),
        T.StructField("Customer_Age", T.IntegerType()),
        T.StructField("Transaction_Time", T.StringType()),
        T.StructField("Merchant_Category", T.StringType()),
        T.StructField("Customer_Satisfaction_Score", T.IntegerType()),
        T.StructField("Loyalty_Points_Earned", T.IntegerType()),
        T.StructField("Transaction_Type", T.StringType()),
        T.StructField("Payment_Method", T.StringType()),
        T.StructField("is_fraud", T.IntegerType()),
    ]
)

# Column groups of the cleaning and pruning steps.
INDEX_COLUMN = "Unnamed: 0"
TEXT_COLUMNS = [
    "merchant", "first", "last", "gender", "street", "city", "state", "job",
    "category", "Merchant_Category", "Transaction_Type", "Payment_Method",
]
UNRELIABLE_COLUMNS = ["Transaction_Time", "Customer_Age", "Merchant_Category"]
IDENTIFIER_COLUMNS = [
    "trans_num", "unix_time", "first", "last", "street", "job", "city", "merchant",
]
CONSUMED_COLUMNS = [
    "cc_num", "trans_date_trans_time", "dob", "zip", "merch_zipcode",
    "merch_zipcode_missing",
]

# Column groups of the model dataset, in model order.
BASE_COLUMNS = [
    "amt", "gender", "lat", "long", "city_pop", "merch_lat", "merch_long",
    "Customer_Satisfaction_Score", "Loyalty_Points_Earned",
]
TEMPORAL_COLUMNS = [
    "customer_age", "trans_hour", "trans_day_of_week", "trans_month", "is_weekend",
]
GEO_COLUMNS = ["customer_merchant_distance_km"]
CUSTOMER_COLUMNS = ["customer_txn_count", "customer_avg_amt", "amt_vs_customer_avg"]
LOCATION_COLUMNS = [
    "prev_trans_distance_km", "hours_since_prev_trans", "location_changed",
    "implied_travel_speed_kmh", "rapid_location_change",
]
AMOUNT_COLUMNS = [
    "customer_hist_avg_amt", "customer_hist_std_amt", "amount_ratio_to_normal",
    "customer_relative_amount_deviation", "large_transaction_flag",
]
TIMING_COLUMNS = [
    "night_transaction", "customer_hist_avg_hour", "hour_deviation_from_normal",
    "unusual_transaction_hour",
]
FREQUENCY_COLUMNS = [
    "txn_count_last_5min", "txn_count_last_30min", "txn_count_last_60min",
    "transaction_velocity_per_min", "rapid_transaction_flag",
]
BEHAVIOUR_COLUMNS = TIMING_COLUMNS + FREQUENCY_COLUMNS

# Levels of the one-hot columns, sorted; the first is the baseline.
CATEGORY_LEVELS = [
    "entertainment", "food_dining", "gas_transport", "grocery_net", "grocery_pos",
    "health_fitness", "home", "kids_pets", "misc_net", "misc_pos", "personal_care",
    "shopping_net", "shopping_pos", "travel",
]
STATE_LEVELS = [
    "AK", "AL", "AR", "AZ", "CA", "CO", "CT", "DC", "FL", "GA", "HI", "IA", "ID",
    "IL", "IN", "KS", "KY", "LA", "MA", "MD", "ME", "MI", "MN", "MO", "MS", "MT",
    "NC", "ND", "NE", "NH", "NJ", "NM", "NV", "NY", "OH", "OK", "OR", "PA", "RI",
    "SC", "SD", "TN", "TX", "UT", "VA", "VT", "WA", "WI", "WV", "WY",
]
MODEL_LEVELS = {
    "category": CATEGORY_LEVELS,
    "state": STATE_LEVELS,
    "Transaction_Type": ["In-store", "Online"],
    "Payment_Method": ["Credit Card", "Debit Card", "Mobile Payment"],
}
ENCODED_COLUMNS = list(MODEL_LEVELS)

NUMERIC_FEATURES = (
    BASE_COLUMNS + TEMPORAL_COLUMNS + GEO_COLUMNS + CUSTOMER_COLUMNS
    + LOCATION_COLUMNS + AMOUNT_COLUMNS + BEHAVIOUR_COLUMNS
)
DUMMY_FEATURES = [
    f"{column}_{level}" for column, levels in MODEL_LEVELS.items() for level in levels[1:]
]
MODEL_FEATURES = NUMERIC_FEATURES + DUMMY_FEATURES
