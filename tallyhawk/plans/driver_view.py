"""The given ``events`` table seen as raw card transactions.

Every column is an expression over the row, so filters and column pruning reach
the Parquet scan. ``SQL`` is the same view for the SQL side of the checks.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhawk.session import prepare

# Levels in the order of the generated codes.
CATEGORIES = [
    "shopping_net", "grocery_pos", "misc_net", "shopping_pos", "gas_transport",
    "misc_pos", "entertainment", "grocery_net", "personal_care", "home", "travel",
    "health_fitness", "kids_pets", "food_dining",
]

_CATEGORY = (
    "case event_id%14 "
    + " ".join(f"when {i} then '{c}'" for i, c in enumerate(CATEGORIES[:-1]))
    + f" else '{CATEGORIES[-1]}' end"
)

# Name -> expression that means the same in both engines.
_COLUMNS = {
    "Unnamed: 0": "event_id",
    "trans_num": "cast(event_id as string)",
    "trans_date_trans_time": "ts",
    "unix_time": "{unix}",
    "cc_num": "cast(4000000000000000+user_id as string)",
    "dob": "{dob}",
    "amt": "value",
    "merchant": "' fraud_M'||cast(event_id%50 as string)||' '",
    "first": "' First'||cast(user_id as string)",
    "last": "'Last'||cast(user_id as string)||' '",
    "street": "cast(user_id as string)||' Main St'",
    "city": "'City'||cast(user_id%40 as string)",
    "job": "'Job'||cast(user_id%30 as string)",
    "category": _CATEGORY,
    "gender": "case when user_id%2=0 then 'M' else 'F' end",
    "state": "case user_id%6 when 0 then ' ca' when 1 then 'NY ' when 2 then 'tx' "
             "when 3 then 'WA' when 4 then 'FL' else 'AK' end",
    "zip": "user_id*61%99999",
    "lat": "25+(user_id*37%2400)/100e0",
    "long": "-124+(user_id*53%5700)/100e0",
    "merch_lat": "25+(user_id*37%2400)/100e0+((event_id*7919)%201-100)/100e0",
    "merch_long": "-124+(user_id*53%5700)/100e0+((event_id*104729)%201-100)/100e0",
    "merch_zipcode": "case when event_id%7=0 then null "
                     "else cast((user_id*37+event_id*7919)%99999 as double) end",
    "city_pop": "user_id*997%100000",
    "Customer_Age": "18+event_id*7%60",
    "Transaction_Time": "case when event_id%50=0 then {hm} else '12:00' end",
    "Merchant_Category": "case event_id%4 when 0 then 'Travel ' when 1 then 'Groceries' "
                         "when 2 then 'Electronics' else 'Clothing' end",
    "Customer_Satisfaction_Score": "event_id%10+1",
    "Loyalty_Points_Earned": "event_id*13%100",
    "Transaction_Type": "case when event_id%2=0 then 'Online' else 'In-store' end",
    "Payment_Method": "case event_id%3 when 0 then 'Credit Card' when 1 then 'Debit Card' "
                      "else 'Mobile Payment' end",
    "is_fraud": "case when {k}<2 or (value>150 and {k}<20) then 1 else 0 end",
}
_SPARK = {
    "unix": "unix_seconds(cast(ts as timestamp))",
    "dob": "date_add(date'1950-01-01', cast(user_id*211%18000 as int))",
    "hm": "date_format(ts,'HH:mm')",
    "k": "cast(get_json_object(props,'$.k') as int)",
}
_DUCK = {
    "unix": "cast(floor(epoch(ts)) as bigint)",
    "dob": "date '1950-01-01'+cast(user_id*211%18000 as int)",
    "hm": "strftime(ts,'%H:%M')",
    "k": "cast(json_extract_string(props,'$.k') as int)",
}

COLUMNS = list(_COLUMNS)

RAW_SQL = "raw as (select {} from events)".format(
    ", ".join(f'{e.format(**_DUCK)} as "{n}"' for n, e in _COLUMNS.items())
)

_STRIPPED = ("merchant", "first", "last", "gender", "street", "city", "state", "job",
             "category", "Merchant_Category", "Transaction_Type", "Payment_Method")


def _clean_expression(name: str) -> str:
    quoted = f'"{name}"'
    if name == "state":
        return f"upper(trim({quoted}))"
    if name in _STRIPPED:
        return f"trim({quoted})"
    if name == "zip":
        return "case when length(cast(zip as varchar))<5 then lpad(cast(zip as varchar),5,'0') " \
               "else cast(zip as varchar) end"
    if name == "merch_zipcode":
        text = "cast(cast(merch_zipcode as bigint) as varchar)"
        return f"case when length({text})<5 then lpad({text},5,'0') else {text} end"
    return quoted


# The view after cleaning. It has no repeated rows, so cleaning keeps them all.
TXN_SQL = "txn as (select {} from raw)".format(
    ", ".join(f'{_clean_expression(n)} as "{n}"' for n in COLUMNS if n != "Unnamed: 0")
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select(
        *[F.expr(e.format(**_SPARK)).alias(n) for n, e in _COLUMNS.items()]
    )


def with_raw(body: str, *more: str) -> str:
    """A query over ``raw``, with further named parts."""
    return f"with {', '.join([RAW_SQL, *more])} {body}"


def with_txn(body: str, *more: str) -> str:
    """A query over ``txn``, with further named parts."""
    return f"with {', '.join([RAW_SQL, TXN_SQL, *more])} {body}"
