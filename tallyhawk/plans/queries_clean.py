"""Queries on sources, scalar functions, cleaning, duplicates and imputation."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F, types as T

from tallyhawk import schema as S
from tallyhawk.functions import clock, geo, numbers, text
from tallyhawk.operators import cleaning as C
from tallyhawk.operators.impute import fill_merchant_zip, flag_missing_zip, split_by_zip
from tallyhawk.plans import history_sql as H
from tallyhawk.plans.dataset import dataset_from_raw
from tallyhawk.plans.driver_view import COLUMNS, TXN_SQL, raw_transactions, with_raw, with_txn
from tallyhawk.plans.queries_history import clean_view
from tallyhawk.plans.registry import Query, round_sql, rounded
from tallyhawk.session import new_folder, prepare
from tallyhawk.sources import reports, tables

# Some rows come three times: as they are, as a copy and as a changed copy.
COPIED_SQL = """copied as (
  select raw.* replace ("Unnamed: 0"+c*1000000000 as "Unnamed: 0",
    case when c=2 then amt+1 else amt end as amt)
  from raw join (values (0),(1),(2)) t(c) on c=0 or "Unnamed: 0"%100=0)"""


def with_copied(body: str) -> str:
    return with_raw(body, COPIED_SQL)


# The first row of each number, as cleaning leaves it.
_FIRST_SQL = """first_raw as (select * from copied
  qualify row_number() over (partition by trans_num order by "Unnamed: 0")=1)"""


def with_copied_txn(body: str, *more: str) -> str:
    """A query over ``txn``, cleaned from the copied rows."""
    cleaned = TXN_SQL.replace(" from raw)", " from first_raw)")
    return with_raw(body, COPIED_SQL, _FIRST_SQL, cleaned, *more)


def with_copies(df):
    copies = F.expr("case when `Unnamed: 0`%100=0 then array(0,1,2) else array(0) end")
    return df.withColumn("_c", F.explode(copies)).withColumns(
        {"Unnamed: 0": F.col("Unnamed: 0") + F.col("_c") * 1_000_000_000,
         "amt": F.when(F.col("_c") == 2, F.col("amt") + 1).otherwise(F.col("amt"))}
    ).drop("_c")


def _copied(spark, sf_dir):
    return with_copies(raw_transactions(spark, sf_dir))


def _sql_list(columns) -> str:
    return ", ".join(f'"{c}"' for c in columns)


_KEPT = [c for c in COLUMNS if c != S.INDEX_COLUMN]
# Columns whose type after cleaning is text, number or date: all but the time.
_SHOWN = [c for c in _KEPT if c != S.TIME]


def _shown(df):
    """All cleaned columns, the time as microseconds."""
    return df.select(*[F.col(f"`{c}`") for c in _SHOWN], clock.micros(F.col(S.TIME)).alias("us"))


_SHOWN_SQL = f"{_sql_list(_SHOWN)}, epoch_us({S.TIME}) as us"


# --- sources ----------------------------------------------------------------


def _csv_raw(spark, sf_dir):
    """Write the raw view as CSV and read it back with the raw schema."""
    path = new_folder(prepare(spark), "raw-csv")
    raw = raw_transactions(spark, sf_dir)
    tables.write_csv(raw.withColumn(S.TIME, F.date_format(S.TIME, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
                     .select(*S.RAW_SCHEMA.fieldNames()), path)
    back = tables.read_raw_csv(spark, path)
    return C.parse_times(back).select(
        clock.micros(F.col(S.TIME)).alias("us"),
        *[F.col(f"`{c}`") for c in S.RAW_SCHEMA.fieldNames() if c != S.TIME])


def _csv_codes(spark, sf_dir):
    """A cleaned table through CSV: codes keep their zeros, nulls stay null."""
    path = new_folder(prepare(spark), "clean-csv")
    df = clean_view(spark, sf_dir).select(S.TXN, S.CARD, "zip", "merch_zipcode", S.AMOUNT)
    tables.write_csv(df, path)
    return tables.read_clean_csv(spark, path, df.schema)


def _guarded(spark, sf_dir):
    events = tables.load_dataset(prepare(spark), os.path.join(sf_dir, "events.parquet"))
    return events.agg(F.count(F.lit(1)).alias("rows"))


def _stage(spark, sf_dir):
    """The cleaned table stored between two steps and loaded again."""
    path = new_folder(prepare(spark), "stage")
    tables.write_stage(clean_view(spark, sf_dir), path)
    return _shown(tables.load_dataset(spark, path))


def _damaged_lines(spark, sf_dir):
    """The raw view as CSV lines, of which some are damaged, read line by line."""
    path = new_folder(prepare(spark), "damaged-csv")
    raw = raw_transactions(spark, sf_dir).select(*_LINE_COLUMNS).withColumn(
        S.TIME, F.date_format(S.TIME, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    line = F.to_csv(F.struct(*[F.col(f"`{c}`") for c in _LINE_COLUMNS]))
    n = F.col(f"`{S.INDEX_COLUMN}`")
    damaged = (
        F.when(n % 50 == 1, F.regexp_replace(line, ",[^,]*$", ""))
        .when(n % 50 == 2, F.concat(line, F.lit(",more")))
        .when(n % 50 == 3, F.regexp_replace(line, "^([^,]*),([^,]*),[^,]*,", "$1,$2x,never,"))
        .otherwise(line)
    )
    raw.select(damaged.alias("value")).write.text(path)
    return tables.read_csv_lines(spark, path, _LINE_SCHEMA, header=False)


_LINE_COLUMNS = [S.INDEX_COLUMN, "city_pop", S.TIME, S.AMOUNT, S.TARGET]
_LINE_SCHEMA = T.StructType([
    T.StructField(S.INDEX_COLUMN, T.LongType()), T.StructField("city_pop", T.LongType()),
    T.StructField(S.TIME, T.TimestampNTZType()), T.StructField(S.AMOUNT, T.DoubleType()),
    T.StructField(S.TARGET, T.IntegerType()),
])


def _good_lines(spark, sf_dir):
    return tables.good_rows(_damaged_lines(spark, sf_dir)).withColumn(
        S.TIME, clock.micros(F.col(S.TIME)))


def _rejected_lines(spark, sf_dir):
    """The rejected lines, stored with their reason and read again."""
    path = new_folder(prepare(spark), "rejects")
    tables.write_stage(tables.rejected_rows(_damaged_lines(spark, sf_dir)), path)
    found = spark.read.parquet(path)
    return found.select(F.regexp_extract("line", "^[0-9]+", 0).cast("bigint").alias("id"), "reason",
                        F.array_join("columns", ",").alias("columns"))


def _load_statuses(spark, sf_dir):
    """A table that is there, one without rows and one that is missing."""
    folder = new_folder(prepare(spark), "statuses")
    events = spark.read.parquet(os.path.join(sf_dir, "events.parquet"))
    tables.write_stage(events.where("event_id < 0"), f"{folder}/empty")
    out = tables.load_status(spark, os.path.join(sf_dir, "events.parquet"))
    for name in ("empty", "missing"):
        out = out.unionByName(tables.load_status(spark, f"{folder}/{name}"))
    return out


def _by_card(spark, sf_dir):
    """One card from a table stored by card."""
    path = new_folder(prepare(spark), "by-card")
    tables.write_by_card(raw_transactions(spark, sf_dir).select(
        S.TXN, S.CARD, S.TIME, S.AMOUNT, "category"), path)
    return tables.read_card(spark, path, "4000000000000008").withColumn(
        S.TIME, clock.micros(F.col(S.TIME)))


def _from_raw(spark, sf_dir):
    """From raw rows with copies and missing zips to the model dataset."""
    name = f"stage_{uuid.uuid4().hex}"
    path = new_folder(prepare(spark), "card-stage")
    return rounded(dataset_from_raw(_copied(spark, sf_dir), name, path, keep=_FILLED))


_FILLED = ("merch_zipcode", "merch_zipcode_missing")


# --- projections ------------------------------------------------------------


def _step(step, *columns):
    def build(spark, sf_dir):
        df = raw_transactions(spark, sf_dir).transform(step)
        return df.select(S.TXN, *columns)
    return build


def _times(spark, sf_dir):
    """Times and birth dates that arrive as text."""
    raw = raw_transactions(spark, sf_dir).withColumns(
        {S.TIME: F.col(S.TIME).cast("string"), "dob": F.col("dob").cast("string")})
    return C.parse_times(raw).select(S.TXN, clock.micros(F.col(S.TIME)).alias("us"), "dob")


def _index(spark, sf_dir):
    return _shown(C.drop_index(raw_transactions(spark, sf_dir)))


def _cleaned(spark, sf_dir):
    return _shown(C.clean(_copied(spark, sf_dir)))


def _pruned(spark, sf_dir):
    df = C.prune(clean_view(spark, sf_dir), keep=(S.TXN,))
    return df.withColumn(S.TIME, clock.micros(F.col(S.TIME)))


_PRUNED = [c for c in _KEPT
           if c not in S.UNRELIABLE_COLUMNS and (c == S.TXN or c not in S.IDENTIFIER_COLUMNS)]


def _target_last(spark, sf_dir):
    df = C.drop_consumed(C.prune(clean_view(spark, sf_dir), keep=(S.TXN,)))
    return C.target_last(df.withColumn("gender", numbers.gender_code(F.col("gender"))))


_LAST = [c for c in _PRUNED if c not in (*S.CONSUMED_COLUMNS, "gender")]


def _filters(spark, sf_dir):
    """Fraud rows and small amounts, each with its own mark."""
    df = raw_transactions(spark, sf_dir).select(S.TXN, S.AMOUNT, S.TARGET)
    parts = [("fraud", F.col(S.TARGET) == 1), ("normal", F.col(S.TARGET) == 0),
             ("small", F.col(S.AMOUNT) < 500)]
    out = None
    for name, condition in parts:
        part = df.filter(condition).withColumn("part", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def _numeric(spark, sf_dir):
    return C.numeric_columns(C.drop_index(raw_transactions(spark, sf_dir)))


def _missing(spark, sf_dir):
    df = flag_missing_zip(clean_view(spark, sf_dir))
    return df.select(S.TXN, "merch_zipcode_missing")


def _preview(spark, sf_dir):
    df = clock.add_temporal_features(raw_transactions(spark, sf_dir))
    return C.preview(df, S.TEMPORAL_COLUMNS, S.TXN)


# --- duplicates -------------------------------------------------------------


def _distinct(spark, sf_dir):
    return C.distinct_rows(C.drop_index(_copied(spark, sf_dir))).select(S.TXN, S.AMOUNT)


def _first(spark, sf_dir):
    df = C.first_per_key(_copied(spark, sf_dir), S.TXN, [S.INDEX_COLUMN])
    return df.select(S.INDEX_COLUMN, S.TXN, S.AMOUNT)


def _duplicate_rows(spark, sf_dir):
    return C.duplicate_rows(C.drop_index(_copied(spark, sf_dir)))


def _duplicate_keys(spark, sf_dir):
    return C.duplicate_keys(_copied(spark, sf_dir), [S.TXN])


def _bad_values(spark, sf_dir):
    df = clean_view(spark, sf_dir)
    return C.bad_values(df, "merch_zipcode", F.col("merch_zipcode") >= "50000")


# --- scalar functions -------------------------------------------------------


def _distances(spark, sf_dir):
    df = geo.add_home_distance(raw_transactions(spark, sf_dir))
    return rounded(df.select(S.TXN, "customer_merchant_distance_km"))


def _safe_distances(spark, sf_dir):
    """Distances from text coordinates, some missing and some not numbers."""
    df = raw_transactions(spark, sf_dir)
    lat = F.expr("case when `Unnamed: 0`%7=0 then 'bad' when `Unnamed: 0`%11=0 then null "
                 "else cast(merch_lat as string) end")
    km = geo.safe_haversine_km(F.col("lat"), F.col("long"), lat, F.col("merch_long"))
    return rounded(df.select(S.TXN, km.alias("km")))


def _temporal(spark, sf_dir):
    df = clock.add_temporal_features(raw_transactions(spark, sf_dir))
    night = clock.hour_within(F.col("trans_hour"), 0, 5)
    return df.select(S.TXN, *S.TEMPORAL_COLUMNS, night.alias("night"))


def _clock(spark, sf_dir):
    df = raw_transactions(spark, sf_dir)
    ts, dob = F.col(S.TIME), F.col("dob")
    return df.select(
        S.TXN, clock.hour_minute(ts).alias("hour_minute"), F.year(ts).alias("year"),
        clock.year_gap(ts, dob).alias("year_gap"),
        clock.circular_hours(F.hour(ts), F.month(dob)).alias("hours_apart"),
    )


def _scalars(spark, sf_dir):
    df = clean_view(spark, sf_dir)
    return rounded(df.select(
        S.TXN, numbers.gender_code(F.col("gender")).alias("gender_code"),
        numbers.log_amount(F.col(S.AMOUNT)).alias("amt_log"),
        F.round(F.col(S.AMOUNT) / 7, 4).alias("amt_4"),
    ))


def _formats(spark, sf_dir):
    df = raw_transactions(spark, sf_dir)
    return df.select(
        S.TXN, text.money(F.col(S.AMOUNT)).alias("money"),
        text.thousands(F.col("city_pop") * 1000).alias("thousands"),
        text.percent(F.col(S.AMOUNT) / 777).alias("percent"),
        text.title_words(F.concat(F.lit("customer_"), F.col("category"))).alias("title"),
    )


def _words_sql(column: str) -> str:
    words = f"string_split(replace({column}, '_', ' '), ' ')"
    return f"list_aggregate(list_transform({words}, lambda w: upper(w[1])||w[2:]), 'string_agg', ' ')"


# --- imputation -------------------------------------------------------------


def _imputed(spark, sf_dir):
    df = fill_merchant_zip(clean_view(spark, sf_dir))
    return df.select(S.TXN, "merch_zipcode", "merch_zipcode_missing")


_NEAREST = (
    """places as (select merch_lat, merch_long, min(merch_zipcode) as zip from txn
      where merch_zipcode is not null group by all)""",
    """wanted as (select distinct merch_lat as lat, merch_long as long from txn
      where merch_zipcode is null)""",
    """pairs as (select lat, long, zip,
      (lat-merch_lat)*(lat-merch_lat)+(long-merch_long)*(long-merch_long) as d
      from wanted, places)""",
    "best as (select lat, long, min(d) as d from pairs group by all)",
    """nearest as (select lat, long, min(zip) as zip from pairs join best using (lat, long, d)
      group by all)""",
)
_IMPUTED = """select t.trans_num, coalesce(t.merch_zipcode, n.zip) as merch_zipcode,
      t.merch_zipcode is null as merch_zipcode_missing
    from txn t left join nearest n
      on t.merch_zipcode is null and t.merch_lat=n.lat and t.merch_long=n.long"""
_IMPUTED_SQL = with_txn(_IMPUTED, *_NEAREST)


def _split(spark, sf_dir):
    known, missing = split_by_zip(clean_view(spark, sf_dir))
    return known.select(S.TXN, F.lit("known").alias("part")).unionByName(
        missing.select(S.TXN, F.lit("missing").alias("part")))


def _report(spark, sf_dir):
    return reports.validation_report(clean_view(spark, sf_dir))


def _rates_report(spark, sf_dir):
    return reports.behaviour_report(clean_view(spark, sf_dir))


def _written_report(spark, sf_dir):
    """The fraud-rate report written as text and read back."""
    path = new_folder(prepare(spark), "report")
    reports.write_lines(reports.behaviour_report(clean_view(spark, sf_dir)), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


def _rate_lines(section: int, heading: str, column: str, order: str) -> str:
    return f"""select {section} as section, 0 as place, '{heading}' as line union all
      select {section}, cast(row_number() over (order by {order}) as int),
        printf('- %s: %.3f%%', k, r*100)
      from (select {column} as k, avg(is_fraud) as r from txn group by {column})"""


_RATES_SQL = with_txn(
    "select cast(section as int) as section, cast(place as int) as place, line from ("
    "select 0 as section, 1 as place, '# Customer Behavioral Analysis' as line union all "
    """select 1, 1, printf('Overall fraud rate: %.3f%% (', avg(is_fraud)*100)
      ||format('{:,}', cast(sum(is_fraud) as bigint))||' of '||format('{:,}', count(*))
      ||' transactions)' from txn union all """
    + " union all ".join(
        _rate_lines(i, heading, column, "r desc, k" if falling else "k")
        for i, (heading, column, falling) in enumerate(reports.BEHAVIOUR_SECTIONS, 2)
    )
    + """ union all select 6, 0, '## Fraud rate by hour of day' union all
      select 6, place, line from (
        select cast(row_number() over (order by r desc, h) as int) as place,
          printf('- %d:00 -> %.3f%%', h, r*100) as line
        from (select hour(trans_date_trans_time) as h, avg(is_fraud) as r from txn group by 1))
      where place<=5 union all
      select 7, 0, '## Amount comparison' union all
      select 7, 1, printf('- Average amount on fraud transactions: %.2f',
        avg(amt) filter (where is_fraud=1)) from txn union all
      select 7, 2, printf('- Average amount on normal transactions: %.2f',
        avg(amt) filter (where is_fraud=0)) from txn) l"""
)

_COUNTS = [
    ("amt <= 0", "amt<=0"),
    ("Customer_Age outside 0-120", '"Customer_Age" not between 0 and 120'),
    ("Customer_Satisfaction_Score outside 1-10",
     '"Customer_Satisfaction_Score" not between 1 and 10'),
    ("lat outside -90..90", "lat not between -90 and 90"),
    ("long outside -180..180", "long not between -180 and 180"),
    ("is_fraud not in {0,1}", "is_fraud not in (0,1)"),
    ("gender not in {M,F}", "gender not in ('M','F')"),
]
_RATES = [
    ("Transaction_Time matches real timestamp (rate)",
     "strftime(trans_date_trans_time,'%H:%M')=\"Transaction_Time\""),
    ("Customer_Age matches dob-derived age (rate)",
     'year(trans_date_trans_time)-year(dob)="Customer_Age"'),
]
_REPORT_SQL = with_txn(
    "select 0 as section, 1 as place, '# Data Validation Report' as line union all "
    "select 1, 1, 'Rows validated: '||format('{:,}', count(*)) from txn union all "
    + " union all ".join(
        f"select 2, {i}, '- {name}: '||cast(count(*) filter (where {bad}) as varchar) from txn"
        for i, (name, bad) in enumerate(_COUNTS, 1))
    + " union all select 2, 8, '- duplicate trans_num: '"
      "||cast(count(*)-count(distinct trans_num) as varchar) from txn union all "
    + " union all ".join(
        f"select 2, {i}, '- {name}: '||regexp_replace(cast(cast(round(avg(cast({same} as int)),4) "
        r"as decimal(18,4)) as varchar), '(\.\d+?)0+$', '\1') from txn"
        for i, (name, same) in enumerate(_RATES, 9))
    + "".join(
        f" union all select 3, {i}, '**Note:** {name} {reports.DOUBT}' from txn "
        f"having avg(cast({same} as int))<{reports.RELIABLE_FROM}"
        for i, (name, same) in enumerate(_RATES, 9))
)

_PADDED = "case when length({0})<5 then lpad({0},5,'0') else {0} end"

QUERIES: dict[str, Query] = {
    "IO1_IO4_raw_csv": Query(_csv_raw, with_raw(
        "select epoch_us(trans_date_trans_time) as us, " + ", ".join(
            'cast(zip as varchar) as zip' if c == "zip" else f'"{c}"'
            for c in S.RAW_SCHEMA.fieldNames() if c != S.TIME) + " from raw")),
    "IO2_csv_text_codes": Query(_csv_codes, with_txn(
        "select trans_num, cc_num, zip, merch_zipcode, amt from txn")),
    "IO3_guarded_load": Query(_guarded, "select count(*) as rows from events"),
    "IO1_good_lines": Query(_good_lines, with_raw(
        f"""select "Unnamed: 0", city_pop, epoch_us({S.TIME}) as {S.TIME}, amt, is_fraud from raw
        where "Unnamed: 0"%50 not in (1,2,3)""")),
    "IO1_rejected_lines": Query(_rejected_lines, with_raw(
        f"""select "Unnamed: 0" as id, case when "Unnamed: 0"%50=3 then 'values' else 'fields' end
          as reason, case when "Unnamed: 0"%50=3 then 'city_pop,{S.TIME}' else '' end as "columns"
        from raw where "Unnamed: 0"%50 in (1,2,3)""")),
    "IO3_load_status": Query(_load_statuses, """select 'loaded' as status, count(*) as rows
        from events union all select 'empty', 0 union all select 'missing', 0"""),
    "M12_card_from_stage": Query(_by_card, with_raw(
        f"""select trans_num, cc_num, epoch_us({S.TIME}) as {S.TIME}, amt, category from raw
        where cc_num='4000000000000008'""")),
    "E3_dataset_from_raw": Query(_from_raw, round_sql(with_copied_txn(
        """select m.*, i.merch_zipcode, i.merch_zipcode_missing
        from model m join imputed i using (trans_num)""",
        *H.PARTS, H.MODEL, *_NEAREST, f"imputed as ({_IMPUTED})"), *H.MODEL_FRACTIONS)),
    "IO4_parquet_stage": Query(_stage, with_txn(f"select {_SHOWN_SQL} from txn")),
    "IO5_validation_report": Query(_report, _REPORT_SQL),
    "IO5_fraud_rate_report": Query(_rates_report, _RATES_SQL),
    "IO5_written_report": Query(_written_report, f"select line from ({_RATES_SQL}) x"),
    "P1_drop_index": Query(_index, with_raw(f"select {_SHOWN_SQL} from raw")),
    "P2_parse_times": Query(_times, with_raw(
        f"select trans_num, epoch_us({S.TIME}) as us, dob from raw")),
    "P3_card_as_text": Query(_step(C.card_to_text, S.CARD), with_raw(
        "select trans_num, cc_num from raw")),
    "P4_pad_zip": Query(_step(C.pad_zip, "zip"), with_raw(
        f"select trans_num, {_PADDED.format('cast(zip as varchar)')} as zip from raw")),
    "P5_pad_merchant_zip": Query(_step(C.pad_merchant_zip, "merch_zipcode"), with_raw(
        "select trans_num, "
        f"{_PADDED.format('cast(cast(merch_zipcode as bigint) as varchar)')} as merch_zipcode "
        "from raw")),
    "P6_trim_text": Query(_step(C.trim_text, *S.TEXT_COLUMNS), with_raw(
        "select trans_num, "
        + ", ".join(f'trim("{c}") as "{c}"' for c in S.TEXT_COLUMNS) + " from raw")),
    "P7_upper_state": Query(_step(C.upper_state, "state"), with_raw(
        "select trans_num, upper(state) as state from raw")),
    "P8_clean": Query(_cleaned, with_txn(f"select {_SHOWN_SQL} from txn")),
    "P9_P10_prune": Query(_pruned, with_txn(
        f"select * replace (epoch_us({S.TIME}) as {S.TIME}) from "
        f"(select {_sql_list(_PRUNED)} from txn) p")),
    "P11_P12_target_last": Query(_target_last, with_txn(
        f"select {_sql_list(_LAST)}, {H.GENDER} from txn")),
    "P13_row_filters": Query(_filters, with_raw(
        """select trans_num, amt, is_fraud, 'fraud' as part from raw where is_fraud=1 union all
        select trans_num, amt, is_fraud, 'normal' from raw where is_fraud=0 union all
        select trans_num, amt, is_fraud, 'small' from raw where amt<500""")),
    "P14_numeric_columns": Query(_numeric, with_raw(
        """select unix_time, amt, zip, lat, long, merch_lat, merch_long, merch_zipcode, city_pop,
        "Customer_Age", "Customer_Satisfaction_Score", "Loyalty_Points_Earned", is_fraud
        from raw""")),
    "P15_missing_zip_flag": Query(_missing, with_txn(
        "select trans_num, merch_zipcode is null as merch_zipcode_missing from txn")),
    "P16_preview": Query(_preview, with_txn(
        f"select trans_num, {H.TEMPORAL} from txn order by trans_num limit 5")),
    "D1_distinct_rows": Query(_distinct, with_copied(
        'select trans_num, amt from (select distinct * exclude ("Unnamed: 0") from copied) d')),
    "D2_first_per_key": Query(_first, with_copied(
        """select "Unnamed: 0", trans_num, amt from copied
        qualify row_number() over (partition by trans_num order by "Unnamed: 0")=1""")),
    "D3_duplicate_rows": Query(_duplicate_rows, with_copied(
        """select (select count(*) from copied)
        -(select count(*) from (select distinct * exclude ("Unnamed: 0") from copied))
        as duplicates""")),
    "D4_duplicate_keys": Query(_duplicate_keys, with_copied(
        "select count(*)-count(distinct trans_num) as duplicates from copied")),
    "D5_bad_values": Query(_bad_values, with_txn(
        """select distinct merch_zipcode from txn
        where not coalesce(merch_zipcode>='50000', false)""")),
    "F1_F3_home_distance": Query(_distances, round_sql(with_txn(
        f"select trans_num, {H.HOME} from txn"), "customer_merchant_distance_km")),
    "F2_safe_distance": Query(_safe_distances, round_sql(with_raw(
        "select trans_num, case when \"Unnamed: 0\"%7=0 or \"Unnamed: 0\"%11=0 then 0e0 else "
        f"{H.haversine_sql('lat', 'long', 'merch_lat', 'merch_long')} end as km from raw"), "km")),
    "F4_F9_temporal": Query(_temporal, with_txn(
        f"select trans_num, {H.TEMPORAL}, cast(hour({S.TIME}) between 0 and 4 as int) as night "
        "from txn")),
    "F10_F12_clock": Query(_clock, with_txn(
        f"""select trans_num, strftime({S.TIME},'%H:%M') as hour_minute,
        cast(year({S.TIME}) as int) as year, cast(year({S.TIME})-year(dob) as int) as year_gap,
        cast(least(abs(hour({S.TIME})-month(dob)), 24-abs(hour({S.TIME})-month(dob))) as int)
          as hours_apart from txn""")),
    "F13_F14_F17_scalars": Query(_scalars, round_sql(with_txn(
        """select trans_num, case gender when 'M' then 0 when 'F' then 1 end as gender_code,
        ln(1+amt) as amt_log, round(amt/7,4) as amt_4 from txn"""), "amt_log", "amt_4")),
    "F15_F16_formats": Query(_formats, with_raw(
        f"""select trans_num, printf('%.2f', amt) as money,
        format('{{:,}}', city_pop*1000) as thousands,
        printf('%.3f%%', amt/777*100) as percent,
        {_words_sql("'customer_'||category")} as title from raw""")),
    "J2_J3_fill_merchant_zip": Query(_imputed, _IMPUTED_SQL),
    "J3_known_and_missing": Query(_split, with_txn(
        """select trans_num, case when merch_zipcode is null then 'missing' else 'known' end as part
        from txn""")),
}
