"""Queries on actor activity and on streams."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tallyhawk import schema as S
from tallyhawk.functions.clock import micros
from tallyhawk.operators import activity as A
from tallyhawk.plans import history_sql as H
from tallyhawk.plans.driver_view import raw_transactions, table, with_raw, with_txn
from tallyhawk.plans.registry import Query, round_sql, rounded
from tallyhawk.session import new_folder, prepare
from tallyhawk.sources.commit_log import read_commit_log
from tallyhawk.streaming.bursts import sliding_totals, stream_bursts
from tallyhawk.streaming.dedup import stream_dedup
from tallyhawk.streaming.features import OUTPUT
from tallyhawk.streaming.ordered import end_marker, stream_ordered_features
from tallyhawk.streaming.upsert import read_merged, start_upserts

# Fixed value: the day reports are made on.
AS_OF = dt.date(2024, 1, 30)

_ACTOR = "case when user_id%20=0 then 'ci-Bot-'||cast(user_id as string) " \
         "else 'user'||cast(user_id%40 as string) end"
_DELETED = "event_id%17"
#: Rows of a step of a stream, about, and of a file of it: what a stream holds at a time
#: follows from them, not from the table.
STEP_ROWS = 2_000_000
FILE_ROWS = 250_000


def events_log(spark, sf_dir):
    """The event table as actor activity."""
    return table(spark, sf_dir, "events").select(
        F.expr(_ACTOR).alias("actor"), F.to_date("ts").alias("day"),
        F.col("event_id").cast("string").alias("event"),
        F.get_json_object("props", "$.k").cast("bigint").alias("added"),
        F.expr(_DELETED).alias("deleted"), F.col("event_type").alias("subject"),
    )


_LOG = f"""log as (select {_ACTOR} as actor, cast(ts as date) as day,
  cast(event_id as varchar) as event, cast(json_extract_string(props,'$.k') as bigint) as added,
  {_DELETED} as deleted, event_type as subject from events)"""
_PEOPLE = "people as (select * from log where not contains(lower(actor),'bot'))"


def _with_log(body: str, *more: str) -> str:
    return f"with {', '.join([_LOG, _PEOPLE, *more])} {body}"


def _people(spark, sf_dir):
    return A.without_automation(events_log(spark, sf_dir))


def _parsed(spark, sf_dir):
    """Write the activity as a commit log and read that back."""
    path = new_folder(prepare(spark), "commit-log")
    line = F.concat_ws("\n",
        F.concat_ws("|||", F.lit("COMMIT"), "event", "actor", F.col("day").cast("string"),
                    F.col("subject")),
        F.concat_ws("\t", F.col("added").cast("string"), F.col("deleted").cast("string"),
                    F.lit("src/main.txt")),
        F.lit("-\t-\tlogo.png"),
        F.concat_ws("\t", F.lit("1"), F.lit("0"), F.lit("notes COMMIT|||.txt")),
    )
    events_log(spark, sf_dir).select(line.alias("value")).write.text(path)
    return read_commit_log(spark, path)


def _scoped(interval: str):
    def build(spark, sf_dir):
        return A.in_scope(_people(spark, sf_dir), interval, AS_OF)
    return build


def _totals(spark, sf_dir):
    return A.actor_totals(_people(spark, sf_dir))


_TOTALS = """totals as (select actor, count(*) as events, cast(sum(added) as bigint) as added,
  cast(sum(deleted) as bigint) as deleted, count(distinct day) as active_days
  from people group by actor)"""


def _shares(spark, sf_dir):
    return rounded(A.with_shares(A.actor_totals(_people(spark, sf_dir))))


def _periods(spark, sf_dir):
    """Period names of all three kinds for every event."""
    df = events_log(spark, sf_dir)
    return df.select("event", *[A.period_key(F.col("day"), i).alias(i) for i in A.LOOK_BACK])


def _matrix(spark, sf_dir):
    scoped = A.in_scope(_people(spark, sf_dir), "monthly", AS_OF)
    return A.period_rows(scoped, "monthly")


def _log_rows(spark, sf_dir):
    return A.actor_log(_people(spark, sf_dir))


# --- streams ----------------------------------------------------------------


def _stream(spark, sf_dir):
    """The transaction view as a stream over the event file."""
    return raw_transactions(_Reader(prepare(spark)), sf_dir)


class _Reader:
    """Lets the view be read as a stream: hands out ``readStream`` as ``read``."""

    def __init__(self, spark):
        self.conf = spark.conf
        self._spark = spark

    @property
    def read(self):
        return self

    def parquet(self, path: str):
        schema = self._spark.read.parquet(path).schema
        # As a pattern the path may be one file or a folder of files.
        return self._spark.readStream.schema(schema).parquet(f"{path[:-1]}[{path[-1]}]")


def run_to_end(spark, result):
    """Run a stream over what is there now and give the rows it wrote."""
    path = new_folder(spark, "stream")
    query = (
        result.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", path + "-state").option("path", path)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(result.schema).parquet(path)


def upsert_to_end(spark, result, keys, mode="update", first_by=None):
    """Run a stream over what is there now into a merging sink and give the merged rows."""
    path = new_folder(spark, "upserts")
    start_upserts(result, path, path + "-state", mode, availableNow=True).awaitTermination()
    return read_merged(spark, path, result.schema, keys, first_by)


def _dedup(spark, sf_dir):
    """Copies of a row come at once, and again forty days later: one row a key stays."""
    stream = _stream(spark, sf_dir).select(S.TXN, S.CARD, S.TIME, S.AMOUNT)
    copies = F.expr("case when cast(trans_num as bigint)%100=0 then array(0,0,40) else array(0) end")
    later = F.expr("cast(trans_date_trans_time as timestamp) + make_dt_interval(_c)")
    often = stream.withColumn("_c", F.explode(copies)).withColumn(S.TIME, later).drop("_c")
    out = upsert_to_end(spark, stream_dedup(often), [S.TXN], "append", [F.col(S.TIME)])
    return out.withColumn(S.TIME, micros(F.col(S.TIME)))


def arrivals(spark, rows, steps=3, hours=2.0, marker=True):
    """``rows`` as a stream that arrives step by step, each row up to ``hours`` late.

    There are ``steps`` steps, more where one would have over STEP_ROWS. All steps have the
    same number of files, so that a micro-batch is a step: no row of a step comes behind
    newer rows of the same step. With ``marker`` the last file ends the stream.
    """
    folder = new_folder(spark, "arrivals")
    at = micros(F.col(S.TIME)) + F.pmod(F.xxhash64(S.TXN), F.lit(max(1, int(hours * 3_600_000_000))))
    low, high, count = rows.agg(F.min(at), F.max(at), F.count(F.lit(1))).first()
    steps = max(steps, -(-count // STEP_ROWS))
    if low is None:
        low = high = 0
    step = F.coalesce(F.floor((at - F.lit(low)) * steps / F.lit(high - low + 1)), F.lit(0))
    largest = rows.groupBy(step.alias("step")).count().agg(F.max("count")).first()[0] or 0
    files = max(1, -(-largest // FILE_ROWS))
    for k in range(steps):
        rows.where(step == k).repartition(files).write.mode("append").parquet(folder)
        written = len(spark.read.schema(rows.schema).parquet(folder).inputFiles())
        for _ in range(written, (k + 1) * files):  # a step of few rows
            spark.createDataFrame([], rows.schema).write.mode("append").parquet(folder)
    if marker:
        end_marker(rows).write.mode("append").parquet(folder)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(folder)


def _features(spark, sf_dir):
    """Rows that arrive out of order have the features of a batch."""
    rows = raw_transactions(prepare(spark), sf_dir).select(S.TXN, S.CARD, S.TIME, S.AMOUNT, "merch_lat", "merch_long")
    ordered = stream_ordered_features(arrivals(spark, rows), delay="3 hours")
    return rounded(run_to_end(spark, ordered).drop(S.CARD, "us"))


def _bursts(spark, sf_dir):
    """All windows, those that are still open included."""
    rows = raw_transactions(prepare(spark), sf_dir).select(S.TXN, S.CARD, S.TIME, S.AMOUNT)
    stream = arrivals(spark, rows, steps=1, hours=0.5, marker=False).select(S.CARD, S.TIME, S.AMOUNT)
    stream = stream.withColumn(S.TIME, F.col(S.TIME).cast("timestamp"))
    # A window is the sum of its twelve panes, so the stream's state has panes alone.
    panes = upsert_to_end(spark, stream_bursts(stream, width="5 minutes"), ["window_start", "window_end", S.CARD])
    out = sliding_totals(panes)
    return rounded(out.withColumns({"window_start": F.unix_micros("window_start"),
                                    "window_end": F.unix_micros("window_end")}))


_STREAM_FRACTIONS = [
    c.split()[0] for c in OUTPUT.split(", ") if c.endswith(" double")
]

QUERIES: dict[str, Query] = {
    "IO6_G1_commit_log": Query(_parsed, _with_log(
        "select actor, day, event, added+1 as added, deleted, subject from log")),
    "G2_last_week": Query(_scoped("weekly"), _with_log(
        "select * from people where day>=date '2024-01-23'")),
    "G2_last_month": Query(_scoped("monthly"), _with_log(
        "select * from people where day>=date '2023-12-31'")),
    "G3_without_automation": Query(_people, _with_log("select * from people")),
    "G4_actor_totals": Query(_totals, _with_log("select * from totals", _TOTALS)),
    "G5_actor_shares": Query(_shares, round_sql(_with_log(
        """select *, events*100e0/(select sum(events) from totals) as share, added-deleted as net
        from totals""", _TOTALS), "share")),
    "G6_period_keys": Query(_periods, _with_log(
        """select event, strftime(day,'%a (%b %d)') as weekly, strftime(day,'%G-W%V') as monthly,
        strftime(day,'%Y-%m') as final from log""")),
    "G7_period_matrix": Query(_matrix, _with_log(
        """select a.actor, p.period, count(s.event) as events
        from (select distinct actor from scoped) a cross join
          (select distinct period from scoped) p
        left join scoped s on s.actor=a.actor and s.period=p.period group by 1, 2""",
        """scoped as (select *, strftime(day,'%G-W%V') as period from people
          where day>=date '2023-12-31')""")),
    "G8_actor_log": Query(_log_rows, _with_log("select actor, day, event, subject from people")),
    "T1_stream_dedup": Query(_dedup, with_raw(
        """select trans_num, cc_num, epoch_us(trans_date_trans_time) as trans_date_trans_time, amt
        from raw""")),
    "T2_stream_features": Query(_features, round_sql(with_txn(
        f"select trans_num, {H.LOCATION_A}, {H.AMOUNT_A}, {H.TIMING_A}, {H.FREQUENCY_A} from ratios",
        *H.PARTS), *_STREAM_FRACTIONS)),
    "T3_stream_bursts": Query(_bursts, round_sql(with_raw(
        """select ws*1000000 as window_start, (ws+3600)*1000000 as window_end, cc_num,
          count(amt) as transactions, sum(amt) as spent
        from (select cc_num, amt, (cast(floor(epoch(trans_date_trans_time)) as bigint)//300-i)*300
            as ws from raw, range(12) r(i)) w
        group by ws, cc_num"""), "spent")),
}
