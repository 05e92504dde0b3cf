import datetime as dt
import time

from pyspark.sql import functions as F

from tallyhawk.plans.driver_view import raw_transactions
from tallyhawk.session import new_folder
from tallyhawk.streaming.bursts import stream_bursts
from tallyhawk.streaming.dedup import stream_dedup
from tallyhawk.streaming.upsert import compact, read_merged, start_upserts, store_batch


def arrive(df, folder, files):
    """Write rows as files in an order that has nothing to do with time."""
    for k in range(files):
        df.where(F.pmod(F.xxhash64("trans_num"), F.lit(files)) == k).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.05)


def run(spark, result, folder, state):
    start_upserts(result, folder, state, availableNow=True).awaitTermination()


def view(spark, sf_dir):
    df = raw_transactions(spark, sf_dir).select("trans_num", "cc_num", "trans_date_trans_time", "amt")
    return df.withColumn("trans_date_trans_time", F.col("trans_date_trans_time").cast("timestamp"))


def test_every_window_is_there_once(spark, sf_dir):
    df = view(spark, sf_dir)
    source, folder = new_folder(spark, "in"), new_folder(spark, "out")
    arrive(df, source, 3)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(source)
    result = stream_bursts(stream, delay="3650 days")
    run(spark, result, folder, folder + "-state")
    got = read_merged(spark, folder, result.schema, ["window_start", "window_end", "cc_num"])
    want = df.groupBy(F.window("trans_date_trans_time", "60 minutes", "5 minutes"), "cc_num").agg(F.count("amt")).collect()
    rows = got.collect()
    assert len(rows) == len(want)
    assert {(r.window_end, r.cc_num, r.transactions) for r in rows} == {(r[0].end, r[1], r[2]) for r in want}


def test_copies_any_time_apart_become_one_row(spark, sf_dir):
    df = view(spark, sf_dir)
    late = df.limit(80).withColumn("trans_date_trans_time", F.expr("trans_date_trans_time + interval 40 days"))
    source, folder = new_folder(spark, "in"), new_folder(spark, "out")
    arrive(df.unionByName(late), source, 2)
    late.coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(source)
    result = stream_dedup(stream, delay="3650 days")
    start_upserts(result, folder, folder + "-state", "append", availableNow=True).awaitTermination()
    got = read_merged(spark, folder, result.schema, ["trans_num"], [F.col("trans_date_trans_time")])
    assert got.count() == df.count() and got.columns == df.columns


def test_a_batch_that_runs_again_changes_nothing(spark):
    schema = "k string, v int, at timestamp"
    at = dt.datetime(2024, 1, 1)
    frame = lambda rows: spark.createDataFrame([(*r, at + dt.timedelta(days=r[1])) for r in rows], schema)
    folder = new_folder(spark, "merge")
    kind = frame([("a", 1)]).schema
    store_batch(frame([("a", 1), ("b", 5), (None, 7)]), 0, folder)
    store_batch(frame([("a", 3), ("c", 4), ("x", 9)]), 1, folder)  # lost half way: other rows than the repeat
    store_batch(frame([("a", 3), ("c", 4)]), 1, folder)
    store_batch(frame([("a", 2), ("c", 2)]), 10, folder)
    newest = {(r["k"], r["v"]) for r in read_merged(spark, folder, kind, ["k"]).collect()}
    assert newest == {("a", 2), ("b", 5), ("c", 2), (None, 7)}
    first = {(r["k"], r["v"]) for r in read_merged(spark, folder, kind, ["k"], [F.col("at")]).collect()}
    assert first == {("a", 1), ("b", 5), ("c", 2), (None, 7)}
    # A compacted folder goes on like the one it came from.
    smaller = new_folder(spark, "merge")
    compact(spark, folder, smaller, kind, ["k"], 10)
    compact(spark, folder, smaller, kind, ["k"], 10)
    store_batch(frame([("b", 6)]), 11, smaller)
    assert {(r["k"], r["v"]) for r in read_merged(spark, smaller, kind, ["k"]).collect()} == {("a", 2), ("b", 6), ("c", 2), (None, 7)}
