"""A sink that merges a stream's rows by key.

Every micro-batch is stored under its batch id and replaces what an earlier attempt of the
same batch left, so a batch that runs again after a failure changes nothing. Reading merges:
of each key the row of the newest batch stays, or the first one in a given order. In update
mode a row that changes is written again by each batch that changes it, so the merged table
is what the stream knows, windows that are still open included.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

BATCH = "batch"


def store_batch(rows: DataFrame, batch_id: int, folder: str) -> None:
    """Store the rows of one micro-batch; the same batch again replaces them."""
    rows.write.mode("overwrite").parquet(f"{folder}/{BATCH}={batch_id}")


def start_upserts(
    stream: DataFrame, folder: str, checkpoint: str, mode: str = "update", **trigger
) -> StreamingQuery:
    """Write a stream into ``folder`` batch by batch; ``trigger`` as in ``writeStream.trigger``."""
    def write(rows: DataFrame, batch_id: int) -> None:
        store_batch(rows, batch_id, folder)

    writer = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def read_merged(
    spark: SparkSession, folder: str, schema, keys: Sequence[str], first_by: Sequence[Column] | None = None
) -> DataFrame:
    """One row per key: the newest batch's, or the first by ``first_by`` over all batches.

    Rows of one batch and key that differ: the last, or first, of them in the order of all
    their columns, so reruns agree. Rows whose keys are null are keys too.
    """
    others = [f.name for f in schema if f.name not in keys]
    rows = spark.read.schema(schema.add(BATCH, "long") if BATCH not in schema.names else schema).parquet(folder)
    whole = F.struct(*others)
    if first_by is None:
        picked = F.max_by(whole, F.struct(F.col(BATCH), whole))
    else:
        picked = F.min_by(whole, F.struct(*first_by, whole))
    merged = rows.groupBy(*keys).agg(picked.alias("_row"))
    return merged.select(*[F.col(k) if k in keys else F.col("_row")[k].alias(k) for k in [f.name for f in schema if f.name != BATCH]])


def compact(
    spark: SparkSession, folder: str, target: str, schema, keys: Sequence[str], upto: int,
    first_by: Sequence[Column] | None = None,
) -> None:
    """Store all batches up to ``upto`` merged as that one batch of ``target``.

    A sink that goes on there with later batches reads like one that never stopped.
    """
    store_batch(read_merged(spark, folder, schema, keys, first_by), upto, target)
