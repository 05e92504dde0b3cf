"""Packing documents into token-budget batches of optimal length buckets.

A batch is padded to its bucket's upper bound. A dynamic program over the histogram of
all lengths picks the bounds with the least padding; inside a bucket, batches take as
many documents as the token budget holds.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhawk.llm.common import cut_lineage, word_count

BUCKETS = 16
BUDGET = 8192
#: Lengths up to 2 ** FINE, the token budget, are counted one by one; above, where a
#: document is a batch of its own, there are 2 ** FINE cells to the octave.
FINE = 13
#: Documents numbered together.
CELL_ROWS = 20_000


def grid(length: Column) -> Column:
    """The cell of the histogram that ``length`` is counted in: itself up to 2 ** FINE."""
    length = F.greatest(length, F.lit(1))
    step = F.pow(F.lit(2.0), F.greatest(F.floor(F.log2(length.cast("double"))) - FINE, F.lit(0)))
    return (F.ceil(length / step) * step).cast("long")


def best_bounds(histogram: list[tuple[int, int]], buckets: int = BUCKETS) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least padded total.

    ``histogram`` holds (length, documents) pairs of distinct lengths. The sum of bound
    times documents differs from the padding by the sum of all lengths, a constant.
    """
    if not histogram:
        return []
    sizes, counts = (list(x) for x in zip(*sorted(histogram), strict=True))
    n = len(sizes)
    upto = [0, *itertools.accumulate(counts)]
    cost: list[int | None] = [0] + [None] * n
    cuts = []
    for _ in range(min(buckets, n)):
        cost, cut = _one_more(cost, sizes, upto)
        cuts.append(cut)
    bounds, j = [], n
    for cut in reversed(cuts):
        if j == 0:
            break
        bounds.append(int(sizes[j - 1]))
        j = cut[j]
    return bounds[::-1]


def _one_more(
    cost: list[int | None], sizes: list[int], upto: list[int]
) -> tuple[list[int | None], list[int]]:
    """The least totals with one more bucket, and where that bucket starts.

    A last bucket from i to j costs ``cost[i] + sizes[j] * (upto[j] - upto[i])``: for each
    i a line over sizes[j]. Slopes fall with i and sizes grow with j, so the lowest line
    only moves forward and a round is linear in the number of lengths. Whole numbers
    keep it exact.
    """
    lines: list[int] = []
    best = 0
    new: list[int | None] = [0] + [None] * len(sizes)
    cut = [0] * (len(sizes) + 1)
    for j, size in enumerate(sizes, 1):
        if (base := cost[j - 1]) is not None:
            while len(lines) > 1:
                one, two = lines[-2], lines[-1]
                if (base - cost[one]) * (upto[two] - upto[one]) > (
                    cost[two] - cost[one]
                ) * (upto[j - 1] - upto[one]):
                    break
                lines.pop()
            lines.append(j - 1)
        best = min(best, len(lines) - 1)
        while best + 1 < len(lines) and (
            cost[lines[best + 1]] - size * upto[lines[best + 1]]
            < cost[lines[best]] - size * upto[lines[best]]
        ):
            best += 1
        cut[j] = lines[best]
        new[j] = cost[cut[j]] + size * (upto[j] - upto[cut[j]])
    return new, cut


def pack(
    docs: DataFrame,
    length: Column | None = None,
    buckets: int = BUCKETS,
    budget: int = BUDGET,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """``docs`` with pack_length, pack_bucket, pack_bound, pack_batch and pack_slot.

    Columns of these names are replaced. ``length`` is the number of words unless given;
    a missing length counts as 0, and a row takes at least one token of a batch. Buckets
    count from 0 by length, batches from 0 in their bucket, slots from 0 in their batch;
    all batches of a bucket but the last are full. A document longer than the budget is
    a batch of its own. Documents are never cut. Equal rows are numbered in any order.
    An empty table gives an empty table.

    A bucket's bound is the length of its longest document. Bounds are the best of all
    that keep a cell of ``grid`` whole: lengths up to 8192 are cells of their own. Only the
    histogram comes to the driver, at most 8192 counts to the octave of lengths.
    Rows of a bucket are numbered in cells of about ``cell_rows`` by hash.
    """
    own = ["pack_length", "pack_bucket", "pack_bound", "pack_batch", "pack_slot"]
    columns = [c for c in docs.columns if c not in own]
    length = word_count(F.col("text")) if length is None else F.coalesce(length, F.lit(0))
    sized = docs.select(*columns, length.cast("long").alias("pack_length"))
    rows = sized.groupBy(grid(F.col("pack_length")).alias("cell")).agg(
        F.count(F.lit(1)).alias("n"), F.max("pack_length").alias("longest")
    ).collect()
    histogram = [(max(r["longest"], 1), r["n"]) for r in rows]
    bounds = best_bounds(histogram, buckets)
    cells = max(1, sum(n for _, n in histogram) // cell_rows)
    bucket = F.lit(max(len(bounds) - 1, 0))
    for k in reversed(range(len(bounds) - 1)):
        bucket = F.when(F.col("pack_length") <= bounds[k], F.lit(k)).otherwise(bucket)
    limits = F.array(*[F.lit(b).cast("long") for b in bounds or [1]])
    dealt = sized.withColumn("pack_bucket", bucket.cast("int")).withColumn(
        "pack_cell", F.pmod(F.xxhash64("doc_id", "pack_length"), F.lit(cells)).cast("long")
    )
    counts = dealt.groupBy("pack_bucket", "pack_cell").agg(F.count(F.lit(1)).alias("n"))
    before = (
        Window.partitionBy("pack_bucket").orderBy("pack_cell")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    firsts = cut_lineage(
        counts.select(
            F.col("pack_bucket").alias("b"), F.col("pack_cell").alias("c"),
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("pack_first"),
        )
    )
    order = Window.partitionBy("pack_bucket", "pack_cell").orderBy("doc_id", "pack_length")
    numbered = (
        dealt.withColumn("pack_place", F.row_number().over(order) - 1)
        .join(firsts, (F.col("pack_bucket") == F.col("b")) & (F.col("pack_cell") == F.col("c")))
        .withColumn("pack_place", F.col("pack_place") + F.col("pack_first"))
        .withColumn("pack_bound", F.element_at(limits, F.col("pack_bucket") + 1))
    )
    fits = F.greatest(F.floor(F.lit(budget) / F.col("pack_bound")), F.lit(1))
    return numbered.select(
        *columns, "pack_length", "pack_bucket", "pack_bound",
        F.floor(F.col("pack_place") / fits).cast("long").alias("pack_batch"),
        (F.col("pack_place") % fits).cast("int").alias("pack_slot"),
    )


def pack_digest(docs: DataFrame) -> DataFrame:
    """The place of every document: doc_id, length, bucket, bound, batch and slot."""
    return pack(docs.select("doc_id", "text")).select(
        "doc_id", F.col("pack_length").alias("length"), F.col("pack_bucket").alias("bucket"),
        F.col("pack_bound").alias("bound"), F.col("pack_batch").alias("batch"),
        F.col("pack_slot").alias("slot"),
    )
