import itertools
import random

import pytest
from pyspark.sql import functions as F

from tallyhawk.llm.packing import best_bounds, grid, pack, pack_digest
from tests.llm.helpers import documents


def padded(histogram, bounds):
    return sum(n * min(b for b in bounds if b >= size) for size, n in histogram)


@pytest.mark.parametrize("seed", range(5))
def test_bounds_are_optimal(seed):
    rnd = random.Random(seed)
    sizes = rnd.sample(range(1, 200), 9)
    histogram = [(s, rnd.randrange(1, 50)) for s in sizes]
    for buckets in (1, 2, 3, 4, 9, 20):
        bounds = best_bounds(histogram, buckets)
        assert bounds == sorted(set(bounds)) and len(bounds) <= buckets and bounds[-1] == max(sizes)
        best = min(
            padded(histogram, (*some, max(sizes)))
            for k in range(min(buckets, 9)) for some in itertools.combinations(sorted(sizes)[:-1], k)
        )
        assert padded(histogram, bounds) == best
    assert best_bounds([], 4) == []


def test_grid_rounds_up_by_under_one_percent(spark):
    lengths = [0, 1, 5, 128, 129, 255, 256, 257, 511, 513, 70_001, 123_456_789, 2**40 + 1]
    df = spark.createDataFrame([(n,) for n in lengths], "n long").select("n", grid(F.col("n")).alias("g"))
    for r in df.collect():
        assert r["g"] >= max(r["n"], 1) and r["g"] <= max(r["n"], 1) * 1.008
        assert r["g"] == max(r["n"], 1) if r["n"] <= 128 else True


def test_bounds_are_real_lengths_and_optimal(spark):
    rnd = random.Random(5)
    lengths = [rnd.choice([3, 130, 131, 777, 2730, 2731, 5001]) + rnd.randrange(3) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate([*lengths, 100_003, 100_001])), "doc_id long, n long")
    got = pack(df, length=F.col("n"), buckets=4).collect()
    histogram = {}
    for r in got:
        histogram[r["n"]] = histogram.get(r["n"], 0) + 1
    assert all(r["pack_bound"] == max(o["n"] for o in got if o["pack_bucket"] == r["pack_bucket"]) for r in got)
    pairs = sorted(histogram.items())
    best = min(
        padded(pairs, (*some, 100_003))
        for k in range(4) for some in itertools.combinations([s for s, _ in pairs][:-1], k)
    )
    assert sum(r["pack_bound"] for r in got) == best


def test_batches_are_full_and_whole(spark):
    rnd = random.Random(2)
    rows = [(i, "w " * rnd.choice([1, 2, 9, 10, 50, 51, 400]), "s") for i in range(700)]
    got = pack(documents(spark, rows), buckets=3, budget=500, cell_rows=40).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(700))
    histogram = {}
    for r in got:
        histogram[r["pack_length"]] = histogram.get(r["pack_length"], 0) + 1
    bounds = best_bounds([(k, v) for k, v in histogram.items()], 3)
    assert {r["pack_bound"] for r in got} <= set(best_bounds([(401 if k > 400 else k, v) for k, v in histogram.items()], 3)) | set(bounds) | {400}
    for bucket in {r["pack_bucket"] for r in got}:
        own = [r for r in got if r["pack_bucket"] == bucket]
        fits = max(1, 500 // own[0]["pack_bound"])
        assert all(r["pack_length"] <= r["pack_bound"] for r in own)
        places = sorted((r["pack_batch"], r["pack_slot"]) for r in own)
        assert places == [(k // fits, k % fits) for k in range(len(own))]


def test_nulls_repeats_clashes_and_empty_tables(spark):
    rows = [(1, None, "a", 1), (2, "", "a", 2), (None, "x y", None, 3), (3, "x y", "b", 4), (3, "x y", "b", 4), (4, "w " * 20_000, "b", 5)]
    docs = documents(spark, rows, ", bucket int")
    got = pack(docs, budget=100).collect()
    assert len(got) == 6 and sorted(r["bucket"] for r in got) == [1, 2, 3, 4, 4, 5]
    assert len({(r["pack_bucket"], r["pack_batch"], r["pack_slot"]) for r in got}) == 6
    long = next(r for r in got if r["doc_id"] == 4)
    assert long["pack_length"] == 20_000 and long["pack_slot"] == 0 and long["pack_bound"] >= 20_000
    assert pack(docs.limit(0)).collect() == []
    assert pack_digest(docs).count() == 6
    again = pack(pack(docs))
    assert again.columns == pack(docs).columns
    own = pack(docs, length=F.col("bucket")).collect()
    assert sorted(r["pack_length"] for r in own) == [1, 2, 3, 4, 4, 5]
