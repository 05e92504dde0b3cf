import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallyhawk.operators.curves import curve_summary, threshold_curve
from tallyhawk.operators.quantiles import grouped_quantiles
from tallyhawk.operators.running import add_active_levels, add_level_ranks, in_stretches, level_ranks, running_totals


@pytest.mark.parametrize("rows", [1_000_000, 7])
def test_running_totals_match_a_plain_sum(spark, rows):
    rnd = random.Random(rows)
    data = [(rnd.choice(["a", "b", None]), k, rnd.randrange(10)) for k in range(300)]
    df = spark.createDataFrame(data, "g string, k long, v long").repartition(5)
    got = running_totals(df, ["g"], [F.desc("k")], ["v"], rows).collect()
    total = defaultdict(int)
    want = set()
    for g, k, v in sorted(data, key=lambda r: -r[1]):
        total[g] += v
        want.add((g, k, v, total[g]))
    assert {tuple(r) for r in got} == want and len(got) == 300
    assert running_totals(df.limit(0), ["g"], [F.col("k")], ["v"]).collect() == []


def test_narrow_values_are_dealt_into_many_stretches(spark):
    start = 1_700_000_000_000_000  # epoch microseconds: one power of two, one old range
    df = spark.range(0, 20_000).select((F.col("id") + start).alias("v"), F.lit("g").alias("g"))
    sizes = in_stretches(df, [F.col("v")], 500).groupBy("_part").count().collect()
    assert len(sizes) >= 30 and max(r["count"] for r in sizes) < 2_000
    got = {r["prob"]: r["quantile"] for r in grouped_quantiles(df, ["g"], "v", [0.0, 0.25, 0.5, 1.0], 500).collect()}
    assert got == {p: start + p * 19_999 for p in (0.0, 0.25, 0.5, 1.0)}


def test_levels_are_numbered_however_many_there_are(spark):
    rnd = random.Random(3)
    names = [f"n{rnd.randrange(10**6)}é{k}" for k in range(400)] + ["", "Z", "a"]
    df = spark.createDataFrame([(k, n, rnd.choice(["x", "y", None])) for k, n in enumerate([*names, None])], "k int, name string, c string")
    want = {n: i for i, n in enumerate(sorted(names, key=lambda s: s.encode()))}
    assert {r["level"]: r["code"] for r in level_ranks(df, "name", 20).collect()} == want
    rows = {r["k"]: r for r in add_level_ranks(df, ["name", "c"], 20).collect()}
    assert len(rows) == 404 and all(r["name_code"] == want.get(r["name"]) for r in rows.values())
    active = {r["k"]: r["active"] for r in add_active_levels(df, ["name", "c"], rows=20).collect()}
    for k, r in rows.items():
        first = [want[r["name"]] - 1] if want.get(r["name"]) else []
        assert active[k] == first + ([len(names) - 1] if r["c"] == "y" else [])


@pytest.mark.parametrize("rows", [1_000_000, 5])
def test_curves_match_plain_counts(spark, rows):
    rnd = random.Random(4)
    data = [(m, rnd.choice([0, 1, 0, 0, None]), rnd.choice([None, float("nan"), *[round(rnd.random(), 1) for _ in range(9)]]))
            for m in "ab" for _ in range(200)]
    curve = threshold_curve(spark.createDataFrame(data, "model_name string, is_fraud int, probability double"), rows=rows)
    found = {(r["model_name"], r["threshold"]): r for r in curve.collect()}
    summary = {r["model_name"]: r for r in curve_summary(curve).collect()}
    for m in "ab":
        usable = [(y, s) for n, y, s in data if n == m and y is not None and s is not None and s == s]
        points = sorted({s for _, s in usable}, reverse=True)
        assert sorted((t for n, t in found if n == m), reverse=True) == points
        best = []
        for t in points:
            tp = sum(y == 1 and s >= t for y, s in usable)
            fp = sum(y == 0 and s >= t for y, s in usable)
            p, n = sum(y for y, _ in usable), sum(1 - y for y, _ in usable)
            r = found[m, t]
            assert (r["tp"], r["fp"], r["fn"], r["tn"]) == (tp, fp, p - tp, n - fp)
            assert r["precision"] == pytest.approx(tp / (tp + fp)) and r["recall"] == pytest.approx(tp / p)
            best.append((2 * tp / (2 * tp + fp + p - tp), t))
        pairs = [(a > b) + (a == b) / 2 for y, a in usable if y for z, b in usable if not z]
        assert summary[m]["roc_auc"] == pytest.approx(sum(pairs) / len(pairs))
        assert (summary[m]["best_f1"], summary[m]["best_threshold"]) == pytest.approx(max(best))
        assert summary[m]["thresholds"] == len(points)


def test_curves_without_a_class_or_rows(spark):
    df = spark.createDataFrame([("a", 1, 0.5), ("a", 1, 0.7)], "model_name string, is_fraud int, probability double")
    row = curve_summary(threshold_curve(df)).first()
    assert row["roc_auc"] is None and row["best_f1"] == 1.0 and row["best_threshold"] == 0.5 and row["average_precision"] == 1.0
    assert curve_summary(threshold_curve(df.limit(0))).collect() == []
