import numpy as np
import pytest

from tallyhawk.operators.profiling import describe_full, histogram
from tallyhawk.operators.quantiles import grouped_quantiles

PROBS = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]


def test_quantiles_match_linear_interpolation(spark):
    rng = np.random.default_rng(5)
    groups = {
        "normal": rng.normal(0, 100, 501), "tiny": rng.normal(0, 1e-9, 200),
        "copies": np.repeat([0.0, 7.25, -3.5], [300, 500, 11]), "one": np.array([42.0]),
        "two": np.array([-1.0, 2.0]), "wide": np.exp(rng.normal(0, 30, 400)),
    }
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs]
    rows += [("normal", None), ("normal", float("nan")), (None, 1.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    found = {(r.g, r.prob): r.quantile for r in grouped_quantiles(df, ["g"], "v", PROBS).collect()}
    assert {g for g, _ in found} == set(groups)
    for g, values in groups.items():
        for p in PROBS:
            assert found[g, p] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-300)


def test_describe_full(spark):
    values = np.random.default_rng(1).gamma(2, 30, 777)
    df = spark.createDataFrame([(float(v), int(v)) for v in values], "a double, b int")
    rows = {r["column"]: r for r in describe_full(df, ["a", "b"]).collect()}
    assert rows["a"]["count"] == 777
    assert rows["a"]["q25"] == pytest.approx(np.quantile(values, 0.25))
    assert rows["b"]["q75"] == pytest.approx(np.quantile(values.astype(int), 0.75))
    assert rows["a"]["std"] == pytest.approx(values.std(ddof=1))


def test_histogram_matches_numpy_bins(spark):
    values = np.random.default_rng(2).gamma(1, 50, 1000).round(2)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    counts, edges = np.histogram(values, bins=20)
    rows = sorted(histogram(df, "v", 20).collect())
    assert [r.transactions for r in rows] == counts.tolist()
    assert [r.low for r in rows] == pytest.approx(edges[:-1].tolist())
    same = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert sum(r.transactions for r in histogram(same, "v", 4).collect()) == 2
