import numpy as np
import pytest

from tallyhawk.llm.neighbours import grow, nearest, neighbours_digest, unit


def table(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").repartition(4)


def brute(rows, k=5, queries=lambda i: i % 50 == 0, dims=None):
    good = {}
    for i, v, *_ in rows:
        if i is not None and v is not None and None not in v and np.isfinite(v).all() and any(v) and len(v) == dims:
            good[i] = v
    ids = np.array(sorted(good))
    u = unit(np.array([good[i] for i in ids]))
    out = {}
    for i in ids[[queries(i) for i in ids]]:
        score = (u * u[ids == i][0]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
        out[int(i)] = [(int(ids[j]), score[j]) for j in order]
    return out


def collected(df):
    out = {}
    for r in sorted(df.collect()):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(32).astype(np.float32).tolist(), 0) for i in range(3000)]
    got, want = collected(neighbours_digest(table(spark, rows))), brute(rows, dims=32)
    assert got.keys() == want.keys()
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    exact = {(q, v): s for q, near in want.items() for v, s in near}
    for q, near in got.items():
        assert all(s == pytest.approx(exact[q, v], abs=1e-15) for v, s in near if (q, v) in exact)
        assert [s for _, s in near] == sorted((s for _, s in near), reverse=True)


def test_data_with_structure_open_few_leaves():
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((40, 24)) * 4
    points = unit(centres[rng.integers(0, 40, 6000)] + rng.standard_normal((6000, 24)) * 0.05)
    flat = unit(rng.standard_normal((6000, 24)))
    assert grow(points).visits < grow(flat).visits


def test_ties_repeats_and_what_takes_no_part(spark):
    one, two = [1.0, 2.0, 3.0, 0.5], [2.0, -1.0, 0.0, 0.25]
    rows = [(i, one, 1) for i in range(0, 200)] + [(i, two, 2) for i in range(200, 230)]
    rows += [(0, one, 1), (300, None, 3), (350, [0.0] * 4, 3), (400, [1.0, None, 2.0, 3.0], 3), (450, [float("nan")] * 4, 3),
             (500, [float("inf"), 1.0, 1.0, 1.0], 3), (550, [1.0, 2.0], 3), (None, one, 3), (600, [1e-30, 2e-30, 3e-30, 5e-31], 4)]
    got = collected(neighbours_digest(table(spark, rows, "double")))
    want = brute(rows, dims=4)
    assert got.keys() == want.keys() == {0, 50, 100, 150, 200, 600}
    assert [v for v, _ in got[0]][:4] == [1, 2, 3, 4] and [v for v, _ in got[50]][:2] == [0, 1]
    assert {q: [v for v, _ in near] for q, near in got.items()} == {q: [v for v, _ in near] for q, near in want.items()}


def test_few_rows_and_empty_tables(spark):
    rows = [(0, [1.0, 0.0], 0), (50, [0.0, 1.0], 0), (3, [1.0, 1.0], 0)]
    got = collected(neighbours_digest(table(spark, rows)))
    assert [v for v, _ in got[0]] == [3, 50] and [v for v, _ in got[50]] == [3, 0]
    assert neighbours_digest(table(spark, rows).limit(0)).collect() == []
    assert collected(neighbours_digest(table(spark, rows[:1]))) == {}
    clash = table(spark, rows).withColumnRenamed("label", "rank")
    assert len(nearest(clash, clash, k=1).collect()) == 3
