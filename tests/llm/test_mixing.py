import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallyhawk.llm import mixing
from tallyhawk.llm.mixing import mix_digest, mix_sources, repeat_rows, settle_fractions, source_targets
from tests.llm.helpers import WORD, documents


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Cut what is above its cap and give it to the others by weight, again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[k % 3] for k, s in enumerate(order)}
    left, open_ = share * sum(sizes.values()), set(order)
    target = {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > most * sizes[s]}
        if not over:
            target |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= over
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 1000, "c": 10, "d": 5, None: 400},
    {"a": 0, "b": 0},
    {"a": 7},
    {"é": 50, "z": 50, "Z": 500, "": 20, None: 0},
])
def test_targets_are_a_water_level(spark, sizes):
    table = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    found = {r["source"]: r["target"] for r in source_targets(table).collect()}
    assert found == pytest.approx(brute_targets(sizes))


def random_docs(n, seed):
    rnd = random.Random(seed)
    return [
        (i, " ".join(["w"] * rnd.choice([1, 3, 20, 60, 200])), rnd.choice(["hot", "hot", "b", "c", None]))
        for i in range(n)
    ]


def test_sources_end_near_their_target(spark):
    rows = random_docs(900, 1)
    # Few to a group, so that the tree has several levels.
    mixed = mix_sources(documents(spark, rows), fan_in=8).collect()
    assert len(mixed) == len(rows)
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in mixed:
        assert r["mix_size"] == len(WORD.findall(r["text"])) and 0 <= r["mix_copies"] <= 2
        sizes[r["source"]] += r["mix_size"]
        taken[r["source"]] += r["mix_size"] * r["mix_copies"]
        target[r["source"]] = r["mix_target"]
        assert r["mix_source_size"] == sum(len(WORD.findall(t)) for _, t, s in rows if s == r["source"])
    assert target == pytest.approx(brute_targets(sizes))
    for source, words in taken.items():
        assert abs(words - target[source]) <= 100  # half the longest document


def test_copies_are_fair_and_repeatable(spark):
    rows = [(i, "w w w", "s") for i in range(400)] + [(1000 + i, "v " * 30, "t") for i in range(40)]
    first = {r["doc_id"]: r["mix_copies"] for r in mix_sources(documents(spark, rows)).collect()}
    again = mix_sources(documents(spark, rows[::-1]).repartition(3)).collect()
    assert first == {r["doc_id"]: r["mix_copies"] for r in again}
    # Over many seeds each document's copies have its rate as their mean.
    total = defaultdict(int)
    units = spark.createDataFrame([(i, "s", 5.0, 0.3) for i in range(60)], "key long, source string, mass double, p double")
    units = units.selectExpr("named_struct('doc_id', key) as key", "source", "mass", "p", "60L as n_units")
    for seed in range(6):
        for r in settle_fractions(units, fan_in=16, seed=seed).collect():
            total[r["key"]["doc_id"]] += r["up"]
    assert sum(total.values()) == 6 * 18  # 0.3 of 60 exactly, as all masses are equal
    assert max(total.values()) < 6


def test_nulls_repeats_clashes_and_empty_tables(spark):
    rows = [
        (1, None, "a", 5), (2, "", "a", 6), (3, "x y", None, 7), (3, "x y", None, 7), (None, "p q r", "b", 8),
        (5, " \t\n", "b", None), (6, "w " * 5000, "b", 9),
    ]
    docs = documents(spark, rows, ", mix_copies int").withColumnRenamed("mix_copies", "size")
    mixed = mix_sources(docs)
    assert mixed.columns == ["doc_id", "text", "source", "size", "mix_size", "mix_source_size", "mix_target", "mix_copies"]
    got = mixed.collect()
    assert len(got) == 7 and {r["doc_id"]: r["mix_size"] for r in got} == {1: 0, 2: 0, 3: 2, None: 3, 5: 0, 6: 5000}
    twins = [r["mix_copies"] for r in got if r["doc_id"] == 3]
    assert max(twins) - min(twins) <= 1
    taken = mix_digest(docs).collect()
    assert all(r["taken"] == r["copies"] * r["size"] <= 2 * r["size"] for r in taken)
    assert repeat_rows(mixed).count() == sum(r["mix_copies"] for r in got)
    assert repeat_rows(mixed).columns == docs.columns
    assert mix_sources(docs.limit(0)).collect() == []
    all_empty = mix_digest(documents(spark, [(1, None, None), (2, "", "s")])).collect()
    assert [r["taken"] for r in all_empty] == [0, 0] and all(r["target"] == 0 for r in all_empty)


def test_equal_rows_meet_the_target_in_whole_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CELL_ROWS", 70)  # several cells of equal rows
    rows = [(None, "w w w", "a")] * 2000 + [(7, "v v", "b")] * 301 + [(None, f"w w x{i}", "a") for i in range(90)]
    rows += [(i, "w " * 40, "c") for i in range(100)]
    got = mix_sources(documents(spark, rows, "").withColumn("g", F.lit(1))).collect()
    assert len(got) == len(rows)
    for source, longest in (("a", 3), ("b", 2), ("c", 40)):
        own = [r for r in got if r["source"] == source]
        taken = sum(r["mix_size"] * r["mix_copies"] for r in own)
        assert abs(taken - own[0]["mix_target"]) <= longest
        assert {r["mix_copies"] for r in own} <= {0, 1, 2}
    again = mix_sources(documents(spark, rows, "").repartition(3)).collect()
    count = lambda out: sorted((str(r["doc_id"]), r["text"], r["mix_copies"]) for r in out)
    assert count(got) == count(again)
