import hashlib
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import tallyhawk.llm.fingerprints as module
from tallyhawk.llm.fingerprints import fingerprint_neighbours, fingerprints, likeness, term_counts
from tests.llm.helpers import WORD, documents


def terms(text):
    words = WORD.findall(text or "")
    return Counter(zip(words, [*words[1:], None]))


def jaccard(a, b):
    a, b = terms(a), terms(b)
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_terms_are_counted_whole(spark):
    texts = ["", None, " \t", "a", "a a a", "a b a b a b", "x\ny  z", "w " * 5000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    for r in df.select("i", term_counts(F.col("t")).alias("c")).collect():
        want = terms(texts[r["i"]])
        assert sorted(x["weight"] for x in r["c"]) == sorted(want.values())
        assert len({x["term"] for x in r["c"]}) == len(want)


def test_samples_collide_as_often_as_weights_overlap(spark):
    rnd = random.Random(5)
    words = [f"w{k}" for k in range(12)]
    pairs = []
    for k in range(40):
        a = [rnd.choice(words) for _ in range(60)]
        cut = rnd.randrange(5, 55)
        pairs.append((k, " ".join(a), " ".join(a[:cut] + [rnd.choice(words) for _ in range(60 - cut)])))
    df = spark.createDataFrame(pairs, "k long, a string, b string")
    one, two = (fingerprints(df, ["k"], F.col(c), 128).withColumnRenamed("samples", c) for c in "ab")
    got = {r["k"]: r["near"] for r in one.join(two, "k").select("k", likeness(F.col("a"), F.col("b")).alias("near")).collect()}
    error = np.array([got[k] - jaccard(a, b) for k, a, b in pairs])
    assert abs(error.mean()) < 0.02 and np.abs(error).max() < 0.2


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0]))
    out = {}
    for k, (i, text, *_) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        out[i] = (len(text), hashlib.sha256(edited.encode()).hexdigest())
    return out


def test_every_text_is_followed_by_the_next(spark):
    rnd = random.Random(6)
    rows = [(i * i * 3 - 50, "é" * rnd.randrange(3) + " ".join(rnd.choice("ab cd ef 漢字 gh".split()) for _ in range(rnd.randrange(30))), "s") for i in range(150)]
    rows += [(10**15, None, "s"), (10**15 + 1, "", None), (10**15 + 2, "long " * 9000, "s")]
    docs = documents(spark, rows, "")
    got = fingerprint_neighbours(docs).collect()
    assert {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in got} == brute(rows) and len(got) == len(rows)
    by_text = {}
    text_of = {r[0]: r[1] or "" for r in rows}
    for r in got:
        assert by_text.setdefault(text_of[r["doc_id"]], r["fingerprint"]) == r["fingerprint"]
        assert 0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1


def test_small_runs_meet_at_their_ends(spark, monkeypatch):
    monkeypatch.setattr(module.with_next, "__defaults__", (4,))
    rows = [(i * 7, f"text number {i} " * (i % 5 + 1), "s") for i in range(40)]
    got = fingerprint_neighbours(documents(spark, rows)).collect()
    assert {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in got} == brute(rows)


def test_far_ids_do_not_crowd_a_run(spark):
    ids = [*range(20_000), 10**15, -(10**15), 2**60]
    docs = spark.createDataFrame([(i, f"t{i}") for i in ids] + [(None, "n")], "doc_id long, text string").repartition(8)
    dealt, runs = module.in_runs(docs, 1000)
    found = dealt.groupBy("run").agg(F.count("*").alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).orderBy("run").collect()
    assert sum(r["n"] for r in found) == len(ids) + 1 and max(r["n"] for r in found) < 2500
    assert all(a["high"] < b["low"] for a, b in zip(found, found[1:])) and runs.count() == len(found)


def test_nulls_repeats_clashes_and_empty_tables(spark):
    rows = [(None, "a b c d", "s", 1), (3, "a b c d", "s", 2), (3, "a b c d", "s", 2), (3, "e f", "t", 3)]
    docs = documents(spark, rows, ", run int")
    got = fingerprint_neighbours(docs).collect()
    assert len(got) == 4 and len({r["fingerprint"] for r in got if r["n_chars"] == 7}) == 1
    assert any(r["near_next"] == 1 for r in got)
    alone = fingerprint_neighbours(docs.where("doc_id is null")).collect()
    assert len(alone) == 1 and alone[0]["near_next"] == 1.0
    assert alone[0]["edited_sha256"] == hashlib.sha256(b"a b a b").hexdigest()
    assert fingerprint_neighbours(docs.limit(0)).collect() == []
