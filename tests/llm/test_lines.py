import hashlib
import random
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tallyhawk.llm import lines
from tallyhawk.llm.lines import LINES_SQL, LineRuns, drop_common_lines, key_hash, lines_digest
from tests.llm.helpers import LOWER, documents


def brute(rows, min_docs=3, min_chars=20):
    """The contract, one line at a time; rows without an id are one document below all."""
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(i)
    top = {k: max(ids, key=lambda v: (v is not None, v)) for k, ids in holders.items() if len(ids) >= min_docs and len(k) >= min_chars}
    out = []
    for i, text in rows:
        all_lines = (text or "").split("\n")
        kept = [line for line in all_lines if key(line) not in top or top[key(line)] == i]
        out.append((i, "\n".join(kept), len(all_lines), len(all_lines) - len(kept)))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def corpus(seed, n):
    rnd = random.Random(seed)
    shared = [f"a line that several documents hold, number {k}" for k in range(25)]
    ends = ["", " ", "\t", "\r", "  \x0b\x0c"]
    rows = []
    for i in range(n):
        some = [rnd.choice(ends) + rnd.choice([str, str.upper])(rnd.choice(shared)) + rnd.choice(ends) for _ in range(rnd.randrange(5))]
        some += [rnd.choice(["short", "", f"an own line of document {i} for sure", "É" * 19, "É" * 20, "é" * 20])]
        rnd.shuffle(some)
        rows.append((i * 7 - 50, "\n".join(some)))
    return rows


@pytest.mark.parametrize(("batches", "busy", "keys"), [(1, 5000, 10_000), (4, 5000, 10_000), (7, 3, 10_000), (5, 2, 3)])
def test_lines_match_brute_force(spark, monkeypatch, batches, busy, keys):
    monkeypatch.setattr(lines, "BUSY_KEYS", keys)
    rows = corpus(batches, 150)
    docs = documents(spark, [(*r, "s") for r in rows])
    assert got(drop_common_lines(docs, batches=batches, busy_lines=busy)) == brute(rows)


def test_other_bounds(spark):
    rows = corpus(9, 80)
    docs = documents(spark, [(*r, "s") for r in rows])
    assert got(drop_common_lines(docs, min_docs=2, min_chars=5)) == brute(rows, 2, 5)


def test_runs_settle_and_compact(spark):
    runs = LineRuns(spark, min_docs=3, keep_from=1000)
    batch = lambda ids, *keys: spark.createDataFrame([(i, k) for i in ids for k in keys], "doc_id long, key string").withColumn("key", key_hash(F.col("key")))
    runs.add(batch([9, 8, 7], "settled", "x9"))
    assert [level is not None for level in runs.levels] == [True]
    runs.add(batch([6, 5], "settled", "twice"))
    assert [level is not None for level in runs.levels] == [False, True]
    runs.add(batch([4], "settled", "twice", "once"))
    runs.add(batch([3], "twice"))
    assert [level is not None for level in runs.levels] == [False, False, True]
    found = {bytes(r["key"]): (r["docs"], r["top"]) for r in runs.compact().collect()}
    name = lambda k: hashlib.sha256(k.encode()).digest()[:16]
    # Lines of a settled key are no longer added; the others are counted through all runs.
    assert found == {name("settled"): (3, 9), name("x9"): (3, 9), name("twice"): (4, 6), name("once"): (1, 4)}
    names = list(runs.names)
    runs.drop()
    assert not [n for n in names if spark.catalog.tableExists(n)]


def test_runs_are_merged_without_a_shuffle(spark):
    runs = LineRuns(spark, min_docs=2, keep_from=1000)
    names = [
        runs._write(spark.range(10, 40).select(key_hash(F.col("id").cast("string")).alias("key"), F.lit(1).alias("docs"), F.col("id").alias("top")))
        for _ in range(2)
    ]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        settled = spark.table(names[1]).select(F.col("key").alias("known"))
        anti = spark.table(names[0]).join(settled, F.col("key") == F.col("known"), "left_anti")
        for df in (anti, runs.merged(*names)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    runs.drop()


def test_digest_matches_sql(spark, sf_dir):
    found = lines_digest(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    want = con.execute(LINES_SQL)
    assert [c[0] for c in want.description] == found.columns
    rows = sorted(want.fetchall())
    assert sorted(tuple(r) for r in found.collect()) == rows and any(r[2] for r in rows)


def test_nulls_repeats_clashes_long_texts_and_empty_tables(spark):
    line = "this very line is held by many"
    rows = [
        (None, f"{line}\nown"), (None, line), (None, None), (3, ""), (4, None), (5, "\n\n"), (6, f" {line} \n{line}"), (6, f"{line}!\n{line}"),
        (7, f"x\n{line.upper()}\t"), (7, f"x\n{line.upper()}\t"), (8, "\n".join([line, "other words of no use at all"] * 20_000)), (2, line),
    ]
    docs = documents(spark, [(*r, "s", i) for i, r in enumerate(rows)], ", line int").withColumnRenamed("source", "th")
    found = drop_common_lines(docs)
    assert found.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    assert got(found) == brute(rows)
    assert any(r["n_dropped"] == r["n_lines"] == 1 and r["text"] == "" for r in found.collect())
    alone = docs.where("doc_id is null")
    assert got(drop_common_lines(alone)) == brute(rows[:3])
    assert drop_common_lines(docs.limit(0)).collect() == [] and lines_digest(docs.limit(0)).collect() == []
