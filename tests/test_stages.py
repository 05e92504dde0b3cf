"""Rejected lines, load states, tables stored by card and the chain from raw rows."""

import glob
import uuid

import pytest
from pyspark.sql import functions as F, types as T

from tallyhawk import schema as S
from tallyhawk.operators.behaviour import add_behaviour
from tallyhawk.plans.dataset import dataset_from_raw, model_dataset, prepare_transactions
from tallyhawk.plans.driver_view import raw_transactions
from tallyhawk.plans.queries_clean import with_copies
from tallyhawk.settings import PROFILE_B, SkewPolicy
from tallyhawk.sources import tables

SCHEMA = T.StructType([T.StructField("a b", T.LongType()), T.StructField("t", T.StringType()),
                       T.StructField("x", T.DoubleType())])


def test_good_and_rejected_lines_are_all_lines(spark, tmp_path):
    good = ["1,one,1.5", '2,"a, ""b""",', ",,", "4,four,4"]
    bad = {"x5,five,5": ("values", ["a b"]), "6,six": ("fields", []), "7,seven,7,7": ("fields", []),
           '8,"a,b",none': ("values", ["x"]), "y9,,z": ("values", ["a b", "x"])}
    lines = [good[0], *bad, *good[1:], "", "6,six"]
    (tmp_path / "lines.csv").write_text("a b,t,x\n" + "\n".join(lines) + "\n")
    read = tables.read_csv_lines(spark, str(tmp_path / "lines.csv"), SCHEMA)
    found = [tuple(r) for r in tables.good_rows(read).collect()]
    assert sorted(found, key=repr) == sorted(
        [(1, "one", 1.5), (2, 'a, "b"', None), (None, None, None), (4, "four", 4.0)], key=repr)
    rejected = tables.rejected_rows(read).collect()
    assert {r["line"]: (r["reason"], r["columns"]) for r in rejected} == bad
    assert len(rejected) == len(bad) + 1
    # An error in a column that nobody selects is an error still.
    assert tables.good_rows(read).select("t").count() == tables.good_rows(read).count() == len(good)


def test_load_states(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/full")
    spark.range(0).write.parquet(f"{tmp_path}/none")
    states = [tuple(tables.load_status(spark, f"{tmp_path}/{n}").first())
              for n in ("full", "none", "gone")]
    assert states == [("loaded", 3), ("empty", 0), ("missing", 0)]


def test_one_card_opens_one_part(spark, sf_dir, tmp_path):
    raw = raw_transactions(spark, sf_dir).select(S.TXN, S.CARD, S.TIME, S.AMOUNT)
    raw = raw.withColumn(S.CARD, F.when(F.col(S.TXN).cast("long") % 9 > 0, F.col(S.CARD)))
    path = f"{tmp_path}/cards"
    tables.write_by_card(raw, path, parts=16)
    card = raw.where("cc_num is not null").first()[S.CARD]
    found = tables.read_card(spark, path, card)
    assert found.columns == raw.columns
    assert sorted(found.collect()) == sorted(raw.where(F.col(S.CARD) == card).collect())
    opened = {r[0] for r in found.select(F.input_file_name()).collect()}
    assert len(opened) == 1 < len(glob.glob(f"{path}/*/*.parquet"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(card_part_of_16" in plan
    assert tables.read_card(spark, path, "nobody").count() == 0
    assert spark.read.parquet(path).count() == raw.count()
    spark.range(1).write.parquet(f"{tmp_path}/other")
    with pytest.raises(ValueError):
        tables.read_card(spark, f"{tmp_path}/other", card)


@pytest.mark.parametrize("policy", [None, SkewPolicy(hot_rows=5)])
def test_chain_from_raw_rows(spark, sf_dir, tmp_path, policy):
    raw = with_copies(raw_transactions(spark, sf_dir))
    name = f"stage_{uuid.uuid4().hex}"
    kept = ("merch_zipcode", "merch_zipcode_missing")
    try:
        built = dataset_from_raw(raw, name, f"{tmp_path}/stage", buckets=4, keep=kept, policy=policy)
        found = sorted(built.collect())
        plain = model_dataset(prepare_transactions(raw), keep=kept, policy=policy)
        assert found == sorted(plain.collect())
        assert len(found) == 1000 and all(r["merch_zipcode"] for r in found)
    finally:
        spark.sql(f"drop table if exists {name}")


def test_nothing_is_shuffled_behind_the_stage(spark, sf_dir, tmp_path):
    raw, name = raw_transactions(spark, sf_dir), f"stage_{uuid.uuid4().hex}"
    try:
        built = dataset_from_raw(raw, name, f"{tmp_path}/stage", buckets=4, policy=None)
        plan = built._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SelectedBucketsCount: 4 out of 4" in plan
        history = add_behaviour(spark.table(name), PROFILE_B, policy=None)
        assert "Exchange" not in history._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.sql(f"drop table if exists {name}")
