import os
from types import SimpleNamespace

import pytest

from tallyhawk.session import cut_lineage, new_folder, prepare, shared_folder


def test_stored_tables_live_in_the_shared_folder(spark):
    df = spark.range(5).selectExpr("id", "named_struct('a', id) as s")
    stored = cut_lineage(df)
    assert stored.schema["s"].dataType.simpleString() == "struct<a:bigint>"
    assert sorted(r.id for r in stored.collect()) == list(range(5))
    assert all(shared_folder(spark) in f for f in stored.inputFiles())
    assert not os.path.exists(new_folder(spark, "x"))


def test_a_cluster_must_name_its_folder():
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default),
                              sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(RuntimeError):
        shared_folder(cluster)


def test_prepare_sets_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    assert prepare(spark).conf.get("spark.sql.session.timeZone") == "UTC"
