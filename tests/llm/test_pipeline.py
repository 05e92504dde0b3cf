import pytest

import corpus_pipeline
from tallyhawk.llm.common import read
from tallyhawk.llm.queries import QUERIES
from tallyhawk.llm.quality import quality_digest

SF = "/root/testdata/sf0.001"


def test_the_stages_and_their_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "passages", "mix", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None and QUERIES["pipeline"].build is corpus_pipeline.run
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES if name != "pipeline"}


def test_stages_work_on_what_is_left(spark):
    docs = read(spark, SF, "documents")
    rejected = {r["doc_id"] for r in quality_digest(docs, read(spark, SF, "labels")).collect() if not r["predicted"]}
    seen = {r["doc_id"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        rows = docs.collect()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        ids = {r["doc_id"] for r in rows}
        assert ids <= seen
        if name == "quality":
            assert seen - ids == rejected
        if name == "passages":
            assert all(r["n_chars"] == len(r["text"]) for r in rows)
        docs = spark.createDataFrame(rows, docs.schema)
        seen = ids
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.count() == docs.count()


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES])
def test_every_stage_takes_empty_and_odd_tables(spark, stage):
    odd = spark.createDataFrame(
        [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "some words here", "en", None, 15), (3, "w " * 30_000, "de", "s", 60_000),
         (2, "", "en", "s", 0)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    stage(spark, odd, SF).collect()
    assert stage(spark, odd.limit(0), SF).collect() == []
