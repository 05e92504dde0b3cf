"""From raw documents to training batches: the operators of ``tallyhawk.llm`` in a row.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last
return the columns of ``documents``. What a stage returns is stored as Parquet in the
shared folder before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyhawk.llm.common import cut_lineage, read
from tallyhawk.llm.jaccard import keep_one
from tallyhawk.llm.mixing import mix_sources, repeat_rows
from tallyhawk.llm.packing import pack
from tallyhawk.llm.quality import keep_good
from tallyhawk.llm.repeats import without_repeats


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return keep_good(docs, read(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five words, 0.8 or more."""
    return keep_one(docs, size=5, num=80, den=100)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occur earlier in the corpus are cut out."""
    return without_repeats(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight asks."""
    return repeat_rows(mix_sources(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each copy of a document in a batch, beside its columns."""
    return pack(docs)


STAGES = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("passages", passages),
    ("mix", mix),
    ("packing", packing),
]

#: A trained classifier decides who goes on, which SQL cannot say.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
