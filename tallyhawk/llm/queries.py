"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tallyhawk.llm import (
    conversations,
    fingerprints,
    infill,
    jaccard,
    licenses,
    lines,
    mixing,
    neighbours,
    packing,
    pages,
    quality,
    repeats,
    tokens,
)
from tallyhawk.llm.common import read
from tallyhawk.plans.registry import Query


def _over(table: str, operator: Callable[[DataFrame], DataFrame]):
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return operator(read(spark, sf_dir, table))

    return build


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_digest(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


QUERIES: dict[str, Query] = {
    "op1_mix_sources": Query(_over("documents", mixing.mix_digest)),
    "op2_remove_repeats": Query(_over("documents", repeats.repeats_digest)),
    "op3_extract_pages": Query(_over("pages", pages.extract_pages)),
    "op4_jaccard_join": Query(_over("documents", jaccard.jaccard_digest)),
    "op5_nearest_neighbours": Query(_over("embeddings", neighbours.neighbours_digest)),
    "op6_license_scan": Query(_over("documents", licenses.license_digest)),
    "op7_fingerprints": Query(_over("documents", fingerprints.fingerprint_neighbours)),
    "op8_token_shards": Query(_over("documents", tokens.tokens_digest)),
    "op9_quality_scores": Query(_quality),
    "op10_pack_batches": Query(_over("documents", packing.pack_digest)),
    "op11_infill": Query(_over("documents", infill.infill_digest), infill.INFILL_SQL),
    "op12_repair_turns": Query(_over("conversations", conversations.repair_digest)),
    "op13_line_dedup": Query(_over("documents", lines.lines_digest), lines.LINES_SQL),
    "pipeline": Query(corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}
