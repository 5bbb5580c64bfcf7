"""A pipeline from raw documents to packed training sequences, in stages that are each written and read again."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from auditmill.llm.common import saved, table
from auditmill.llm.exact_dedup import drop_copies
from auditmill.llm.jaccard_join import keep_one
from auditmill.llm.packing import packed
from auditmill.llm.quality import keep_good
from auditmill.llm.toxicity import drop_toxic


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, table(spark, sf_dir, "labels"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("toxicity", toxicity),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", jaccard_join),
    ("packing", packing),
]

#: The certified cutoffs, the trained scores and the packing have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = saved(stage(spark, docs, sf_dir), f"stage_{number}")
    return docs
