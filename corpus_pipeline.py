"""The corpus pipeline: quality classifier, quality rules, near duplicates, packing.

Each stage reads the documents its predecessor kept; ``run`` writes them as
Parquet into the shared folder in between.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from derrick.llm import jaccard_forest, packing, quality_gam, quality_trees
from derrick.llm.common import table
from derrick.session import cut_lineage, pin_utc

# No SQL: the first stages follow fitted models. The stages are tested against brute force.
ORACLE_SQL = None


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_gam.keep_good(docs, quality_gam.train(docs, table(spark, sf_dir, "labels")))


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_trees.keep_passing(docs, quality_trees.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_forest.keep_first(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", classify_quality),
    ("quality_rules", apply_rules),
    ("jaccard_join", drop_near_duplicates),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; every stage but the last is written and read again."""
    pin_utc(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
