"""Registered queries of the text operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from derrick.llm import byte_bpe, hnsw_search, html_blocks, importance_planes, jaccard_forest, language_bits, license_rules, masked_lm, merkle_manifest, packing, quality_gam, quality_trees, topk_search
from derrick.llm.common import table
from derrick.session import pin_utc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(fn: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(pin_utc(spark), folder)

    QUERIES[fn.__name__] = run
    return fn


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(ORACLES)


@_query
def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality_gam.classify(docs, quality_gam.train(docs, table(spark, folder, "labels")))


@_query
def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return language_bits.identify(docs, language_bits.learn(docs))


@_query
def op3_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_forest.near_duplicates(table(spark, folder, "documents")).drop("text_hash")


ORACLES["op3_jaccard_join"] = jaccard_forest.SQL


@_query
def op4_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


@_query
def op5_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    return topk_search.search(table(spark, folder, "embeddings"))


ORACLES["op5_topk_search"] = topk_search.SQL


@_query
def op6_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return masked_lm.pseudo_likelihood(table(spark, folder, "documents"))


@_query
def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality_trees.verdicts(docs, quality_trees.train(docs, table(spark, folder, "labels")))


@_query
def op8_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@_query
def op9_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_blocks.extracted(table(spark, folder, "pages"))


@_query
def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_rules.scan(table(spark, folder, "documents"))


@_query
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle_manifest.manifest(table(spark, folder, "documents"))


ORACLES["op11_merkle_manifest"] = merkle_manifest.SQL


@_query
def op12_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return hnsw_search.search(table(spark, folder, "embeddings"))


@_query
def op13_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return importance_planes.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


ORACLES["op13_importance_resampling"] = importance_planes.SQL


@_query
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)
