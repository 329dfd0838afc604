"""A training-data pipeline over ``documents``: five stages, each one of the operators.

language ID -> SimHash near-dedup -> benchmark decontamination -> mixing -> sharding.
Every stage is written as Parquet to the shared folder and read again as the
next one's input. Missing or null columns of ``documents`` that a stage does not
read pass through untouched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hearth.llm import decontaminate, lang_ppm, mixing, sharding, simhash_gph
from hearth.llm.common import materialise

#: SQL has neither the code lengths nor the fingerprints; tests hold the stages against brute force.
ORACLE_SQL = None
SHARDS = 8


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language: not undetermined, and coded below 8 bits a byte by its model unless very short.

    Where no document has a language to learn from, every text with a letter stays.
    """
    model = lang_ppm.train(docs.where(~lang_ppm.held_out()))
    if not model.labels:
        return docs.where(lang_ppm.has_letter())
    return lang_ppm.identify(docs, model).where(lang_ppm.accepted()).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest id."""
    return simhash_gph.near_dedup(docs, shingle_words=3, max_distance=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark, the passages that remain in them cut out."""
    chars = "n_chars" if "n_chars" in docs.columns else None
    return decontaminate.remove_spans(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), chars_col=chars)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, repeats as repeated rows."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and slot."""
    return sharding.shard(docs, SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language_id),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing", mix_sources),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = materialise(spark, stage(spark, docs, sf_dir), f"stage{k}")
    return docs
