"""A training corpus from ``documents``: filter by language, drop near copies and leaks, sanitise, tokenise.

Each stage takes the rows its predecessor kept, as read back from Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pathgauge.llm.decontaminate import without_benchmark
from pathgauge.llm.language import in_learned_language
from pathgauge.llm.pieces import encode
from pathgauge.llm.pii import sanitised
from pathgauge.llm.simhash import keep_first
from pathgauge.sources.stages import store


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the corpus teaches."""
    return in_learned_language(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and what discloses it replaced by labels."""
    return sanitised(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their piece ids and the text these spell."""
    return encode(docs, decoded=True)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

#: Suffix automata, SimHash and piece ids have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``; each result is stored before the next stage reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
