"""Documents to training shards, stage by stage.

``STAGES`` lists (name, function) in order. A stage takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from streamlytics.llm.chosen_path import without_near_duplicates
from streamlytics.llm.common import table, written
from streamlytics.llm.decontaminate import without_leaks
from streamlytics.llm.mixing import mixed
from streamlytics.llm.sharding import with_shards
from streamlytics.llm.toxicity import without_toxic
from streamlytics.llm.toxicity_query import fitted
from streamlytics.session import size_shuffles, tune


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain rejects go."""
    return without_toxic(docs, fitted(spark, docs, sf_dir))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return without_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, also a re-parameterised one, go."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"), any_case=True)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the source weights ask for."""
    return mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document (copy), whole, with its shard."""
    return with_shards(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("shard", shard),
]

# Learned weights and random rounding have no SQL; tests/llm/test_pipeline.py checks each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    size_shuffles(tune(spark), sf_dir)
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs
