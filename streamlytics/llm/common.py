"""Helpers the training-text operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlytics.session import scratch, size_shuffles, tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

# Separators of words in every contract: the ASCII blanks only.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            size_shuffles(tune(spark), sf_dir)
            return fn(spark, sf_dir.rstrip("/"))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(name: str = "doc_id") -> Column:
    """A number as text on its way through pandas, which would round it beside a null."""
    return F.col(name).cast("string").alias(name)


def id_number(df: DataFrame, name: str = "doc_id") -> DataFrame:
    return df.withColumn(name, F.col(name).cast("bigint"))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, and lineage cut."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
