"""Batch sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def from_collection(spark: SparkSession, rows: list, schema: T.StructType | str) -> DataFrame:
    """A literal collection; for rule lists and seeds, never for data."""
    return spark.createDataFrame(rows, schema)


def text_lines(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    return reader.text(path)


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def head(df: DataFrame, order: list, n: int = 100) -> DataFrame:
    """The first ``n`` rows of a stated order: a bounded heap per task, no global sort."""
    return df.orderBy(*order).limit(n)


def jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    condition: str | None = None,
    partition: tuple[str, str, str, int] | None = None,
    fetch_size: int = 10_000,
    **options: str,
) -> DataFrame:
    """A table over JDBC; ``condition`` reaches the database through filter pushdown.

    ``partition`` is (numeric or date column, lower bound, upper bound, parts). Without it
    Spark reads through one connection, which only suits small tables.
    """
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=table, fetchsize=str(fetch_size), **options
    )
    if partition:
        column, lower, upper, parts = partition
        reader = reader.options(
            partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=str(parts)
        )
    df = reader.load()
    return df.where(condition) if condition else df


def read_wide_column(cells: DataFrame, family: str, qualifiers: list[str]) -> DataFrame:
    """Long cells -> one row per row key, null where a cell is missing.

    The qualifiers are named, so there is no extra pass to find them and the maxima combine
    before the shuffle.
    """
    # Filtering to the wanted cells would lose row keys that have none of them.
    def cell(name: str):
        return F.when((F.col("family") == family) & (F.col("qualifier") == name), F.col("value"))

    return cells.groupBy("rowkey").agg(*[F.max(cell(q)).alias(q) for q in qualifiers])


def latest_value(
    df: DataFrame,
    since,
    time: str = "record_time",
    value: str = "wqi",
    default: float = 0.0,
    then: str | None = None,
) -> DataFrame:
    """The newest value after ``since`` as a double, or the default where there is none.

    Of rows with the newest time the one with the greatest ``then`` counts (default: the value).
    """
    place = F.struct(time, then or value)
    newest = df.where(F.col(time) > F.lit(since)).agg(F.max_by(value, place).alias("_v"))
    return newest.select(F.coalesce(F.col("_v").cast("double"), F.lit(default)).alias(value))
