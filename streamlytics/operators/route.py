"""Splitting, merging and side outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The temperature limits and texts of the sensor programs.
HIGH_ABOVE = 30.0
FREEZING_BELOW = 32.0
HIGH_TEXT, LOW_TEXT, FREEZING_TEXT = "high temperature warning", "healthy", "freezing alert for "


def above(value: str, limit: float) -> Column:
    """NaN is above nothing, unlike in Spark's own ordering."""
    return (F.col(value) > limit) & ~F.isnan(value)


def tag_high_low(sensor: DataFrame, limit: float = HIGH_ABOVE) -> DataFrame:
    tag = F.when(above("temperature", limit), F.lit("high")).otherwise("low")
    return sensor.withColumn("tag", tag)


def select_tags(tagged: DataFrame, *tags: str) -> DataFrame:
    return tagged.where(F.col("tag").isin(*tags)).drop("tag")


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    for other in others:
        first = first.unionByName(other)
    return first


def co_map(tagged: DataFrame) -> DataFrame:
    """Two differently shaped outputs in one frame: high rows as (id, temperature, text), low
    rows as (id, text)."""
    high = F.col("tag") == "high"
    return tagged.where(F.col("tag").isin("high", "low")).select(
        "id",
        F.when(high, F.col("temperature")).alias("temperature"),
        F.when(high, HIGH_TEXT).otherwise(LOW_TEXT).alias("message"),
    )


def freezing_alerts(sensor: DataFrame, limit: float = FREEZING_BELOW) -> tuple[DataFrame, DataFrame]:
    """(main, side): every row passes on the main output, cold ones also raise an alert."""
    cold = sensor.where(F.col("temperature") < limit)
    return sensor, cold.withColumn("alert", F.concat(F.lit(FREEZING_TEXT), F.col("id")))
