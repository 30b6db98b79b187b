"""Grouped counts and sums. Every one combines on the map side before its shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlytics.functions.times import day_of
from streamlytics.operators.ordered import running_count, running_sum_first


def row_count(weight: str | None = None) -> Column:
    """Row count, or the sum of a named column of pre-counted rows."""
    return F.sum(weight) if weight else F.count(F.lit(1))


def word_count(words: DataFrame, word: str = "word") -> DataFrame:
    return words.groupBy(word).agg(F.count(F.lit(1)).alias("count"))


def running_word_count(words: DataFrame, order: list[str], limit: int | None = None) -> DataFrame:
    """One output row per word seen: the word and its count so far."""
    return running_count(words, ["word"], order, "count", limit)


def rolling_reduce(sensor: DataFrame, order: list[str], limit: int | None = None) -> DataFrame:
    """Per reading: the sum of the sensor's temperatures so far and its first timestamp."""
    return running_sum_first(sensor, ["id"], order, "temperature", "timestamp", limit)


def with_day(log: DataFrame, day: str | None = None) -> DataFrame:
    """The log with its day as ``dt``: from the named column, else from the timestamp."""
    return log.withColumn("dt", F.col(day) if day else day_of("timestamp"))


def daily_user_ad_clicks(
    log: DataFrame, weight: str | None = None, day: str | None = None
) -> DataFrame:
    """``weight`` and ``day`` name columns of a log that is already counted and dated."""
    return with_day(log, day).groupBy("dt", "userid", "adid").agg(
        row_count(weight).alias("click_count")
    )


def date_area_city_ad_count(
    log: DataFrame, weight: str | None = None, day: str | None = None
) -> DataFrame:
    return with_day(log, day).groupBy("dt", "area", "city", "adid").agg(
        row_count(weight).alias("click_count")
    )


def area_ad_rollup(city_counts: DataFrame) -> DataFrame:
    return city_counts.groupBy("dt", "area", "adid").agg(
        F.sum("click_count").alias("click_count")
    )


def avg_truncated(df: DataFrame, key: str, value: str = "timestamp") -> DataFrame:
    """Average by whole-number division, widened to double; the exact one stands next to it.

    The sum is decimal, as a long one overflows after some 5e9 epoch seconds.
    """
    total = F.sum(F.col(value).cast("decimal(20,0)"))
    n = F.count(F.lit(1))
    return df.groupBy(key).agg(total.alias("_s"), n.alias("_n")).select(
        key,
        F.expr("_s div _n").cast("double").alias("avg_truncated"),
        (F.col("_s").cast("double") / F.col("_n")).alias("avg_exact"),
    )


def nan_min(value: str) -> Column:
    """Minimum that is NaN as soon as one value is, as Java's ``Math.min``."""
    has_nan = F.max(F.isnan(value).cast("int")) == 1
    return F.when(has_nan, F.lit(float("nan"))).otherwise(F.min(value))


def minute_lists(minutes: DataFrame, keys: list[str]) -> DataFrame:
    """Per key the sorted list of (HH:mm, n). Expects one row per minute of the day, so a list
    has at most 1440 entries."""
    return minutes.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("hm", "n"))).alias("trend")
    )


def trend_json(trend: Column | str) -> Column:
    """[(HH:mm, n), ...] -> ``[{"12:01":5},{"12:02":3}]``."""
    return F.to_json(F.transform(trend, lambda p: F.create_map(p["hm"], p["n"])))
