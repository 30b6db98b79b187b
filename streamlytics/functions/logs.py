"""Validation and routing of raw app logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlytics.functions.text import contains_text

# Marker text, topics and line formats of the app logs.
START_MARK = "start"
TOPIC_START = "topic_start"
TOPIC_EVENT = "topic_event"
# Java's trim() strips every character up to and including the blank.
START_FORMAT = r"(?s)\A[\x00-\x20]*\{.*\}[\x00-\x20]*\z"
# 13 digits, one bar, an object without bars; trailing bars are dropped by the field split.
EVENT_FORMAT = r"(?s)\A\p{Nd}{13}\|[\x00-\x20]*\{[^|]*\}[\x00-\x20]*\|*\z"


def _matches(text: Column, pattern: str) -> Column:
    return F.coalesce(F.rlike(text, F.lit(pattern)), F.lit(False))


def is_start_log(text: Column) -> Column:
    return _matches(text, START_FORMAT)


def is_event_log(text: Column) -> Column:
    return _matches(text, EVENT_FORMAT)


def is_clean_log(text: Column) -> Column:
    """The start rule applies as soon as the mark occurs anywhere, even inside an event."""
    return F.when(contains_text(text, START_MARK), is_start_log(text)).otherwise(is_event_log(text))


def log_topic(text: Column) -> Column:
    return F.when(contains_text(text, START_MARK), F.lit(TOPIC_START)).otherwise(TOPIC_EVENT)


def keep_clean_logs(events: DataFrame) -> DataFrame:
    return events.where(is_clean_log(F.col("body")))


def route_logs(events: DataFrame) -> DataFrame:
    """Put the topic into the header map, replacing one that is there already."""
    rest = F.map_filter("headers", lambda k, _: k != "topic")
    headers = F.map_concat(rest, F.create_map(F.lit("topic"), log_topic(F.col("body"))))
    return events.withColumn("headers", headers)
