"""Change-data envelopes: unpack, route by table and event type, render the after-image."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Which (table, event type) goes to which topic.
ROUTES = {
    ("order_info", "INSERT"): "GMALL_ORDER",
    ("order_detail", "INSERT"): "GMALL_ORDER_DETAIL",
    ("user_info", "INSERT"): "GMALL_USER",
    ("user_info", "UPDATE"): "GMALL_USER",
}
ROW_ENTRY = "ROWDATA"


def changed_rows(envelopes: DataFrame) -> DataFrame:
    """One row per changed row of the row-data entries; transaction marks are dropped."""
    return envelopes.where(F.col("entry_type") == ROW_ENTRY).select(
        "table", "event_type", F.explode("rows").alias("after")
    )


def route_topic(table: Column, event_type: Column, routes=ROUTES) -> Column:
    topic = F.lit(None).cast("string")
    for (t, e), name in routes.items():
        topic = F.when((table == t) & (event_type == e), F.lit(name)).otherwise(topic)
    return topic


def route_changes(rows: DataFrame, routes=ROUTES) -> DataFrame:
    """Add the topic and drop what has none."""
    topic = route_topic(F.col("table"), F.col("event_type"), routes)
    return rows.withColumn("topic", topic).where(F.col("topic").isNotNull())


def after_json(after: Column | str) -> Column:
    return F.to_json(after)
