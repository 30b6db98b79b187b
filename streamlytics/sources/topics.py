"""Message-topic and socket sources, and the offsets a topic is resumed from."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_options(
    servers: str,
    topics: list[str],
    starting: str = "latest",
    max_per_trigger: int | None = None,
    **options: str,
) -> dict[str, str]:
    """Reader options. Spark never auto-commits; its checkpoint holds the offsets."""
    out = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
        "failOnDataLoss": "false",
        **options,
    }
    if max_per_trigger:
        out["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return out


def kafka_values(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Needs the Kafka connector on the class path."""
    records = spark.readStream.format("kafka").options(**options).load()
    return records.select(
        F.col("key").cast("string"), F.col("value").cast("string"),
        "topic", "partition", "offset", "timestamp",
    )


def socket_options(host: str, port: int) -> dict[str, str]:
    return {"host": host, "port": str(port)}


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    return spark.readStream.format("socket").options(**socket_options(host, port)).load()


def reconcile_offsets(live: DataFrame, saved: DataFrame) -> DataFrame:
    """Resume point per live partition: the saved offset, or 0 for a new partition.

    A saved partition that no longer exists is dropped, as there is nothing to read from it.
    """
    keys = ["topic", "group", "partition"]
    return live.join(saved, keys, "left").select(
        *keys, F.coalesce(F.col("offset"), F.lit(0).cast("bigint")).alias("offset")
    )


def starting_offsets(offsets: DataFrame) -> DataFrame:
    """(topic, starting_offsets): per topic the JSON object of partition -> offset."""
    entry = F.struct(F.col("partition").cast("string"), "offset")
    ordered = F.transform(
        F.sort_array(F.collect_list(F.struct("partition", entry.alias("e")))), lambda x: x["e"]
    )
    return offsets.groupBy("topic").agg(
        F.to_json(F.map_from_entries(ordered)).alias("starting_offsets")
    )


def starting_offsets_option(offsets: DataFrame) -> str:
    """The reader option for all topics; one short text per topic reaches the driver."""
    rows = starting_offsets(offsets).collect()
    return json.dumps({r["topic"]: json.loads(r["starting_offsets"]) for r in rows}, sort_keys=True)
