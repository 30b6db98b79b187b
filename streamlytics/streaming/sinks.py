"""Where results go. The shaping is separate from the write, so it can be checked."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlytics.functions.text import text_json
from streamlytics.functions.times import from_millis, plain


def kafka_records(
    df: DataFrame, topic: Column | str, value: str, key: str | None = None
) -> DataFrame:
    topic = F.lit(topic) if isinstance(topic, str) else topic
    columns = [topic.alias("topic"), F.col(value).cast("string").alias("value")]
    if key:
        columns.insert(1, F.col(key).cast("string").alias("key"))
    return df.select(*columns)


def write_kafka(records: DataFrame, servers: str, **options: str) -> None:
    """Needs the Kafka connector on the class path."""
    records.write.format("kafka").options(
        **{"kafka.bootstrap.servers": servers, **options}
    ).save()


def jdbc_options(url: str, table: str, batch_size: int = 1000, **options: str) -> dict[str, str]:
    """One batched transaction per partition."""
    return {"url": url, "dbtable": table, "batchsize": str(batch_size), **options}


def jdbc_append(options: dict[str, str], writers: int = 32) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` body; ``writers`` bounds the open connections.

    The rows are shuffled to the writers, so the stages before keep their own width.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.repartition(writers).write.format("jdbc").options(**options).mode("append").save()

    return write


def to_console(df: DataFrame, mode: str = "append", rows: int = 20):
    return df.writeStream.format("console").outputMode(mode).option("numRows", rows)


def hot_item_rows(top: DataFrame) -> DataFrame:
    return top.select(
        F.col("itemId").alias("item_id"), "count",
        plain(from_millis("windowEnd")).alias("record_time"),
    )


def to_wide_column(df: DataFrame, row_key: str, family: str, columns: list[str]) -> DataFrame:
    """One cell per non-null value; null values have no cell."""
    cells = df.select(
        F.col(row_key).cast("string").alias("rowkey"),
        *[F.col(c).cast("string").alias(c) for c in columns],
    ).unpivot("rowkey", columns, "qualifier", "value")
    return cells.where("value is not null").select(
        "rowkey", F.lit(family).alias("family"), "qualifier", "value"
    )


def sensor_document() -> Column:
    return text_json(
        sensor_id=F.col("id"), temperature=F.col("temperature"), ts=F.col("timestamp")
    )


def write_documents(df: DataFrame, document: Column, path: str) -> None:
    df.select(document.alias("value")).write.mode("overwrite").text(path)


def insert_partition(df: DataFrame, path: str, dt: Column | None = None, mode: str = "append") -> None:
    """Append under ``dt``, today unless a column is given.

    The rebalance brings a day together, so there are few files, and splits a day that is far
    larger than the others over several tasks.
    """
    dt = F.date_format(F.current_timestamp(), "yyyy-MM-dd") if dt is None else dt
    dated = df.withColumn("dt", dt).hint("rebalance", "dt")
    dated.write.partitionBy("dt").mode(mode).parquet(path)


def replace_table(df: DataFrame, name: str, path: str) -> DataFrame:
    """Drop and rewrite a catalog table kept under ``path``."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    df.write.mode("overwrite").option("path", path).saveAsTable(name)
    return spark.table(name)
