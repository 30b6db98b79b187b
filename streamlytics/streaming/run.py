"""Running a stream to the end of its input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from streamlytics.session import scratch


def each_batch(
    df: DataFrame,
    body: Callable[[DataFrame, int], None],
    mode: str = "append",
    checkpoint: str | None = None,
):
    """Hand every micro-batch to ``body``; returns the finished query."""
    checkpoint = checkpoint or scratch(df.sparkSession, "checkpoint")
    query = (
        df.writeStream.foreachBatch(body)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def to_files(df: DataFrame, path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Append the stream to an exactly-once file sink and read that."""
    spark = df.sparkSession
    path = path or scratch(spark, "out")
    query = (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint or scratch(spark, "checkpoint"))
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


def read_state(
    spark: SparkSession,
    checkpoint: str,
    batch_id: int | None = None,
    operator: int = 0,
    variable: str | None = None,
) -> DataFrame:
    """(key, value, partition_id): what a stateful operator had in its state after ``batch_id``
    (default: the last finished batch), read from the checkpoint without starting the stream.

    ``operator`` counts the stateful operators as ``state_operators`` lists them; ``variable`` names
    one state of an operator that has several.
    """
    reader = spark.read.format("statestore").option("operatorId", operator)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    if variable is not None:
        reader = reader.option("stateVarName", variable)
    return reader.load(checkpoint)


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of a checkpoint, with the batches whose state can be read."""
    return spark.read.format("state-metadata").load(checkpoint)


def fan_out(*bodies: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """One ``foreachBatch`` body with several outputs; the batch is computed once."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for body in bodies:
                body(batch, batch_id)
        finally:
            batch.unpersist()

    return run
