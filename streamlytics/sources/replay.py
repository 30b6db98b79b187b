"""Deterministic replay of a table as a file stream, slice by slice in event order."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlytics.session import scratch


DAY_US = 86_400_000_000


def time_slice(df: DataFrame, ts: str, slices: int, unit_us: int = 1) -> Column:
    """Number of the equal-width time slice a row falls into; the range is one small aggregate.

    Slices start at whole units (``DAY_US``: no day is cut), so the last ones may be empty.
    """
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    lo, hi = df.agg(F.min(us), F.max(us)).first()
    if lo is None:
        return F.lit(0)
    lo -= lo % unit_us
    width = ((hi - lo) // slices // unit_us + 1) * unit_us
    return F.expr(f"cast((unix_micros(cast(`{ts}` AS timestamp)) - {lo}) div {width} AS int)")


def time_slice_sql(table: str, ts: str, slices: int, unit_us: int = 1) -> str:
    """The same number in SQL, over the whole of ``table``."""
    span = f"""SELECT min(epoch_us({ts})) // {unit_us} * {unit_us} AS lo, max(epoch_us({ts})) AS hi
    FROM {table}"""
    return f"""CAST((epoch_us({ts}) - (SELECT lo FROM ({span}))) // (SELECT
    ((hi - lo) // {slices} // {unit_us} + 1) * {unit_us} FROM ({span})) AS INTEGER)"""


def closing_rows(df: DataFrame, ts: str, by: str, after: str) -> DataFrame:
    """A row per value of ``by``, all at one time that lies ``after`` the newest row.

    Delivered last, they carry the watermark past every window of the input. Their own windows
    stay open when the stream ends, so nothing of them is emitted.
    """
    last = df.groupBy(by).agg(F.max_by(F.struct(*df.columns), ts).alias("last")).select("last.*")
    newest = df.select(F.max(ts) + F.expr(f"INTERVAL {after}")).scalar()
    return last.select(*[newest.alias(c) if c == ts else F.col(c) for c in df.columns])


def replay(
    df: DataFrame,
    slice_no: Column,
    path: str | None = None,
    order: list[int] | None = None,
    files_per_slice: int | None = None,
    closing: DataFrame | None = None,
) -> DataFrame:
    """A streaming frame that delivers one slice of ``df`` per micro-batch.

    The file source takes files by modification time, so slices are written one after the
    other and their files are then given times a second apart. A trigger takes a fixed number of
    files; a slice that got fewer is filled up with empty ones, so no trigger ever takes rows of
    two slices. ``order`` replays the slices in another sequence; ``closing`` is delivered after
    all of them (see ``closing_rows``).
    """
    spark = df.sparkSession
    path = path or scratch(spark, "replay")
    numbered = df.withColumn("_slice", slice_no)
    # One count per slice: as many driver rows as there are slices.
    counts = {r["_slice"]: r["count"] for r in numbered.groupBy("_slice").count().collect()}
    width = files_per_slice or int(spark.conf.get("spark.sql.shuffle.partitions"))
    width = max(1, min([width, *counts.values()]))
    parts = [
        numbered.where(F.col("_slice") == n).drop("_slice").repartition(width)
        for n in order or sorted(counts)
        if n in counts
    ]
    if closing is not None:
        parts.append(closing.select(*df.columns).coalesce(1))
    folder = _Folder(spark, path)
    for at, part in enumerate(parts):
        folder.add(part, width, last=at == len(parts) - 1)
    return (
        spark.readStream.schema(df.schema).option("maxFilesPerTrigger", width).parquet(path)
    )


class _Folder:
    """Files of a replay, in the order in which they are to be delivered."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = spark._jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        self.fs.mkdirs(self.path)
        self.known = set(self._files())
        # In the past, so that no time is still to come when the stream starts.
        self.time = int(time.time()) * 1000 - DAY_US // 1000

    def _files(self) -> list[str]:
        names = [f.getPath().getName() for f in self.fs.listStatus(self.path)]
        return sorted(n for n in names if n[0] not in "_.")

    def add(self, part: DataFrame, width: int, last: bool) -> None:
        """Exactly ``width`` files: a partition without rows writes none. The last part may have
        fewer, as the last trigger takes what is left."""
        target = self.path.toString()
        part.write.mode("append").parquet(target)
        new = [n for n in self._files() if n not in self.known]
        for _ in range(0 if last else width - len(new)):
            part.limit(0).coalesce(1).write.mode("append").parquet(target)
        new = [n for n in self._files() if n not in self.known]
        if not last and len(new) != width:
            raise RuntimeError(f"a slice of the replay has {len(new)} files instead of {width}")
        self.time += 1000
        for name in new:
            self.fs.setTimes(self.path.suffix(f"/{name}"), self.time, -1)
        self.known.update(new)
