"""Event-time windows. The ``window_*`` forms take batch and streaming frames alike;
``paned_aggregate`` and ``sessions`` are for batch, ``paned_stream`` for streams, and cut the rows
down before they multiply or move them."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlytics.functions.times import from_millis, plain
from streamlytics.operators.aggregate import minute_lists, row_count, trend_json
from streamlytics.operators.ordered import runs

_UNIT_MS = {"millisecond": 1, "second": 1_000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}


def duration_ms(text: str) -> int:
    number, unit = re.fullmatch(r"\s*(\d+)\s+([a-z]+?)s?\s*", text).groups()
    return int(number) * _UNIT_MS[unit]


def window_aggregate(
    df: DataFrame, keys: list[str], aggregates: list[Column], size: str, slide: str | None = None
) -> DataFrame:
    span = F.window("ts", size, slide) if slide else F.window("ts", size)
    return df.groupBy(span.alias("window"), *keys).agg(*aggregates)


def at_ingest_time(df: DataFrame) -> DataFrame:
    """For processing-time windows: ``ts`` is when the engine saw the row (per micro-batch)."""
    return df.withColumn("ts", F.current_timestamp())


def bounds(df: DataFrame) -> DataFrame:
    """Replace the window struct by two zone-free timestamps."""
    rest = [c for c in df.columns if c != "window"]
    return df.select(
        plain("window.start").alias("window_start"), plain("window.end").alias("window_end"), *rest
    )


def paned_stream(
    df: DataFrame,
    keys: list[str],
    partial: dict[str, Column],
    merge: dict[str, Column],
    size: str,
    slide: str,
) -> DataFrame:
    """``paned_aggregate`` for an append-mode stream: two chained stateful aggregates.

    The first counts each row once, into its pane of one slide. A pane that the watermark has passed
    goes on, by the time of its window, into the size/slide windows of the second aggregate; the same
    watermark then closes those. A row that comes after its pane has closed is late.
    """
    if duration_ms(size) % duration_ms(slide):
        raise ValueError("the window size must be a multiple of the slide")
    panes = window_aggregate(df, keys, [c.alias(n) for n, c in partial.items()], slide)
    panes = panes.select(F.window_time("window").alias("ts"), *keys, *partial)
    return window_aggregate(panes, keys, [c.alias(n) for n, c in merge.items()], size, slide)


def paned_aggregate(
    df: DataFrame,
    keys: list[str],
    partial: dict[str, Column],
    merge: dict[str, Column],
    size: str,
    slide: str,
) -> DataFrame:
    """Sliding windows from panes of one slide each.

    Every row is aggregated once into its pane; only panes are copied into the size/slide
    windows that hold them. The direct form copies each row instead.
    """
    if duration_ms(size) % duration_ms(slide):
        raise ValueError("the window size must be a multiple of the slide")
    panes = window_aggregate(df, keys, [c.alias(n) for n, c in partial.items()], slide)
    panes = panes.withColumn("ts", F.col("window.start")).drop("window")
    return window_aggregate(panes, keys, [c.alias(n) for n, c in merge.items()], size, slide)


def sliding_sum(df: DataFrame, keys: list[str], value: str, size: str, slide: str) -> DataFrame:
    return paned_aggregate(df, keys, {value: F.sum(value)}, {value: F.sum(value)}, size, slide)


def sliding_count(df: DataFrame, keys: list[str], size: str, slide: str) -> DataFrame:
    return paned_aggregate(
        df, keys, {"count": F.count(F.lit(1))}, {"count": F.sum("count")}, size, slide
    )


def item_view_counts(behavior: DataFrame, size: str, slide: str) -> DataFrame:
    """Page views per item and sliding window, with the window end in milliseconds."""
    views = behavior.where(F.col("behavior") == "pv")
    counts = sliding_count(views, ["itemId"], size, slide)
    return counts.select(
        "itemId", F.unix_millis(F.col("window.end")).alias("windowEnd"), "count"
    )


def sessions(
    df: DataFrame, key: str, value: str, gap: str, limit: int | None = None
) -> DataFrame:
    """Session windows: a pause of more than ``gap`` ends a session, one of exactly ``gap`` not.

    Rows of a key inside one gap-wide cell are at most a gap apart, so they always share a
    session. The cells are built first and combine before the shuffle. A key with more than
    ``limit`` cells is cut into slices, whose summaries are merged (see ``ordered.runs``).
    """
    gap_us = duration_ms(gap) * 1000
    us = F.unix_micros("ts")
    # ``div`` rounds towards zero, which would make the cell around 1970 twice as wide.
    cell = f"(unix_micros(ts) - pmod(unix_micros(ts), {gap_us})) div {gap_us}"
    cells = df.groupBy(key, F.expr(cell).alias("_cell")).agg(
        F.min(us).alias("_lo"), F.max(us).alias("_hi"), F.sum(value).alias("_v")
    )
    numbered = runs(
        cells, [key], ["_cell"], "_hi", lambda p: F.col("_lo") - p > gap_us, "_v", "_so_far", limit
    )
    return numbered.groupBy(key, "_run").agg(
        plain(F.timestamp_micros(F.min("_lo"))).alias("session_start"),
        plain(F.timestamp_micros(F.max("_hi") + F.lit(gap_us))).alias("session_end"),
        F.sum("_v").alias(value),
    ).drop("_run")


def session_stream(df: DataFrame, key: str, value: str, gap: str) -> DataFrame:
    out = df.groupBy(F.session_window("ts", gap).alias("window"), key).agg(
        F.sum(value).alias(value)
    )
    return bounds(out).withColumnsRenamed(
        {"window_start": "session_start", "window_end": "session_end"}
    )


def minute_trend(log: DataFrame, size: str, slide: str, weight: str | None = None) -> DataFrame:
    """Per window and ad: clicks per minute of the day, as one JSON text.

    ``size`` is at most a day, so a text has at most 1440 entries.
    """
    if duration_ms(slide) % 60_000:
        raise ValueError("the slide must be whole minutes")
    minutes = (
        log.groupBy("adid", F.window(from_millis("timestamp"), "1 minute").alias("_m"))
        .agg(row_count(weight).alias("n"))
        .select("adid", F.col("_m.start").alias("ts"), "n")
    )
    hm = F.date_format("ts", "HH:mm").alias("hm")
    spread = window_aggregate(
        minutes.select("adid", "ts", hm, "n"), ["adid", "hm"], [F.sum("n").alias("n")], size, slide
    )
    return minute_lists(spread, ["window", "adid"]).withColumn("trend", trend_json("trend"))
