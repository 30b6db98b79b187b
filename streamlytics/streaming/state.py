"""Keyed state: counters that expire, count windows, per-record counts and alerts.

Counts are carried in keyed tables and rows are numbered by window functions. Only the alerts and
the counters with timers run Python per key. The alerts sort one sensor's rows of one micro-batch
inside a task; there the trigger's intake limit (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``)
bounds what a task holds. The counters get one row per key and interval.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from streamlytics.operators.counts import windows_of
from streamlytics.operators.ordered import running_count, runs
from streamlytics.operators.windows import duration_ms, minute_trend
from streamlytics.streaming.keyed import KeyedTable, add_up

# Ship the functions below by value, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

UPDATE_EVERY = "5 seconds"
EXPIRY = "20 seconds"
START = -1


def _sorted(chunks: Iterator[pd.DataFrame], order: list[str], *columns: str) -> list[np.ndarray]:
    """The columns of one key's rows as arrays, in order."""
    parts = list(chunks)
    rows = parts[0] if len(parts) == 1 else pd.concat(parts)
    places = np.lexsort([rows[c].to_numpy() for c in reversed(order)])
    return [rows[c].to_numpy()[places] for c in columns]


def key_updates(df: DataFrame, every: str = UPDATE_EVERY) -> DataFrame:
    """(key, at, n): one counter update per key and batch interval, at the interval's end."""
    counts = df.groupBy("key", F.window("ts", every).alias("_w")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return counts.select("key", F.col("_w.end").alias("at"), "n")


def _running_by_ttl(updates: DataFrame, expiry: str, limit: int | None = None) -> DataFrame:
    """Add ``count``: the sum of ``n`` since the last pause of ``expiry`` or more.

    A key has one row per interval of the time range, not per event; one with more than
    ``limit`` of them is cut into slices, whose summaries are merged (see ``ordered.runs``).
    """

    def pause(before):
        return F.unix_millis("at") - F.unix_millis(before) >= duration_ms(expiry)

    return runs(updates, ["key"], ["at"], "at", pause, "n", "count", limit).drop("_run")


def ttl_counts(
    df: DataFrame, expiry: str = EXPIRY, every: str = UPDATE_EVERY, limit: int | None = None
) -> DataFrame:
    """(key, at, count) after each update; a counter not updated for ``expiry`` starts again."""
    return _running_by_ttl(key_updates(df, every), expiry, limit).select("key", "at", "count")


def ttl_counter_body(
    counters: KeyedTable,
    emit: Callable[[DataFrame, int], None],
    expiry: str = EXPIRY,
    every: str = UPDATE_EVERY,
    compact_every: int = 10,
) -> Callable[[DataFrame, int], None]:
    """The same as a ``foreachBatch`` body on (key, ts) in event order.

    ``counters`` (key, at, n) holds each counter's value and when it was set. A stored value
    enters the batch as one more update, so it is continued or, after the expiry, left behind.
    A compaction drops the counters that no later row can continue, as rows come in event order.
    """

    def alive(stored: DataFrame) -> DataFrame:
        newest = stored.select(F.max("at")).scalar()
        return stored.where(F.unix_millis(newest) - F.unix_millis("at") < duration_ms(expiry))

    def body(batch: DataFrame, batch_id: int) -> None:
        updates = key_updates(batch, every).withColumn("stored", F.lit(False))
        touched = updates.select("key").distinct()
        known = counters.read(before=batch_id, only=touched).withColumn("stored", F.lit(True))
        # An interval that began in the batch before is one update.
        merged = updates.unionByName(known).groupBy("key", "at").agg(
            F.sum("n").alias("n"), F.min("stored").alias("stored")
        )
        running = _running_by_ttl(merged, expiry).persist()
        try:
            emit(running.where(~F.col("stored")).select("key", "at", "count"), batch_id)
            newest = running.groupBy("key").agg(F.max("at").alias("at"), F.max_by("count", "at").alias("n"))
            counters.write(newest, batch_id)
        finally:
            running.unpersist()
        if (batch_id + 1) % compact_every == 0:
            counters.compact(batch_id, alive)

    return body


class ExpiringCounter(StatefulProcessor):
    """One counter per key as (at, count); a timer removes it ``expiry_ms`` after its last update.

    A call gets one key's updates of a micro-batch, at most one per update interval.
    """

    COUNTER = "counter"

    def __init__(self, expiry_ms: int):
        self.expiry = expiry_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counter = handle.getValueState(self.COUNTER, "at bigint, count bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        at, n = _sorted(rows, ["at"], "at", "n")
        last, count = self.counter.get() if self.counter.exists() else (None, 0)
        if last is not None:
            self.handle.deleteTimer(last + self.expiry)
        counts = []
        for when, more in zip(at.tolist(), n.tolist(), strict=True):
            count = more if last is None or when - last >= self.expiry else count + more
            counts.append(count)
            last = when
        self.counter.update((last, count))
        self.handle.registerTimer(last + self.expiry)
        yield pd.DataFrame({"key": key[0], "at": at, "count": counts})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.counter.clear()
        yield pd.DataFrame({"key": [], "at": [], "count": []}).astype(
            {"key": "str", "at": "int64", "count": "int64"}
        )

    def close(self) -> None:
        pass


def ttl_counts_stream(
    df: DataFrame, expiry: str = EXPIRY, every: str = UPDATE_EVERY
) -> DataFrame:
    """``ttl_counts`` of a watermarked stream of (key, ts), in append mode.

    A first aggregate makes one update per key and interval, when the watermark has passed that; a
    second operator holds the counters. Its state is one row per key that was updated within the
    expiry, and falls when the watermark passes that.
    """
    counts = df.groupBy("key", F.window("ts", every).alias("_w")).agg(F.count(F.lit(1)).alias("n"))
    end = F.unix_millis(F.col("_w.end")).alias("at")
    updates = counts.select("key", end, "n", F.window_time("_w").alias("ts"))
    out = updates.groupBy("key").transformWithStateInPandas(
        ExpiringCounter(duration_ms(expiry)), "key string, at bigint, count bigint",
        "Append", "EventTime",
    )
    return out.withColumn("at", F.timestamp_millis("at"))


def minute_trend_body(
    minutes: KeyedTable,
    emit: Callable[[DataFrame, int], None],
    size: str,
    slide: str,
    compact_every: int = 10,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` body on (timestamp, adid): the trends that a batch changes, anew.

    ``minutes`` adds up (adid, minute, n). Only minutes that share a window with the batch are
    read, so a batch costs its own time range and not the history.
    """
    reach = duration_ms(size)

    def body(batch: DataFrame, batch_id: int) -> None:
        minute = (F.col("timestamp") - F.pmod("timestamp", F.lit(60_000))).alias("minute")
        new = batch.groupBy("adid", minute).agg(F.count(F.lit(1)).alias("n"))
        minutes.write(new, batch_id)
        if (batch_id + 1) % compact_every == 0:
            minutes.compact(batch_id)
        low, high = minutes.batch(batch_id).agg(F.min("minute"), F.max("minute")).first()
        if low is None:
            return
        near = F.col("minute").between(low - reach, high + reach)
        rows = minutes.read(before=batch_id + 1, where=near).withColumnRenamed("minute", "timestamp")
        trends = minute_trend(rows, size, slide, "n")
        start, end = F.unix_millis("window.start"), F.unix_millis("window.end")
        emit(trends.where((end > low) & (start <= high)), batch_id)

    return body


def keep_panes(spans: int):
    """A fold for (key, pane) sums: added up, and only each key's last ``spans`` panes kept."""

    def fold(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
        added = add_up(rows, keys, values)
        key = [k for k in keys if k != "pane"]
        newest = added.groupBy(*key).agg(F.max("pane").alias("_newest"))
        kept = added.join(newest, key).where(F.col("pane") > F.col("_newest") - spans)
        return kept.drop("_newest")

    return fold


def pane_table(spark, path: str, key: str, size: int, slide: int) -> KeyedTable:
    """What count windows carry from batch to batch: a few sums per key."""
    return KeyedTable(
        spark, path, [key, "pane"], f"{key} string, pane bigint, n bigint, total bigint",
        keep_panes(size // slide),
    )


def count_window_body(
    panes: KeyedTable,
    emit: Callable[[DataFrame, int], None],
    key: str,
    value: str,
    order: list[str],
    size: int,
    slide: int | None = None,
    limit: int | None = None,
    compact_every: int = 10,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` body: every ``slide`` elements of a key emit the sum of its last ``size``.

    The batch's rows are numbered without holding a key in one task and summed into panes of
    ``slide`` elements; ``panes`` (see ``pane_table``) has how far a key got and its last panes.
    """
    slide = slide or size

    def body(batch: DataFrame, batch_id: int) -> None:
        stored = panes.read(before=batch_id)
        last = F.max_by(F.struct("pane", "n"), "pane").alias("l")
        seen = stored.groupBy(key).agg(last).select(
            F.col(key).alias("_key"), (F.col("l.pane") * slide + F.col("l.n")).alias("_seen")
        )
        numbered = running_count(batch.select(key, value, *order), [key], order, "_rn", limit)
        place = F.col("_rn") - 1 + F.coalesce("_seen", F.lit(0))
        placed = numbered.join(seen, F.col(key).eqNullSafe(F.col("_key")), "left")
        new = placed.groupBy(key, F.floor(place / slide).alias("pane")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(value).cast("bigint").alias("total")
        )
        panes.write(new, batch_id)
        # The panes of this batch and the stored ones: what was begun earlier may be full now.
        fresh = panes.batch(batch_id)
        both = stored.unionByName(fresh).groupBy(key, "pane").agg(
            F.sum("n").alias("n"), F.sum("total").alias("total")
        )
        touched = fresh.select(F.col(key).alias("_key"), ((F.col("pane") + 1) * slide).alias("_at"))
        fired = windows_of(both, key, value, size, slide)
        here = F.col(key).eqNullSafe(F.col("_key")) & (F.col("seen") == F.col("_at"))
        emit(fired.join(touched, here, "left_semi"), batch_id)
        if (batch_id + 1) % compact_every == 0:
            panes.compact(batch_id)

    return body


def running_count_body(
    counts: KeyedTable,
    emit: Callable[[DataFrame, int], None],
    key: str,
    order: list[str],
    limit: int | None = None,
    compact_every: int = 10,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` body: every row with ``count``, its place among all rows of its key.

    ``counts`` adds up (key, count) per batch. A start state of any size is written to it as batch
    ``START`` before the stream begins.
    """

    def body(batch: DataFrame, batch_id: int) -> None:
        stored = counts.read(before=batch_id).select(
            F.col(key).alias("_key"), F.col("count").alias("_stored")
        )
        numbered = running_count(batch, [key], order, "_rn", limit)
        place = (F.col("_rn") + F.coalesce("_stored", F.lit(0))).alias("count")
        same = F.col(key).eqNullSafe(F.col("_key"))
        emit(numbered.join(stored, same, "left").select(*batch.columns, place), batch_id)
        counts.write(batch.groupBy(key).agg(F.count(F.lit(1)).alias("count")), batch_id)
        if (batch_id + 1) % compact_every == 0:
            counts.compact(batch_id)

    return body


def temp_rise_stream(df: DataFrame, hold: int = 5) -> DataFrame:
    """(id, fired_at) on a watermarked stream of readings; see ``operators.alerts``.

    State: last temperature and the second at which a pending timer is due (0: none). A timer
    fires when a later reading of the sensor shows up or the watermark passes it.
    """

    def step_key(k, chunks: Iterator[pd.DataFrame], state: GroupState):
        last, due = state.get if state.exists else (None, 0)
        fired = []
        if state.hasTimedOut:
            fired, due = [due], 0
        else:
            temps, seconds = _sorted(chunks, ["ts", "event_id"], "temperature", "timestamp")
            before = np.concatenate([[np.nan if last is None else last], temps[:-1]])
            turns = np.flatnonzero((temps > before) | (temps < before))
            for i in turns:
                t = int(seconds[i])
                if due and due < t:
                    fired.append(due)
                    due = 0
                if temps[i] < before[i]:
                    due = 0
                elif not due:
                    due = t + hold
            last = float(temps[-1])
            if due and due < int(seconds[-1]):
                fired.append(due)
                due = 0
        state.update((last, due))
        if due:
            state.setTimeoutTimestamp(max(due * 1000, state.getCurrentWatermarkMs() + 1))
        if fired:
            yield pd.DataFrame({"id": k[0], "fired_at": fired})

    rows = df.select("id", "timestamp", "temperature", "event_id", "ts")
    return rows.groupBy("id").applyInPandasWithState(
        step_key, "id string, fired_at bigint", "last double, due bigint",
        "append", GroupStateTimeout.EventTimeTimeout,
    )
