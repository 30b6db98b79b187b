"""Temperature-rise alerts.

Per sensor: a rise arms a timer unless one is pending, a drop cancels it, an equal reading
does neither, and a timer that runs for ``hold`` seconds fires. The next rise after that arms
again. A drop at the very second the timer is due still cancels it; a rise at that second does
not arm. A timer at the end of the data fires only if the data reaches its due time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlytics.operators.ordered import last_seen, previous_value

HOLD_SECONDS = 5
BLOCK_CELLS = 4096


def turning_seconds(sensor: DataFrame, order: list[str], limit: int | None = None) -> DataFrame:
    """(id, t, dropped, rising): what happened in each second that matters.

    Only the last turn of a second can leave a timer behind, and a drop cancels any pending
    one, so a second needs two flags however many readings it holds.
    """
    turns = (
        previous_value(sensor, ["id"], order, "temperature", "_prev", limit)
        .where("temperature <> _prev")
        .withColumns(
            {
                "_at": F.struct(*order),
                "_down": F.col("temperature") < F.col("_prev"),
            }
        )
    )
    last = {
        "_drop": F.max(F.when(F.col("_down"), F.col("_at"))),
        "_rise": F.max(F.when(~F.col("_down"), F.col("_at"))),
    }
    flat = turns.groupBy("id", F.col("timestamp").alias("t")).agg(
        *[c.alias(n) for n, c in last.items()]
    )
    rising = F.col("_rise").isNotNull() & (
        F.col("_drop").isNull() | (F.col("_rise") > F.col("_drop"))
    )
    return flat.select(
        "id", "t", F.col("_drop").isNotNull().alias("dropped"), rising.alias("rising")
    )


def rises_by_run(seconds: DataFrame, limit: int | None = None) -> DataFrame:
    """Rising seconds with the run (stretch between drops) they belong to and the run's end.

    One sensor has at most one row per second of the time range here; one with more than
    ``limit`` of them is looked through in slices.
    """
    marked = seconds.withColumns(
        {"_back": -F.col("t"), "_drop": F.when(F.col("dropped"), F.col("t"))}
    )
    found = last_seen(marked, ["id"], ["_back"], "_drop", "until", limit)
    return found.where("rising").select("id", "t", "until")


def _cells(runs: DataFrame, hold: int) -> DataFrame:
    """(id, until, cell, offsets): the rises of a run by stretches of ``hold`` + 1 seconds.

    Timers arm more than ``hold`` seconds apart, so a cell arms at most one. It depends only on
    the first offset at which arming is allowed: the first rise from there on arms, and its offset is
    the first allowed one of the next cell. A cell that arms none leaves the next one free.
    """
    width = hold + 1
    cell = F.expr(f"(t - pmod(t, {width})) div {width}").alias("cell")
    return runs.groupBy("id", "until", cell).agg(
        F.sort_array(F.collect_set(F.pmod("t", F.lit(width)).cast("int"))).alias("offsets")
    )


def _arms(offsets: Column, entry: Column) -> Column:
    """The offset that arms a timer, if arming is allowed from ``entry`` on; -1 if none does."""
    return F.coalesce(F.array_min(F.filter(offsets, lambda o: o >= entry)), F.lit(-1))


def _step(last: Column, place: Column, leave: Callable[[Column], Column]) -> Column:
    """(place, entry, exit) after one more place: what was left behind counts next door only."""
    entry = F.greatest(F.when(place == last["place"] + 1, last["exit"]).otherwise(0), F.lit(0))
    return F.struct(place.alias("place"), entry.alias("entry"), leave(entry).alias("exit"))


def _walk(places: Column, start: Column, place: str, leave) -> Column:
    """The steps over ``places`` in order, after a first entry that is ``start``."""
    return F.aggregate(
        places,
        F.array(start),
        lambda done, p: F.concat(
            done, F.array(_step(F.element_at(done, -1), p[place], lambda e: leave(p, e)))
        ),
    )


def _before(place: Column, exit_: Column) -> Column:
    return F.struct(
        place.cast("bigint").alias("place"), F.lit(0).alias("entry"), exit_.cast("int").alias("exit")
    )


def armed_rises(runs: DataFrame, hold: int, block: int = BLOCK_CELLS) -> DataFrame:
    """Keep the rises that arm a timer: the first of a run, then the first beyond each timer.

    Cells are gathered into blocks of ``block`` cells. A block is summed up by what it leaves for
    each of the ``hold`` + 1 offsets at which it may be entered; one row per run puts those
    tables in order and finds the real entries, and each block then arms its own rises. So a run of
    any length is spread over its blocks. A run's row holds ``hold`` + 1 numbers per block, that is
    per ``block`` * (``hold`` + 1) seconds of the time range.
    """
    number = F.expr(f"(cell - pmod(cell, {block})) div {block}").alias("block")
    run = ["id", "until"]
    blocks = _cells(runs, hold).groupBy(*run, number).agg(
        F.sort_array(F.collect_list(F.struct("cell", "offsets"))).alias("cells")
    )
    end = (F.col("block") + 1) * block

    def through(entry: Column) -> Column:
        last = F.aggregate(
            "cells",
            _before(F.col("block") * block - 1, entry),
            lambda s, c: _step(s, c["cell"], lambda e: _arms(c["offsets"], e)),
        )
        return F.when(last["place"] == end - 1, last["exit"]).otherwise(-1)

    exits = F.transform(F.sequence(F.lit(0), F.lit(hold)), through).alias("exits")
    ordered = F.sort_array(F.collect_list(F.struct("block", exits)))
    lines = blocks.groupBy(*run).agg(ordered.alias("blocks"))
    # Before the first block there is none, so that one is entered freely.
    nowhere = _before(F.lit(None), F.lit(0))
    walked = _walk(F.col("blocks"), nowhere, "block", lambda b, e: F.get(b["exits"], e))
    entries = lines.select(*run, F.inline(F.slice(walked, F.lit(2), F.size("blocks")))).where("entry > 0")
    b, e = blocks.alias("b"), entries.alias("e")
    same = (
        F.col("b.id").eqNullSafe(F.col("e.id"))
        & F.col("b.until").eqNullSafe(F.col("e.until"))
        & (F.col("b.block") == F.col("e.place"))
    )
    entered = b.join(e, same, "left").select("b.*", F.coalesce("e.entry", F.lit(0)).alias("entry"))
    start = _before(F.col("block") * block - 1, F.col("entry"))
    steps = _walk(F.col("cells"), start, "cell", lambda c, x: _arms(c["offsets"], x))
    armed = entered.select(*run, F.inline(F.slice(steps, F.lit(2), F.size("cells"))))
    t = F.col("place") * (hold + 1) + F.col("exit")
    return armed.where("exit >= 0").select("id", t.alias("t"), "until")


def temp_rise_alerts(
    sensor: DataFrame,
    order: list[str],
    hold: int = HOLD_SECONDS,
    limit: int | None = None,
    block: int = BLOCK_CELLS,
) -> DataFrame:
    """(id, fired_at) for every timer that fires."""
    armed = armed_rises(rises_by_run(turning_seconds(sensor, order, limit), limit), hold, block)
    last = sensor.agg(F.max("timestamp").alias("m")).select("m").scalar()
    due = F.col("t") + hold
    fires = F.when(F.col("until").isNotNull(), F.col("until") > due).otherwise(due <= last)
    return armed.where(fires).select("id", due.alias("fired_at"))


def alert_text(alerts: DataFrame) -> DataFrame:
    return alerts.withColumn("alert", F.concat(F.lit("temperature of "), "id", F.lit(" keeps rising")))
