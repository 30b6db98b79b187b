"""Running values per key that do not need a whole key in one task.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task. Here the rows are
first counted per key, which combines before the shuffle. Rows of keys up to the limit take the
plain window. Only rows of the keys beyond it, of which there are at most rows / limit, are range
partitioned by (key, order) and written, so a hot key spreads over many slices of even size;
windows run inside a slice, and each slice gets what came before it from a table that has at most
one row per slice. Both parts are put together again by a union.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamlytics.operators.enrich import broadcast_if_few
from streamlytics.session import max_group_rows, pin


@dataclass(frozen=True)
class Slices:
    """Rows, with ``_slice`` where they are ``split``, so that a key may span several slices."""

    rows: DataFrame
    keys: list[str]
    order: list[str]
    split: bool

    def window(self):
        part = [*self.keys, "_slice"] if self.split else self.keys
        return Window.partitionBy(*part).orderBy(*self.order)

    def running(self):
        return self.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def carry(self, per_slice: dict[str, Column], combine: dict[str, Column]) -> DataFrame:
        """The rows plus, per name, what the earlier slices of the key add up to, and
        ``_carried``: whether the key has earlier slices at all (a carried value may be null).

        ``per_slice`` aggregates a slice, ``combine`` folds those results over the earlier
        slices. Only a key that crosses a slice border has a row here, so the table has fewer
        rows than there are partitions and is safe to broadcast.
        """
        earlier = (
            Window.partitionBy(*self.keys)
            .orderBy("_slice")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        totals = self.rows.groupBy(*self.keys, "_slice").agg(
            *[c.alias(n) for n, c in per_slice.items()], F.lit(1).alias("_one")
        )
        folded = totals.select(
            *self.keys,
            "_slice",
            *[combine[n].over(earlier).alias(n) for n in per_slice],
            F.count("_one").over(earlier).alias("_before"),
        ).where("_before > 0")
        folded = folded.withColumn("_carried", F.lit(True)).drop("_before")
        return self.attached(folded, [*per_slice, "_carried"]).withColumn(
            "_carried", F.coalesce("_carried", F.lit(False))
        )

    def attached(self, per_slice: DataFrame, names: list[str]) -> DataFrame:
        """The rows plus ``names`` from a table with at most one row per slice (null if none)."""
        left, right = self.rows.alias("l"), F.broadcast(per_slice).alias("r")
        same = reduce(
            lambda a, b: a & b,
            [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in [*self.keys, "_slice"]],
        )
        return left.join(right, same, "left").select("l.*", *[f"r.{n}" for n in names])


def slices(
    df: DataFrame, keys: list[str], order: list[str], limit: int | None = None
) -> list[Slices]:
    """The rows of ordinary keys, and those of hot keys in slices if there are any."""
    spark = df.sparkSession
    limit = max_group_rows(spark) if limit is None else limit
    hot = pin(df.groupBy(*keys).count().where(F.col("count") > limit).select(*keys))
    if hot.isEmpty():
        return [Slices(df, keys, order, False)]
    left, right = df.alias("l"), broadcast_if_few(hot).alias("r")
    same = reduce(lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = left.join(right, same, "left_semi").repartitionByRange(width, *keys, *order)
    # Range borders come from a sample, so they are fixed by writing the sliced rows once.
    sliced = pin(spread.withColumn("_slice", F.spark_partition_id()))
    return [
        Slices(left.join(right, same, "left_anti"), keys, order, False),
        Slices(sliced, keys, order, True),
    ]


def _each(df: DataFrame, keys: list[str], order: list[str], limit: int | None, fn) -> DataFrame:
    """``fn`` of the ordinary and of the hot rows, together."""
    return reduce(DataFrame.unionByName, [fn(s) for s in slices(df, keys, order, limit)])


def running_count(
    df: DataFrame, keys: list[str], order: list[str], name: str = "rn", limit: int | None = None
) -> DataFrame:
    """Position of each row inside its key, from 1."""

    def count(s: Slices) -> DataFrame:
        within = F.row_number().over(s.window()).cast("bigint")
        if not s.split:
            return s.rows.withColumn(name, within)
        rows = s.carry({"_n": F.count(F.lit(1))}, {"_n": F.sum("_n")})
        return rows.withColumn(name, within + F.coalesce("_n", F.lit(0))).drop(
            "_slice", "_n", "_carried"
        )

    return _each(df, keys, order, limit, count)


def running_sum_first(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    sums: str,
    firsts: str,
    limit: int | None = None,
) -> DataFrame:
    """Rolling reduce: ``sums`` becomes its running total, ``firsts`` the key's first value."""

    def add(s: Slices) -> DataFrame:
        total, first = F.sum(sums).over(s.running()), F.first(firsts).over(s.running())
        if not s.split:
            rows = s.rows
        else:
            position = F.struct(*order)
            rows = s.carry(
                {"_sum": F.sum(sums), "_first": F.min_by(firsts, position)},
                {"_sum": F.sum("_sum"), "_first": F.first("_first")},
            )
            # A sum is null only as long as no value was seen, in this slice or before it.
            total = F.when(total.isNull(), F.col("_sum")).otherwise(
                total + F.coalesce("_sum", F.lit(0))
            )
            first = F.when(F.col("_carried"), F.col("_first")).otherwise(first)
        return rows.withColumns({"_t": total, "_f": first}).select(
            *[
                F.col("_t").alias(c) if c == sums else F.col("_f").alias(c) if c == firsts else c
                for c in df.columns
            ]
        )

    return _each(df, keys, order, limit, add)


def previous_value(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: str,
    name: str,
    limit: int | None = None,
) -> DataFrame:
    """The value of the row before, inside the key; null for the first row."""

    def look_back(s: Slices) -> DataFrame:
        before = F.lag(value).over(s.window())
        if not s.split:
            return s.rows.withColumn(name, before)
        rows = s.carry(
            {"_last": F.max_by(value, F.struct(*order))}, {"_last": F.last("_last")}
        )
        first_of_slice = F.row_number().over(s.window()) == 1
        carried = F.when(first_of_slice, F.col("_last")).otherwise(before)
        return rows.withColumn(name, carried).drop("_slice", "_last", "_carried")

    return _each(df, keys, order, limit, look_back)


def last_seen(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: str,
    name: str,
    limit: int | None = None,
) -> DataFrame:
    """The nearest value that is not null in the rows before, inside the key."""

    def look_back(s: Slices) -> DataFrame:
        before = s.window().rowsBetween(Window.unboundedPreceding, -1)
        within = F.last(value, ignorenulls=True).over(before)
        if not s.split:
            return s.rows.withColumn(name, within)
        at = F.when(F.col(value).isNotNull(), F.struct(*order))
        rows = s.carry(
            {"_last": F.max_by(value, at)}, {"_last": F.last("_last", ignorenulls=True)}
        )
        return rows.withColumn(name, F.coalesce(within, "_last")).drop(
            "_slice", "_last", "_carried"
        )

    return _each(df, keys, order, limit, look_back)


def runs(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    last: str,
    opens: Callable[[Column], Column],
    value: str,
    total: str,
    limit: int | None = None,
) -> DataFrame:
    """Cut each key into runs: ``_run`` numbers them and ``total`` adds up ``value`` inside one.

    ``opens(p)`` tells from ``last`` of the row before, ``p``, whether a row begins a run; the
    first row of a key does. A hot key is summed up slice by slice: its first row, its last
    value, how many runs begin inside and what the one left open holds. Those summaries are
    merged over the slice borders, and each slice gets what is open where it begins.
    """

    def cut(s: Slices) -> DataFrame:
        new = F.coalesce(opens(F.lag(last).over(s.window())), F.lit(True))
        if not s.split:
            numbered = s.rows.withColumn("_new", new.cast("int"))
            numbered = numbered.withColumn("_run", F.sum("_new").over(s.running()))
            return numbered.withColumn(
                total, F.sum(value).over(_upto([*keys, "_run"], order))
            ).drop("_new")
        first = F.row_number().over(s.window()) == 1
        inside = s.rows.withColumn("_new", F.when(first, 0).otherwise(new.cast("int")))
        inside = inside.withColumn("_in", F.sum("_new").over(s.running())).drop("_new")
        part = Slices(inside, keys, order, True)
        rows = part.attached(_open_at_head(part, last, opens, value), ["_runs", "_open"])
        # A run that goes on from an earlier slice is number 0 here.
        within = F.sum(value).over(_upto([*keys, "_slice", "_in"], order))
        going_on = F.when(F.col("_in") == 0, F.col("_open"))
        added = F.coalesce(within + going_on, within, going_on)
        number = F.col("_in") + F.coalesce("_runs", F.lit(1))
        return rows.withColumns({total: added, "_run": number}).drop(
            "_slice", "_in", "_runs", "_open"
        )

    return _each(df, keys, order, limit, cut)


def _upto(keys: list[str], order: list[str]):
    whole = Window.partitionBy(*keys).orderBy(*order)
    return whole.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _open_at_head(
    s: Slices, last: str, opens: Callable[[Column], Column], value: str
) -> DataFrame:
    """Per slice of a key but its first: the number ``_runs`` of the run its first row belongs to,
    and what that run holds so far, ``_open`` (null if it begins there)."""
    at, names = F.struct(*s.order), [c for c in s.rows.columns if c not in (*s.keys, "_slice")]
    by_run = s.rows.groupBy(*s.keys, "_slice", "_in").agg(
        F.sum(value).alias("_sum"),
        F.min_by(F.struct(*names), at).alias("_head"),
        F.max_by(F.struct(F.col(last)), at).alias("_last"),
    )
    summary = by_run.groupBy(*s.keys, "_slice").agg(
        F.min_by("_head", "_in").alias("_head"),
        F.max_by("_last", "_in").alias("_last"),
        F.max("_in").alias("_inside"),
        F.max_by(F.struct("_sum"), "_in").alias("_tail"),
    )
    line = Window.partitionBy(*s.keys).orderBy("_slice")
    summary = summary.select(
        *s.keys, "_slice", "_inside", "_tail", F.lag(F.col("_last")[last]).over(line).alias("_prev"),
        (F.row_number().over(line) > 1).alias("_later"), "_head.*",
    )
    begins = F.coalesce(opens(F.col("_prev")), F.lit(True)).cast("int").alias("_begins")
    known = summary.select(*s.keys, "_slice", "_inside", "_tail", "_later", begins)
    ends = F.sum(F.col("_begins") + F.col("_inside")).over(_upto(s.keys, ["_slice"]))
    known = known.withColumn("_end", ends)
    # Slices that end in one run add up to what it holds at each of their ends.
    held = F.sum("_tail._sum").over(_upto([*s.keys, "_end"], ["_slice"]))
    known = known.withColumn("_held", held)
    carried = F.when(F.col("_begins") == 0, F.lag("_held").over(line))
    return known.select(
        *s.keys, "_slice", "_later", (F.col("_end") - F.col("_inside")).alias("_runs"),
        carried.alias("_open"),
    ).where("_later").drop("_later")
