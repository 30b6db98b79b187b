"""Count windows per key: every N-th element fires, an incomplete tail never does.

Rows are numbered once (without holding a key in one task) and then only grouped: panes of
one slide each, and each pane added to every window that covers it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlytics.operators.ordered import running_count


def panes(
    df: DataFrame, key: str, value: str, order: list[str], slide: int, limit: int | None = None
) -> DataFrame:
    """(key, pane, n, total): sums over consecutive runs of ``slide`` elements."""
    numbered = running_count(df, [key], order, "_rn", limit)
    return numbered.groupBy(key, F.expr(f"(_rn - 1) div {slide}").alias("pane")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")
    )


def windows_of(panes_df: DataFrame, key: str, value: str, size: int, slide: int) -> DataFrame:
    """Add each pane to the size/slide windows that end at or after it; keep the fired ones."""
    spans = size // slide
    reach = F.sequence(F.col("pane"), F.col("pane") + F.lit(spans - 1).cast("bigint"))
    return (
        panes_df.select(key, "n", "total", "pane", F.explode(reach).alias("_end"))
        .groupBy(key, "_end")
        .agg(
            F.sum("total").alias(value),
            F.max(F.when(F.col("pane") == F.col("_end"), F.col("n"))).alias("_n"),
        )
        .where(F.col("_n") == slide)
        .select(key, ((F.col("_end") + 1) * slide).alias("seen"), value)
    )


def count_windows(
    df: DataFrame,
    key: str,
    value: str,
    order: list[str],
    size: int,
    slide: int | None = None,
    limit: int | None = None,
) -> DataFrame:
    """(key, elements seen at firing, sum of the last ``size``); early windows cover fewer."""
    slide = slide or size
    if size % slide:
        raise ValueError("the window size must be a multiple of the slide")
    parts = panes(df, key, value, order, slide, limit)
    return windows_of(parts, key, value, size, slide)
