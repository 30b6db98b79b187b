"""Top-N per group. ``row_number`` with a bound becomes a per-task group limit, so each map
task ships at most N rows of a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamlytics.functions.times import from_millis
from streamlytics.operators.aggregate import area_ad_rollup


def top_per_group(
    df: DataFrame, groups: list[str], order: list[Column], n: int, name: str = "rank"
) -> DataFrame:
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*groups).orderBy(*order)))
    return ranked.where(F.col(name) <= n)


def daily_area_top(city_counts: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` most clicked ads per day and area; equal counts rank by ad id."""
    return top_per_group(
        area_ad_rollup(city_counts),
        ["dt", "area"],
        [F.desc("click_count"), F.asc("adid")],
        n,
    ).select("dt", "area", "adid", "click_count", "rank")


def merged_daily_top(stored: DataFrame, changed: DataFrame, n: int = 3) -> DataFrame:
    """``daily_area_top`` after some ads' totals grew: (dt, area, adid, click_count, rank).

    ``stored`` is the top list from before, of the (dt, area) groups that hold a changed ad;
    ``changed`` has the new totals of the changed ads only. An ad that is in neither was behind n
    others whose totals have not become smaller, so it is still behind them.
    """
    groups, ads = ["dt", "area"], ["dt", "area", "adid"]
    both = stored.select(*ads, "click_count").unionByName(changed.select(*ads, "click_count"))
    # An ad in both has its new total in ``changed``, and totals only grow.
    newest = both.groupBy(*ads).agg(F.max("click_count").alias("click_count"))
    ranked = top_per_group(newest, groups, [F.desc("click_count"), F.asc("adid")], n)
    return ranked.select(*ads, "click_count", "rank")


def hot_items(item_counts: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` most viewed items per window; equal counts rank by item id."""
    return top_per_group(
        item_counts, ["windowEnd"], [F.desc("count"), F.asc("itemId")], n
    ).select("windowEnd", "rank", "itemId", "count")


# The wording of the text report.
REPORT_HEAD, REPORT_ITEM, REPORT_VIEWS = "时间：", "商品ID=", "浏览量="
REPORT_RULE = "=" * 32


def hot_items_report(top: DataFrame) -> DataFrame:
    """One text block per window from the ranked rows (N rows a window)."""
    line = F.concat(
        F.lit("No"), F.col("rank"), F.lit(f": {REPORT_ITEM}"), F.col("itemId"),
        F.lit(f" {REPORT_VIEWS}"), F.col("count"),
    )
    lines = F.transform(
        F.sort_array(F.collect_list(F.struct("rank", line.alias("line")))), lambda s: s["line"]
    )
    head = F.concat(
        F.lit(REPORT_HEAD),
        F.date_format(from_millis("windowEnd"), "yyyy-MM-dd HH:mm:ss"), F.lit(".0"),
    )
    return top.groupBy("windowEnd").agg(lines.alias("_lines")).select(
        "windowEnd",
        F.concat_ws("\n", head, F.array_join("_lines", "\n"), F.lit(REPORT_RULE)).alias("report"),
    )
