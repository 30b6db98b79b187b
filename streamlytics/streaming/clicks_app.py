"""The running ad-click application: one ``foreachBatch`` body over keyed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlytics.operators import aggregate as agg
from streamlytics.operators.blacklist import THRESHOLD, drop_blacklisted
from streamlytics.operators.topn import merged_daily_top
from streamlytics.streaming.keyed import KeyedTable, add_up, collect_members, keep_latest


class ClicksApp:
    """Filter by the blacklist, count, rank, and extend the blacklist for the next batch.

    Every read is as of before the batch and every write belongs to it, so a repeated batch
    changes nothing.
    """

    def __init__(
        self, spark: SparkSession, root: str, threshold: int = THRESHOLD, compact_every: int = 50
    ):
        self.threshold, self.compact_every = threshold, compact_every
        self.counters = KeyedTable(
            spark, f"{root}/counters", ["dt", "userid", "adid"],
            "dt string, userid string, adid string, click_count bigint", add_up, ("dt",),
        )
        self.blacklist = KeyedTable(
            spark, f"{root}/blacklist", ["userid"], "userid string", collect_members
        )
        self.city_counts = KeyedTable(
            spark, f"{root}/city_counts", ["dt", "area", "city", "adid"],
            "dt string, area string, city string, adid string, click_count bigint", add_up,
            ("dt",),
        )
        self.area_counts = KeyedTable(
            spark, f"{root}/area_counts", ["dt", "area", "adid"],
            "dt string, area string, adid string, click_count bigint", add_up, ("dt",),
        )
        self.top3 = KeyedTable(
            spark, f"{root}/top3", ["dt", "area", "rank"],
            "dt string, area string, adid string, click_count bigint, rank int", keep_latest,
        )

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        """A batch of single clicks."""
        # Counted per user first: the filter then joins a few rows per user, and both outputs
        # reuse the result.
        cells = agg.with_day(batch).groupBy("dt", "area", "city", "userid", "adid").agg(
            agg.row_count().alias("n")
        )
        self.add(cells, batch_id)

    def add(self, cells: DataFrame, batch_id: int) -> None:
        """A batch of clicks counted (``n``) per day, place, user and ad."""
        kept = drop_blacklisted(cells, self.blacklist.read(before=batch_id)).persist()
        try:
            # The stored counters are kept by day; the range prunes days, the keys decide.
            first, last = kept.agg(F.min("dt"), F.max("dt")).first()
            if first is None:
                return
            days = F.col("dt").between(first, last)
            self._count(kept, batch_id, days)
            self._extend_blacklist(kept, batch_id, days)
        finally:
            kept.unpersist()
        if (batch_id + 1) % self.compact_every == 0:
            for table in (
                self.counters, self.blacklist, self.city_counts, self.area_counts, self.top3,
            ):
                table.compact(batch_id)

    def _count(self, kept: DataFrame, batch_id: int, days: Column) -> None:
        self.city_counts.write(agg.date_area_city_ad_count(kept, "n", "dt"), batch_id)
        self.area_counts.write(agg.area_ad_rollup(self.city_counts.batch(batch_id)), batch_id)
        # Only what the batch touches: the new totals of its ads, the top lists of its groups.
        ads = self.area_counts.batch(batch_id).select("dt", "area", "adid")
        changed = self.area_counts.read(before=batch_id + 1, where=days, only=ads)
        groups = ads.select("dt", "area").distinct()
        stored = self.top3.read(before=batch_id, where=days, only=groups)
        self.top3.write(merged_daily_top(stored, changed), batch_id)

    def _extend_blacklist(self, kept: DataFrame, batch_id: int, days: Column) -> None:
        self.counters.write(agg.daily_user_ad_clicks(kept, "n", "dt"), batch_id)
        new, keys = self.counters.batch(batch_id), ["dt", "userid", "adid"]
        # The batch's own counters need no look for their keys; only older ones do.
        old = self.counters.read(before=batch_id, where=days, only=new.select(*keys))
        total = new.unionByName(old).groupBy(*keys).agg(F.sum("click_count").alias("click_count"))
        reached = total.where(F.col("click_count") >= self.threshold)
        self.blacklist.write(reached.select("userid").distinct(), batch_id)
