"""Click blacklisting: who is listed, from when, and which clicks that leaves.

A user is listed for good once a (day, user, ad) counter reaches the threshold. The list acts
from the next batch on, so rows of the crossing batch still count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlytics.operators.aggregate import daily_user_ad_clicks

# Fixed value: the default click threshold.
THRESHOLD = 100


def blacklisted_users(
    log: DataFrame,
    threshold: int = THRESHOLD,
    weight: str | None = None,
    day: str | None = None,
) -> DataFrame:
    """Every user whose unfiltered counter reaches the threshold on some day."""
    reached = daily_user_ad_clicks(log, weight, day).where(F.col("click_count") >= threshold)
    return reached.select("userid").distinct()


def drop_blacklisted(log: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Anti join on the user id. A list that ``broadcast_if_few`` found small costs no shuffle;
    otherwise Spark splits a hot user's rows when it shuffles them."""
    return log.join(blacklist.select("userid"), "userid", "left_anti").select(*log.columns)


def first_listed(
    log: DataFrame, batch: str, threshold: int = THRESHOLD, user: str = "userid"
) -> DataFrame:
    """(user, listed_in): the first batch at whose end the user is listed.

    ``log`` holds counted rows (``n``). A counter belongs to one day and a batch covers whole
    days, so the counters of a batch do not depend on earlier ones. Up to that batch none of
    the user's rows was dropped, hence the unfiltered counts are the true ones.
    """
    counts = log.groupBy(batch, "dt", user, "adid").agg(F.sum("n").alias("_n"))
    reached = counts.where(F.col("_n") >= threshold)
    return reached.groupBy(user).agg(F.min(batch).alias("listed_in"))


def kept_with_feedback(
    log: DataFrame, batch: str, threshold: int = THRESHOLD, user: str = "userid"
) -> DataFrame:
    """The rows the running app counts: those up to and including the listing batch.

    A join and not a window per user, so that a user with very many rows can be split.
    """
    joined = log.join(first_listed(log, batch, threshold, user), user, "left")
    keep = F.col("listed_in").isNull() | (F.col(batch) <= F.col("listed_in"))
    return joined.where(keep).select(*log.columns)
