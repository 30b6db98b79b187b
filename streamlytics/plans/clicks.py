"""Ad-click analytics."""

from pyspark.sql import functions as F

from streamlytics.functions.text import composite_key, key_part
from streamlytics.functions.times import plain
from streamlytics.operators import aggregate as agg
from streamlytics.operators import blacklist as bl
from streamlytics.operators.enrich import broadcast_if_few
from streamlytics.operators.topn import daily_area_top
from streamlytics.operators.windows import minute_trend
from streamlytics.plans import views as v
from streamlytics.plans.registry import query
from streamlytics.session import pin

# The test data peaks at a handful of clicks per (day, user, ad), so queries use a low bar.
QUERY_THRESHOLD = 3

TOP3_SQL = """SELECT dt, area, adid, click_count, CAST(rank AS INTEGER) AS rank FROM (
    SELECT dt, area, adid, CAST(sum(click_count) AS BIGINT) AS click_count,
    row_number() OVER (PARTITION BY dt, area ORDER BY sum(click_count) DESC, adid) AS rank
    FROM {src} GROUP BY dt, area, adid) WHERE rank <= 3"""


def _city_counts(spark, d):
    return agg.date_area_city_ad_count(v.ads_cells(spark, d), "n", "dt")


@query("daily_area_top3", TOP3_SQL.format(src="city_counts"), "ev ads_log city_counts")
def daily_area_top3(spark, d):
    return daily_area_top(_city_counts(spark, d))


@query("date_area_city_ad_count", "SELECT * FROM city_counts", "ev ads_log city_counts")
def date_area_city_ad_count(spark, d):
    return _city_counts(spark, d)


@query(
    "area_ad_rollup",
    """SELECT dt, area, adid, CAST(sum(click_count) AS BIGINT) AS click_count
    FROM city_counts GROUP BY dt, area, adid""",
    "ev ads_log city_counts",
)
def area_ad_rollup(spark, d):
    return agg.area_ad_rollup(_city_counts(spark, d))


@query(
    "daily_user_ad_clicks",
    "SELECT dt, userid, adid, count(*) AS click_count FROM ads_log GROUP BY dt, userid, adid",
    "ev ads_log",
)
def daily_user_ad_clicks(spark, d):
    return agg.daily_user_ad_clicks(v.ads_cells(spark, d), "n", "dt")


@query(
    "composite_key",
    """SELECT dt || ':' || area || ':' || city || ':' || adid AS key, dt, area, city, adid,
    click_count FROM city_counts""",
    "ev ads_log city_counts",
)
def composite_key_query(spark, d):
    counts = _city_counts(spark, d)
    keyed = counts.select(composite_key("dt", "area", "city", "adid").alias("key"), "click_count")
    names = ["dt", "area", "city", "adid"]
    return keyed.select("key", *[key_part("key", i).alias(n) for i, n in enumerate(names)], "click_count")


_LISTED = f"""SELECT DISTINCT userid FROM ads_log GROUP BY dt, userid, adid
    HAVING count(*) >= {QUERY_THRESHOLD}"""


@query(
    "blacklist_filter",
    f"""SELECT event_id, "timestamp", area, city, userid, adid FROM ads_log
    WHERE userid NOT IN ({_LISTED})""",
    "ev ads_log",
)
def blacklist_filter(spark, d):
    # Worked out once, so that its size is known before the log is joined.
    listed = bl.blacklisted_users(v.ads_cells(spark, d), QUERY_THRESHOLD, "n", "dt")
    listed = broadcast_if_few(pin(listed))
    log = v.ads_log(spark, d).select("event_id", "timestamp", "area", "city", "userid", "adid")
    return bl.drop_blacklisted(log, listed)


_FEEDBACK = f"""listed AS (SELECT userid, min(dt) AS listed_in FROM (
    SELECT dt, userid, adid FROM ads_log GROUP BY dt, userid, adid
    HAVING count(*) >= {QUERY_THRESHOLD}) GROUP BY userid),
    kept AS (SELECT a.* FROM ads_log a LEFT JOIN listed l USING (userid)
    WHERE listed_in IS NULL OR dt <= listed_in)"""


def with_feedback_sql(body: str) -> str:
    from streamlytics.plans.views import VIEW_SQL

    return f"WITH ev AS ({VIEW_SQL['ev']}), ads_log AS ({VIEW_SQL['ads_log']}), {_FEEDBACK} {body}"


@query("blacklist_update", with_feedback_sql("SELECT userid, listed_in FROM listed"))
def blacklist_update(spark, d):
    listed = bl.first_listed(v.ads_cells(spark, d), "dt", QUERY_THRESHOLD)
    return listed.select("userid", "listed_in")


@query(
    "ads_pipeline",
    with_feedback_sql(
        """, city_kept AS (SELECT dt, area, city, adid, count(*) AS click_count FROM kept
        GROUP BY dt, area, city, adid) """ + TOP3_SQL.format(src="city_kept")
    ),
)
def ads_pipeline(spark, d):
    """The whole app with one batch a day: filter with feedback, count, rank."""
    # By the number, not its text: both sides of the join then start from the same shuffle.
    kept = bl.kept_with_feedback(v.ads_cells(spark, d), "dt", QUERY_THRESHOLD, user="user_id")
    return daily_area_top(agg.date_area_city_ad_count(kept, "n", "dt"))


def trend_sql(minutes: int, slide: int) -> str:
    return f"""SELECT window_start, window_start + INTERVAL '{minutes} minutes' AS window_end,
    adid, '[' || string_agg('{{"' || hm || '":' || CAST(n AS VARCHAR) || '}}', ','
    ORDER BY hm) || ']' AS trend FROM (
    SELECT time_bucket(INTERVAL '{slide} minutes', ts) - to_minutes(CAST(i * {slide} AS INTEGER)) AS window_start,
    adid, hm, count(*) AS n FROM ads_log, range(0, {minutes // slide}) r(i)
    GROUP BY ALL) GROUP BY window_start, adid"""


def _trend(spark, d, size, slide):
    out = minute_trend(
        v.events(spark, d).select(
            F.unix_millis("ts").alias("timestamp"),
            (F.col("k") % 6 + 1).cast("string").alias("adid"),
        ),
        size, slide,
    )
    return out.select(
        plain("window.start").alias("window_start"), plain("window.end").alias("window_end"),
        "adid", "trend",
    )


@query("minute_trend", trend_sql(3, 1), "ev ads_log")
def minute_trend_3m(spark, d):
    return _trend(spark, d, "3 minutes", "1 minute")


@query("minute_trend_hour", trend_sql(60, 20), "ev ads_log")
def minute_trend_hour(spark, d):
    return _trend(spark, d, "1 hour", "20 minutes")


@query(
    "group_collect",
    """SELECT adid, '[' || string_agg('{"' || hm || '":' || CAST(n AS VARCHAR) || '}', ','
    ORDER BY hm) || ']' AS trend, count(*) AS minutes FROM (
    SELECT adid, hm, count(*) AS n FROM ads_log GROUP BY adid, hm) GROUP BY adid""",
    "ev ads_log",
)
def group_collect(spark, d):
    log = v.events(spark, d)
    minutes = log.groupBy(
        (F.col("k") % 6 + 1).cast("string").alias("adid"),
        F.date_format("ts", "HH:mm").alias("hm"),
    ).agg(F.count(F.lit(1)).alias("n"))
    lists = agg.minute_lists(minutes, ["adid"])
    return lists.select(
        "adid", agg.trend_json("trend").alias("trend"),
        F.size("trend").cast("bigint").alias("minutes"),
    )


@query(
    "fn_pair_list_json",
    """SELECT city, dt, '[' || string_agg('{"' || hm || '":' || CAST(n AS VARCHAR) || '}', ','
    ORDER BY hm) || ']' AS trend FROM (
    SELECT city, dt, hm, count(*) AS n FROM ads_log GROUP BY city, dt, hm) GROUP BY city, dt""",
    "ev ads_log",
)
def fn_pair_list_json(spark, d):
    log = v.ads_log(spark, d)
    minutes = agg.with_day(log).groupBy("city", "dt", F.date_format("ts", "HH:mm").alias("hm")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return agg.minute_lists(minutes, ["city", "dt"]).withColumn("trend", agg.trend_json("trend"))
