"""Event-time, session and count windows in batch form, hot items and alerts."""

from pyspark.sql import functions as F

from streamlytics.functions.times import plain
from streamlytics.operators import alerts, counts, topn
from streamlytics.operators import windows as w
from streamlytics.operators.aggregate import nan_min
from streamlytics.plans import views as v
from streamlytics.plans.registry import query

ORDER = ["ts", "event_id"]


def tumbling_sql(src: str, key: str, agg: str, size: str, where: str = "TRUE") -> str:
    return f"""SELECT window_start, window_start + INTERVAL '{size}' AS window_end, {key}, {agg}
    FROM (SELECT *, time_bucket(INTERVAL '{size}', ts) AS window_start FROM {src})
    WHERE {where} GROUP BY window_start, {key}"""


def sliding_sql(src: str, key: str, agg: str, size_s: int, slide_s: int, where="TRUE") -> str:
    return f"""SELECT window_start, window_start + to_seconds({size_s}) AS window_end, {key}, {agg}
    FROM (SELECT *, time_bucket(INTERVAL '{slide_s} seconds', ts)
    - to_seconds(CAST(i * {slide_s} AS INTEGER)) AS window_start
    FROM {src}, range(0, {size_s // slide_s}) r(i)) WHERE {where} GROUP BY window_start, {key}"""


COUNT_SQL = "count(*) AS count"
SUM_SQL = 'CAST(sum("productNum") AS BIGINT) AS "productNum"'
MIN_SQL = "min(temperature) AS temperature"


def total():
    return F.sum("productNum").alias("productNum")


@query("tumbling_event", tumbling_sql("sensor", "id", COUNT_SQL, "2 seconds"), "ev sensor")
def tumbling_event(spark, d):
    n = F.count(F.lit(1)).alias("count")
    return w.bounds(w.window_aggregate(v.sensor(spark, d), ["id"], [n], "2 seconds"))


@query("tumbling_sum", tumbling_sql("pay_info", '"userId"', SUM_SQL, "1 minute"), "ev pay_info")
def tumbling_sum(spark, d):
    return w.bounds(w.window_aggregate(v.pay_info(spark, d), ["userId"], [total()], "1 minute"))


@query("tumbling_sum_6h", tumbling_sql("pay_info", '"userId"', SUM_SQL, "6 hours"), "ev pay_info")
def tumbling_sum_6h(spark, d):
    return w.bounds(w.window_aggregate(v.pay_info(spark, d), ["userId"], [total()], "6 hours"))


@query("sliding_sum", sliding_sql("pay_info", '"userId"', SUM_SQL, 60, 30), "ev pay_info")
def sliding_sum(spark, d):
    return w.bounds(
        w.sliding_sum(v.pay_info(spark, d), ["userId"], "productNum", "1 minute", "30 seconds")
    )


@query("sliding_sum_6h", sliding_sql("pay_info", '"userId"', SUM_SQL, 21600, 3600), "ev pay_info")
def sliding_sum_6h(spark, d):
    return w.bounds(
        w.sliding_sum(v.pay_info(spark, d), ["userId"], "productNum", "6 hours", "1 hour")
    )


def _sliding_min(spark, d, size, slide):
    low = {"temperature": nan_min("temperature")}
    return w.bounds(w.paned_aggregate(v.sensor(spark, d), ["id"], low, low, size, slide))


@query("sliding_min", sliding_sql("sensor", "id", MIN_SQL, 10, 5), "ev sensor")
def sliding_min(spark, d):
    return _sliding_min(spark, d, "10 seconds", "5 seconds")


@query("sliding_min_6h", sliding_sql("sensor", "id", MIN_SQL, 21600, 3600), "ev sensor")
def sliding_min_6h(spark, d):
    return _sliding_min(spark, d, "6 hours", "1 hour")


@query("window_min", tumbling_sql("sensor", "id", MIN_SQL, "10 minutes"), "ev sensor")
def window_min(spark, d):
    low = nan_min("temperature").alias("temperature")
    return w.bounds(w.window_aggregate(v.sensor(spark, d), ["id"], [low], "10 minutes"))


def session_sql(seconds: int) -> str:
    return f"""SELECT "userId", min(ts) AS session_start,
    max(ts) + to_seconds({seconds}) AS session_end, {SUM_SQL} FROM (
    SELECT *, sum(opens) OVER (PARTITION BY "userId" ORDER BY ts, event_id) AS s FROM (
    SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY "userId"
    ORDER BY ts, event_id) <= {seconds * 1000000} THEN 0 ELSE 1 END AS opens FROM pay_info))
    GROUP BY "userId", s"""


@query("session_sum", session_sql(30), "ev pay_info")
def session_sum(spark, d):
    return w.sessions(v.pay_info(spark, d), "userId", "productNum", "30 seconds")


@query("session_sum_6h", session_sql(21600), "ev pay_info")
def session_sum_6h(spark, d):
    return w.sessions(v.pay_info(spark, d), "userId", "productNum", "6 hours")


def count_window_sql(size: int, slide: int) -> str:
    return f"""SELECT "userId", seen, "productNum" FROM (SELECT "userId",
    row_number() OVER u AS seen, CAST(sum("productNum") OVER (u ROWS BETWEEN {size - 1}
    PRECEDING AND CURRENT ROW) AS BIGINT) AS "productNum" FROM pay_info
    WINDOW u AS (PARTITION BY "userId" ORDER BY ts, event_id)) WHERE seen % {slide} = 0"""


@query("count_tumbling", count_window_sql(10, 10), "ev pay_info")
def count_tumbling(spark, d):
    return counts.count_windows(v.pay_info(spark, d), "userId", "productNum", ORDER, 10)


@query("count_sliding", count_window_sql(10, 5), "ev pay_info")
def count_sliding(spark, d):
    return counts.count_windows(v.pay_info(spark, d), "userId", "productNum", ORDER, 10, 5)


VIEWS_SQL = """SELECT "itemId", epoch_us(window_end) // 1000 AS "windowEnd", count FROM (
    {})""".format(
    sliding_sql("user_behavior", '"itemId"', COUNT_SQL, 3600, 300, "behavior = 'pv'")
)
TOP_SQL = f"""SELECT "windowEnd", CAST(rank AS INTEGER) AS rank, "itemId", count FROM (
    SELECT *, row_number() OVER (PARTITION BY "windowEnd" ORDER BY count DESC, "itemId") AS rank
    FROM ({VIEWS_SQL})) WHERE rank <= 3"""


def item_views(spark, d):
    return w.item_view_counts(v.user_behavior(spark, d, only="view"), "1 hour", "5 minutes")


@query("sliding_item_count", VIEWS_SQL, "ev user_behavior")
def sliding_item_count(spark, d):
    return item_views(spark, d)


@query(
    "item_window_count",
    """SELECT "itemId", epoch_us(window_end) // 1000 AS "windowEnd", count FROM ({})""".format(
        sliding_sql("user_behavior", '"itemId"', COUNT_SQL, 60, 10, "behavior = 'pv'")
    ),
    "ev user_behavior",
)
def item_window_count(spark, d):
    return w.item_view_counts(v.user_behavior(spark, d, only="view"), "1 minute", "10 seconds")


@query("hot_items_topn", TOP_SQL, "ev user_behavior")
def hot_items_topn(spark, d):
    return topn.hot_items(item_views(spark, d))


@query(
    "hot_items_report",
    f"""SELECT "windowEnd", '时间：' || strftime(make_timestamp("windowEnd" * 1000),
    '%Y-%m-%d %H:%M:%S') || '.0' || chr(10) || string_agg('No' || rank || ': 商品ID=' || "itemId"
    || ' 浏览量=' || count, chr(10) ORDER BY rank) || chr(10) || repeat('=', 32) AS report
    FROM ({TOP_SQL}) GROUP BY "windowEnd\"""",
    "ev user_behavior",
)
def hot_items_report(spark, d):
    return topn.hot_items_report(topn.hot_items(item_views(spark, d)))


@query(
    "sink_hot_items",
    f"""SELECT "itemId" AS item_id, count, make_timestamp("windowEnd" * 1000) AS record_time
    FROM ({TOP_SQL})""",
    "ev user_behavior",
)
def sink_hot_items(spark, d):
    from streamlytics.streaming.sinks import hot_item_rows

    return hot_item_rows(topn.hot_items(item_views(spark, d)))


# Runs between drops, then the chain of timers inside each run.
ALERT_SQL = """SELECT id, t + 5 AS fired_at FROM chain, (SELECT max("timestamp") AS last FROM sensor)
    WHERE CASE WHEN until IS NULL THEN t + 5 <= last ELSE until > t + 5 END"""
ALERT_HEAD = """RECURSIVE prior AS (SELECT *, lag(temperature) OVER (PARTITION BY id
    ORDER BY ts, event_id) AS p FROM sensor),
    runs AS (SELECT *, count(*) FILTER (WHERE temperature < p) OVER (PARTITION BY id
    ORDER BY ts, event_id) AS run FROM prior),
    ends AS (SELECT id, run, lead(min("timestamp")) OVER (PARTITION BY id ORDER BY run) AS until
    FROM runs GROUP BY id, run),
    rises AS (SELECT r.id, r.run, r."timestamp" AS t, until FROM runs r JOIN ends e
    ON r.id = e.id AND r.run = e.run WHERE temperature > p),
    chain AS (SELECT id, run, until, min(t) AS t FROM rises GROUP BY id, run, until
    UNION ALL SELECT c.id, c.run, c.until, min(r.t) AS t FROM chain c JOIN rises r
    ON r.id = c.id AND r.run = c.run AND r.t > c.t + 5 GROUP BY c.id, c.run, c.until)"""


def _alert_oracle() -> str:
    from streamlytics.plans.views import VIEW_SQL

    head = ALERT_HEAD.replace(
        "RECURSIVE", f"RECURSIVE ev AS ({VIEW_SQL['ev']}), sensor AS ({VIEW_SQL['sensor']}),", 1
    )
    return f"""WITH {head} SELECT *, 'temperature of ' || id || ' keeps rising' AS alert
    FROM ({ALERT_SQL})"""


@query("temp_rise_alert", _alert_oracle())
def temp_rise_alert(spark, d):
    return alerts.alert_text(alerts.temp_rise_alerts(v.sensor(spark, d), ORDER))


def ttl_sql(gap_s: int) -> str:
    """One update per key and 5 s batch; a pause of the expiry or more starts from zero."""
    return f"""SELECT key, "at", CAST(sum(n) OVER (PARTITION BY key, run ORDER BY "at") AS BIGINT)
    AS count FROM (SELECT *, sum(fresh) OVER (PARTITION BY key ORDER BY "at") AS run FROM (
    SELECT *, CASE WHEN "at" - lag("at") OVER (PARTITION BY key ORDER BY "at") < to_seconds({gap_s})
    THEN 0 ELSE 1 END AS fresh FROM (SELECT event_type AS key,
    time_bucket(INTERVAL '5 seconds', ts) + to_seconds(5) AS "at", count(*) AS n FROM events
    GROUP BY 1, 2)))"""


def _ttl(spark, d, expiry):
    from streamlytics.streaming.state import ttl_counts

    updates = v.events(spark, d).select(F.col("event_type").alias("key"), "ts")
    return ttl_counts(updates, expiry).withColumn("at", plain("at"))


@query("kv_ttl_count", ttl_sql(20))
def kv_ttl_count(spark, d):
    return _ttl(spark, d, "20 seconds")


@query("kv_ttl_count_30m", ttl_sql(1800))
def kv_ttl_count_30m(spark, d):
    return _ttl(spark, d, "30 minutes")
