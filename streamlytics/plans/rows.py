"""Projections, parsing, filters, routing, lookups and scalar functions on whole tables."""

from pyspark.sql import functions as F

from streamlytics import schemas
from streamlytics.functions import parse, text, times
from streamlytics.operators import aggregate as agg
from streamlytics.operators import enrich, route
from streamlytics.plans import views as v
from streamlytics.plans.registry import query
from streamlytics.sources import tables


@query("project_map", "SELECT id, temperature FROM sensor", "ev sensor")
def project_map(spark, d):
    return v.sensor(spark, d).select("id", "temperature")


@query(
    "src_collection",
    """SELECT s.id, room, count(*) AS readings FROM sensor s JOIN (VALUES ('sensor_1', 'hall'),
    ('sensor_6', 'cellar'), ('sensor_7', 'roof'), ('sensor_10', 'yard')) r(id, room)
    ON s.id = r.id GROUP BY s.id, room""",
    "ev sensor",
)
def src_collection(spark, d):
    """A literal collection of rooms, joined to every reading."""
    rooms = tables.from_collection(
        spark,
        [("sensor_1", "hall"), ("sensor_6", "cellar"), ("sensor_7", "roof"), ("sensor_10", "yard")],
        "id string, room string",
    )
    # Counting first leaves one row per sensor for the join, however hot a sensor is.
    counts = v.sensor(spark, d).groupBy("id").agg(F.count(F.lit(1)).alias("readings"))
    return counts.join(rooms, "id").select("id", "room", "readings")


@query(
    "parse_space_log",
    """SELECT event_id, "timestamp", replace(area, ' ', '_') AS area, city, userid, adid
    FROM ads_log""",
    "ev ads_log",
)
def parse_space_log(spark, d):
    # The format has no quoting, so a name with a blank is written with an underscore.
    log = v.ads_log(spark, d).withColumn("area", F.replace("area", F.lit(" "), F.lit("_")))
    line = F.concat_ws(" ", *schemas.ADS_LOG.fieldNames()).alias("value")
    return parse.parse_ads_log(log.select("event_id", line), keep=("event_id",))


@query("parse_csv_record", 'SELECT event_id, id, "timestamp", temperature FROM sensor', "ev sensor")
def parse_csv_record(spark, d):
    line = F.concat_ws(", ", *schemas.SENSOR.fieldNames()).alias("value")
    return parse.parse_delimited(
        v.sensor(spark, d).select("event_id", line), schemas.SENSOR, keep=("event_id",)
    )


def _mixed_lines(spark, d):
    """Sensor lines of which the hot ones carry a unit, so their last field is no number."""
    unit = F.when(F.col("temperature") > 300, F.lit(" F")).otherwise("")
    return v.sensor(spark, d).select(
        F.concat(F.concat_ws(", ", *schemas.SENSOR.fieldNames()), unit).alias("value")
    )


@query(
    "parse_csv_lenient",
    'SELECT id, "timestamp", temperature FROM sensor WHERE temperature <= 300',
    "ev sensor",
)
def parse_csv_lenient(spark, d):
    return parse.parse_delimited_lenient(_mixed_lines(spark, d), schemas.SENSOR)[0]


@query(
    "parse_csv_rejects",
    """SELECT id || ', ' || "timestamp" || ', ' || temperature || ' F' AS value FROM sensor
    WHERE temperature > 300""",
    "ev sensor",
)
def parse_csv_rejects(spark, d):
    return parse.parse_delimited_lenient(_mixed_lines(spark, d), schemas.SENSOR)[1]


@query(
    "parse_json_record",
    "SELECT o_orderkey, c_name AS name, age, record_time FROM user_json",
    "user_json",
)
def parse_json_record(spark, d):
    return parse.parse_json(v.user_json(spark, d), keep=("o_orderkey",))


@query(
    "filter_equals",
    'SELECT event_id, "userId", "itemId", behavior FROM user_behavior WHERE behavior = \'pv\'',
    "ev user_behavior",
)
def filter_equals(spark, d):
    return v.user_behavior(spark, d, only="view").where(F.col("behavior") == "pv").select(
        "event_id", "userId", "itemId", "behavior"
    )


@query(
    "filter_contains",
    "SELECT page_id, url, 'blog' AS topic FROM pages WHERE contains(url, 'blog.')",
)
def filter_contains(spark, d):
    p = v.table(spark, d, "pages")
    return p.where(text.contains_text(F.col("url"), "blog.")).select(
        "page_id", "url", F.lit("blog").alias("topic")
    )


@query(
    "filter_prefix",
    "SELECT event_id, id, temperature FROM sensor WHERE id LIKE 'sensor\\_1%' ESCAPE '\\'",
    "ev sensor",
)
def filter_prefix(spark, d):
    s = v.sensor(spark, d).select("event_id", "id", "temperature")
    return s.where(F.col("id").startswith("sensor_1"))


@query(
    "co_map_streams",
    """SELECT id, CASE WHEN temperature > 30 THEN temperature END AS temperature,
    CASE WHEN temperature > 30 THEN 'high temperature warning' ELSE 'healthy' END AS message
    FROM sensor""",
    "ev sensor",
)
def co_map_streams(spark, d):
    return route.co_map(route.tag_high_low(v.sensor(spark, d)))


@query(
    "split_high_low",
    """SELECT event_id, id, temperature, CASE WHEN temperature > 30 THEN 'high' ELSE 'low' END
    AS tag FROM sensor""",
    "ev sensor",
)
def split_high_low(spark, d):
    return route.tag_high_low(v.sensor(spark, d).select("event_id", "id", "temperature"))


@query(
    "select_high",
    "SELECT event_id, id, temperature FROM sensor WHERE temperature > 30",
    "ev sensor",
)
def select_high(spark, d):
    tagged = route.tag_high_low(v.sensor(spark, d).select("event_id", "id", "temperature"))
    return route.select_tags(tagged, "high")


@query("union_streams", "SELECT event_id, id, temperature FROM sensor", "ev sensor")
def union_streams(spark, d):
    tagged = route.tag_high_low(v.sensor(spark, d).select("event_id", "id", "temperature"))
    return route.union_all(route.select_tags(tagged, "high"), route.select_tags(tagged, "low"))


@query(
    "side_output_alerts",
    """SELECT event_id, id, 'freezing alert for ' || id AS alert FROM sensor
    WHERE temperature < 32.0""",
    "ev sensor",
)
def side_output_alerts(spark, d):
    return route.freezing_alerts(v.sensor(spark, d))[1].select("event_id", "id", "alert")


@query(
    "side_output_main",
    'SELECT event_id, id, "timestamp", temperature FROM sensor',
    "ev sensor",
)
def side_output_main(spark, d):
    return route.freezing_alerts(v.sensor(spark, d))[0].drop("ts")


@query(
    "refreshable_lookup",
    """SELECT event_id, CAST(user_id AS VARCHAR) AS userid, event_type,
    CASE WHEN c_mktsegment = 'BUILDING' THEN c_name END AS rule,
    coalesce(c_mktsegment = 'BUILDING', FALSE) AS matched
    FROM ev LEFT JOIN customer ON user_id = c_custkey""",
    "ev",
)
def refreshable_lookup(spark, d):
    """The customers of one market segment are the rules."""
    rules = v.table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").cast("string").alias("userid"), F.col("c_name").alias("rule")
    )
    log = v.events(spark, d).select(
        "event_id", F.col("user_id").cast("string").alias("userid"), "event_type"
    )
    return enrich.match_rules(log, enrich.broadcast_if_few(rules), "userid")


@query(
    "rolling_reduce",
    """SELECT event_id, id, first_value("timestamp") OVER w AS "timestamp",
    round(sum(temperature) OVER w, 6) AS temperature FROM sensor
    WINDOW w AS (PARTITION BY id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""",
    "ev sensor",
)
def rolling_reduce(spark, d):
    out = agg.rolling_reduce(v.sensor(spark, d), ["ts", "event_id"])
    return out.select(
        "event_id", "id", "timestamp", F.round("temperature", 6).alias("temperature")
    )


@query(
    "avg_truncated",
    """SELECT "itemId", CAST(sum("timestamp") // count(*) AS DOUBLE) AS avg_truncated,
    round(CAST(sum("timestamp") AS DOUBLE) / count(*), 3) AS avg_exact
    FROM user_behavior GROUP BY "itemId\"""",
    "ev user_behavior",
)
def avg_truncated(spark, d):
    out = agg.avg_truncated(v.user_behavior(spark, d), "itemId")
    return out.withColumn("avg_exact", F.round("avg_exact", 3))


@query(
    "fn_string",
    """SELECT event_id, split_part(props, ':', 1) AS head, trim(split_part(props, ':', 2)) AS tail,
    contains(event_type, 'ur') AS has_ur, starts_with(event_type, 'cl') AS is_cl,
    ends_with(event_type, 'up') AS is_up, CAST(length(props) AS INTEGER) AS n,
    regexp_full_match(CAST(ms AS VARCHAR), '[0-9]{13}') AS digits,
    substr(strftime(ts, '%Y-%m-%d %H:%M:%S'), 15, 2) AS minute,
    event_type || ':' || user_id AS joined FROM ev""",
    "ev",
)
def fn_string(spark, d):
    e = v.events(spark, d)
    parts = text.split_fields(F.col("props"), ":")
    stamp = F.date_format("ts", times.DATETIME)
    return e.select(
        "event_id", parts[0].alias("head"), F.trim(parts[1]).alias("tail"),
        text.contains_text(F.col("event_type"), "ur").alias("has_ur"),
        F.col("event_type").startswith("cl").alias("is_cl"),
        F.col("event_type").endswith("up").alias("is_up"), F.length("props").alias("n"),
        F.unix_millis("ts").cast("string").rlike(r"\A[0-9]{13}\z").alias("digits"),
        F.substring(stamp, 15, 2).alias("minute"),
        text.composite_key("event_type", "user_id").alias("joined"),
    )


@query("fn_epoch_to_day", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS dt FROM ev", "ev")
def fn_epoch_to_day(spark, d):
    return v.events(spark, d).select("event_id", times.day_of(F.unix_millis("ts")).alias("dt"))


@query("fn_epoch_to_minute", "SELECT event_id, strftime(ts, '%H:%M') AS hm FROM ev", "ev")
def fn_epoch_to_minute(spark, d):
    return v.events(spark, d).select("event_id", times.minute_of(F.unix_millis("ts")).alias("hm"))


@query(
    "fn_datetime_convert",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS as_text,
    epoch_us(o_orderdate) // 1000 AS as_millis FROM orders""",
)
def fn_datetime_convert(spark, d):
    o = v.table(spark, d, "orders")
    as_text = o.select(
        "o_orderkey",
        times.millis_to_datetime(F.unix_millis(F.col("o_orderdate").cast("timestamp"))).alias("as_text"),
    )
    return as_text.withColumn("as_millis", times.datetime_to_millis("as_text"))


@query(
    "fn_seconds_to_ts",
    'SELECT event_id, make_timestamp("timestamp" * 1000000) AS event_time FROM sensor',
    "ev sensor",
)
def fn_seconds_to_ts(spark, d):
    return v.sensor(spark, d).select(
        "event_id", times.plain(times.from_seconds("timestamp")).alias("event_time")
    )


@query(
    "fn_min_double",
    "SELECT l_orderkey, min(least(l_discount, l_tax)) AS low FROM lineitem GROUP BY l_orderkey",
)
def fn_min_double(spark, d):
    li = v.table(spark, d, "lineitem").select(
        "l_orderkey", F.least("l_discount", "l_tax").alias("low")
    )
    return li.groupBy("l_orderkey").agg(agg.nan_min("low").alias("low"))


@query(
    "fn_number_format",
    """SELECT event_id, CAST(value AS VARCHAR) AS as_text, CAST(ms AS VARCHAR) AS ms_text,
    ms AS as_long, k AS as_int, value AS as_double FROM ev""",
    "ev",
)
def fn_number_format(spark, d):
    e = v.events(spark, d).select(
        "event_id", F.col("value").cast("string").alias("as_text"),
        F.unix_millis("ts").cast("string").alias("ms_text"), F.col("k").cast("string").alias("k"),
    )
    return e.select(
        "event_id", "as_text", "ms_text", F.col("ms_text").cast("bigint").alias("as_long"),
        F.col("k").cast("int").alias("as_int"), F.col("as_text").cast("double").alias("as_double"),
    )


@query(
    "latest_value",
    """SELECT coalesce((SELECT value FROM events WHERE ts > TIMESTAMP '2024-01-10'
    ORDER BY ts DESC, event_id DESC LIMIT 1), 0.0) AS wqi""",
)
def latest_value(spark, d):
    e = v.table(spark, d, "events").select(
        F.col("ts").alias("record_time"), F.col("value").cast("string").alias("wqi"), "event_id"
    )
    since = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    return tables.latest_value(e, since, then="event_id")


@query(
    "latest_value_none",
    "SELECT coalesce((SELECT max(value) FROM events WHERE ts > TIMESTAMP '2999-01-01'), 0.0) AS wqi",
)
def latest_value_none(spark, d):
    e = v.table(spark, d, "events").select(
        F.col("ts").alias("record_time"), F.col("value").cast("string").alias("wqi")
    )
    return tables.latest_value(e, F.lit("2999-01-01 00:00:00").cast("timestamp_ntz"))


@query(
    "src_wide_column",
    """SELECT CAST(c_custkey AS VARCHAR) AS rowkey, c_name AS name,
    CASE WHEN c_nationkey > 3 THEN CAST(c_nationkey AS VARCHAR) END AS age FROM customer""",
)
def src_wide_column(spark, d):
    """Customers as cells, some without an age, and back."""
    from streamlytics.streaming.sinks import to_wide_column

    c = v.table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.when(F.col("c_nationkey") > 3, F.col("c_nationkey")).alias("age"),
    )
    return tables.read_wide_column(to_wide_column(c, "id", "info", ["name", "age"]), "info", ["name", "age"])
