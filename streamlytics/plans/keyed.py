"""Keyed tables filled in batches cut from the time axis, and the table sinks."""

from pyspark.sql import functions as F

from streamlytics.functions.parse import parse_json
from streamlytics.operators import aggregate as agg
from streamlytics.plans import views as v
from streamlytics.plans.clicks import QUERY_THRESHOLD
from streamlytics.plans.registry import query
from streamlytics.session import scratch
from streamlytics.sources.replay import DAY_US, time_slice, time_slice_sql
from streamlytics.streaming import sinks
from streamlytics.streaming.keyed import KeyedTable, add_up, collect_members, keep_latest

BATCHES = 3
CITY_KEY = ["dt", "area", "city", "adid"]


def batch_of(spark, d, slices: int = BATCHES):
    """The part of the events' time range, in whole days, that a row falls into."""
    return time_slice(v.table(spark, d, "events"), "ts", slices, DAY_US)


BATCH_SQL = time_slice_sql("events", "ts", BATCHES, DAY_US)


def _fill(spark, d, name, rows, keys, schema, fold, per_batch):
    """Write one folder per batch, the last one twice, and read the folded table.

    The rows are worked out once and stored by batch; a batch reads its own.
    """
    table = KeyedTable(spark, scratch(spark, name), keys, schema, fold)
    path, cut = scratch(spark, "batches"), rows.withColumn("_batch", batch_of(spark, d))
    cut.write.partitionBy("_batch").parquet(path)
    stored = spark.read.schema(cut.schema).parquet(path)
    for b in [*range(BATCHES), BATCHES - 1]:
        table.write(per_batch(stored.where(F.col("_batch") == b).drop("_batch")), b)
    return table.read()


def _cells(spark, d):
    """Clicks counted before their places are joined; batches are whole days, so a day has one."""
    return v.ads_cells(spark, d).withColumn("ts", F.to_timestamp("dt"))


@query(
    "upsert_latest",
    """SELECT "userId", arg_max("productNum", event_id) AS "productNum" FROM pay_info
    GROUP BY "userId\"""",
    "ev pay_info",
)
def upsert_latest(spark, d):
    def last_per_user(part):
        newest = F.max_by("productNum", F.struct("ts", "event_id")).alias("productNum")
        return part.groupBy("userId").agg(newest)

    return _fill(
        spark, d, "upsert", v.pay_info(spark, d), ["userId"], "userId string, productNum bigint",
        keep_latest, last_per_user,
    )


@query(
    "kv_put_all",
    """SELECT dt || ':' || area || ':' || city || ':' || adid AS key,
    CAST(click_count AS VARCHAR) AS value FROM city_counts""",
    "ev ads_log city_counts",
)
def kv_put_all(spark, d):
    """Counts put as text under their composite key; the running count overwrites."""

    def as_text(part):
        counts = agg.date_area_city_ad_count(part, "n", "dt")
        return counts.select(
            F.concat_ws(":", *CITY_KEY).alias("key"), F.col("click_count").cast("string").alias("value")
        )

    return _fill(
        spark, d, "put", _cells(spark, d), ["key"], "key string, value string", keep_latest, as_text
    )


@query(
    "kv_increment",
    "SELECT userid, adid, count(*) AS click_count FROM ads_log GROUP BY userid, adid",
    "ev ads_log",
)
def kv_increment(spark, d):
    """Counters without the day in the key, so every batch adds to stored ones."""
    log = v.events(spark, d).select(
        F.col("user_id").cast("string").alias("userid"),
        (F.col("k") % 6 + 1).cast("string").alias("adid"), "ts",
    )
    return _fill(
        spark, d, "counter", log, ["userid", "adid"],
        "userid string, adid string, click_count bigint", add_up,
        lambda part: part.groupBy("userid", "adid").agg(F.count(F.lit(1)).alias("click_count")),
    )


@query(
    "kv_set_add",
    f"""SELECT DISTINCT userid FROM ads_log GROUP BY dt, userid, adid
    HAVING count(*) >= {QUERY_THRESHOLD}""",
    "ev ads_log",
)
def kv_set_add(spark, d):
    def over(part):
        many = agg.daily_user_ad_clicks(part, "n", "dt").where(F.col("click_count") >= QUERY_THRESHOLD)
        return many.select("userid").distinct()

    return _fill(
        spark, d, "set", _cells(spark, d), ["userid"], "userid string", collect_members, over
    )


@query(
    "kv_replace_all",
    f"""SELECT adid, count(*) AS click_count FROM ads_log WHERE {BATCH_SQL} =
    (SELECT max({BATCH_SQL}) FROM ads_log) GROUP BY adid""",
    "ev ads_log",
)
def kv_replace_all(spark, d):
    log = v.events(spark, d).select((F.col("k") % 6 + 1).cast("string").alias("adid"), "ts")
    return _fill(
        spark, d, "replace", log, ["adid"], "adid string, click_count bigint", None,
        lambda part: part.groupBy("adid").agg(F.count(F.lit(1)).alias("click_count")),
    )


@query(
    "upsert_wide_column",
    """SELECT "userId" AS rowkey, 'info' AS family, 'productNum' AS qualifier,
    CAST(arg_max("productNum", event_id) AS VARCHAR) AS value FROM pay_info GROUP BY "userId\"""",
    "ev pay_info",
)
def upsert_wide_column(spark, d):
    def cells(part):
        newest = F.max_by("productNum", F.struct("ts", "event_id")).alias("productNum")
        return sinks.to_wide_column(
            part.groupBy("userId").agg(newest), "userId", "info", ["productNum"]
        )

    return _fill(
        spark, d, "cells", v.pay_info(spark, d), ["rowkey", "family", "qualifier"],
        "rowkey string, family string, qualifier string, value string", keep_latest, cells,
    )


@query(
    "sink_partition_insert",
    """SELECT c_name AS name, age, record_time, substr(record_time, 1, 10) AS dt
    FROM user_json""",
    "user_json",
)
def sink_partition_insert(spark, d):
    users = parse_json(v.user_json(spark, d))
    # One partition a day would make thousands of tiny files here; the month is the dt.
    path = scratch(spark, "partitions")
    dated = users.withColumn("day", F.substring("record_time", 1, 10))
    sinks.insert_partition(dated, path, dt=F.substring("record_time", 1, 7))
    read = spark.read.schema("name string, age string, record_time string, day string, dt string")
    return read.parquet(path).select("name", "age", "record_time", F.col("day").alias("dt"))


@query(
    "sink_replace_table",
    """SELECT c_custkey, c_name, c_mktsegment FROM customer
    ORDER BY c_name DESC, c_custkey LIMIT 100""",
)
def sink_replace_table(spark, d):
    c = v.table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    sinks.replace_table(c.limit(0), "streamlytics_users", scratch(spark, "table"))
    table = sinks.replace_table(c, "streamlytics_users", scratch(spark, "table"))
    return table.orderBy(F.desc("c_name"), "c_custkey").limit(100)


@query(
    "sink_documents",
    """SELECT id AS sensor_id, CAST(temperature AS VARCHAR) AS temperature,
    CAST("timestamp" AS VARCHAR) AS ts FROM sensor""",
    "ev sensor",
)
def sink_documents(spark, d):
    """Documents written as JSON lines and read back whole."""
    path = scratch(spark, "documents")
    sinks.write_documents(v.sensor(spark, d), sinks.sensor_document(), path)
    return spark.read.schema("sensor_id string, temperature string, ts string").json(path)
