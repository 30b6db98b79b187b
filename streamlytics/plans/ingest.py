"""Log cleaning, change-data routing, offsets and message projections."""

from pyspark.sql import functions as F

from streamlytics.functions import logs
from streamlytics.plans import views as v
from streamlytics.plans.registry import query
from streamlytics.sources import changes, topics
from streamlytics.streaming import sinks

_TRIM = r"[\x00-\x20]*"
START_SQL = rf"regexp_matches(body, '(?s)^{_TRIM}\{{.*\}}{_TRIM}$')"
EVENT_SQL = rf"""(len(string_split(rtrim(body, '|'), '|')) = 2
    AND regexp_full_match(string_split(body, '|')[1], '[0-9]{{13}}')
    AND regexp_full_match(string_split(body, '|')[2], '(?s){_TRIM}\{{.*\}}{_TRIM}'))"""
TOPIC_SQL = "CASE WHEN contains(body, 'start') THEN 'topic_start' ELSE 'topic_event' END"
CLEAN_SQL = f"CASE WHEN contains(body, 'start') THEN {START_SQL} ELSE {EVENT_SQL} END"


@query("validate_start_log", f"SELECT event_id, {START_SQL} AS ok FROM flume", "ev flume")
def validate_start_log(spark, d):
    return v.flume_events(spark, d).select("event_id", logs.is_start_log(F.col("body")).alias("ok"))


@query("validate_event_log", f"SELECT event_id, {EVENT_SQL} AS ok FROM flume", "ev flume")
def validate_event_log(spark, d):
    return v.flume_events(spark, d).select("event_id", logs.is_event_log(F.col("body")).alias("ok"))


@query("etl_filter_logs", f"SELECT event_id, body FROM flume WHERE {CLEAN_SQL}", "ev flume")
def etl_filter_logs(spark, d):
    return logs.keep_clean_logs(v.flume_events(spark, d)).select("event_id", "body")


@query(
    "route_log_topic",
    f"SELECT event_id, {TOPIC_SQL} AS topic, body FROM flume WHERE {CLEAN_SQL}",
    "ev flume",
)
def route_log_topic(spark, d):
    routed = logs.route_logs(logs.keep_clean_logs(v.flume_events(spark, d)))
    return routed.select("event_id", F.col("headers")["topic"].alias("topic"), "body")


def _json_sql(columns: list[str]) -> str:
    pairs = ", ".join(f"'{c}', CAST({c} AS VARCHAR)" for c in columns)
    return f"CAST(json_object({pairs}) AS VARCHAR)"


_ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
_LINES = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
_CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
_SUPPLIER = ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"]
_PART = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
_USER_OP = "CASE WHEN c_custkey % 2 = 0 THEN 'INSERT' ELSE 'UPDATE' END"

ROUTED_SQL = f"""SELECT 'GMALL_ORDER' AS topic, 'order_info' AS "table", 'INSERT' AS event_type,
    {_json_sql(_ORDERS)} AS after FROM orders
    UNION ALL SELECT 'GMALL_ORDER_DETAIL', 'order_detail', 'INSERT', {_json_sql(_LINES)} FROM lineitem
    UNION ALL SELECT 'GMALL_USER', 'user_info', {_USER_OP}, {_json_sql(_CUSTOMER)} FROM customer"""
CHANGES_SQL = f"""SELECT "table", event_type, after FROM ({ROUTED_SQL})
    UNION ALL SELECT 'base_supplier', 'INSERT', {_json_sql(_SUPPLIER)} FROM supplier
    UNION ALL SELECT 'order_info', 'DELETE', {_json_sql(_PART)} FROM part"""


@query("src_cdc", CHANGES_SQL)
def src_cdc(spark, d):
    rows = changes.changed_rows(v.change_envelopes(spark, d))
    return rows.withColumn("after", changes.after_json("after"))


@query(
    "cdc_route",
    f'SELECT topic, "table", event_type, count(*) AS n FROM ({ROUTED_SQL}) GROUP BY ALL',
)
def cdc_route(spark, d):
    routed = changes.route_changes(changes.changed_rows(v.change_envelopes(spark, d)))
    return routed.groupBy("topic", "table", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("cdc_after_json", f"SELECT topic, after AS value FROM ({ROUTED_SQL})")
def cdc_after_json(spark, d):
    routed = changes.route_changes(changes.changed_rows(v.change_envelopes(spark, d)))
    return routed.select("topic", changes.after_json("after").alias("value"))


@query(
    "sink_kafka",
    f"""SELECT {TOPIC_SQL} AS topic, CAST(event_id AS VARCHAR) AS key, body AS value
    FROM flume WHERE {CLEAN_SQL}""",
    "ev flume",
)
def sink_kafka(spark, d):
    routed = logs.route_logs(logs.keep_clean_logs(v.flume_events(spark, d)))
    return sinks.kafka_records(routed, F.col("headers")["topic"], "body", key="event_id")


@query(
    "to_documents",
    """SELECT event_id, CAST(json_object('sensor_id', id, 'temperature',
    CAST(temperature AS VARCHAR), 'ts', CAST("timestamp" AS VARCHAR)) AS VARCHAR) AS document
    FROM sensor""",
    "ev sensor",
)
def to_documents(spark, d):
    s = v.sensor(spark, d)
    return s.select("event_id", sinks.sensor_document().alias("document"))


@query(
    "to_wide_column",
    """SELECT CAST(c_custkey AS VARCHAR) AS rowkey, 'info' AS family, q AS qualifier, v AS value
    FROM (SELECT c_custkey, 'name' AS q, c_name AS v FROM customer UNION ALL
    SELECT c_custkey, 'age', CAST(c_nationkey AS VARCHAR) FROM customer)""",
)
def to_wide_column(spark, d):
    c = v.table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("age")
    )
    return sinks.to_wide_column(c, "id", "info", ["name", "age"])


@query(
    "offset_reconcile",
    """SELECT topic, grp AS "group", part AS partition, CASE WHEN part < 4 THEN n ELSE 0 END AS "offset"
    FROM (SELECT event_type AS topic, 'g2' AS grp, CAST(user_id % 6 AS INTEGER) AS part,
    count(*) AS n FROM events GROUP BY 1, 2, 3)""",
)
def offset_reconcile(spark, d):
    return topics.reconcile_offsets(*v.offsets(spark, d))


@query(
    "src_kafka_offsets",
    """SELECT event_type AS topic, '{' || string_agg('"' || part || '":' || n, ',' ORDER BY part)
    || '}' AS starting_offsets FROM (SELECT event_type, user_id % 6 AS part,
    CASE WHEN user_id % 6 < 4 THEN count(*) ELSE 0 END AS n FROM events GROUP BY 1, user_id % 6)
    GROUP BY event_type""",
)
def src_kafka_offsets(spark, d):
    return topics.starting_offsets(topics.reconcile_offsets(*v.offsets(spark, d)))
