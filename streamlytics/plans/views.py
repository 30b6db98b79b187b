"""The given tables in the shape the operators expect, in Spark and as SQL text.

Zone-free timestamps become instants here and nowhere else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlytics.functions.text import text_map, words_of
from streamlytics.functions.times import day_of
from streamlytics.schemas import TABLES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def event_time() -> Column:
    return F.col("ts").cast("timestamp").alias("ts")


def event_k() -> Column:
    return F.get_json_object("props", "$.k").cast("int").alias("k")


def shape_events(events: DataFrame) -> DataFrame:
    """Works on the stream of the events table too."""
    return events.select(
        "event_id", event_time(), "user_id", "event_type", "value", event_k(), "props"
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape_events(table(spark, sf_dir, "events"))


def with_places(rows: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Add city and area by ``user_id``.

    Joined one table at a time, so Spark knows each size: nation and region are broadcast, and
    customer is as long as it stays below the broadcast threshold.
    """
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        rows.join(customer, F.col("user_id") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .withColumns({"area": F.col("r_name"), "city": F.col("n_name")})
    )


def ads_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event."""
    return with_places(events(spark, sf_dir), spark, sf_dir).select(
        F.unix_millis("ts").alias("timestamp"), "area", "city",
        F.col("user_id").cast("string").alias("userid"),
        (F.col("k") % 6 + 1).cast("string").alias("adid"),
        "event_type", "event_id", "ts",
    )


def ads_cells(spark: SparkSession, sf_dir: str, only: str | None = None) -> DataFrame:
    """The ad log counted per (day, user, ad) before its places are joined.

    Counting combines on the map side, so a user with a third of all clicks enters the join
    with one row per day and ad. ``only`` restricts the event type, in the scan.
    """
    e = events(spark, sf_dir)
    if only:
        e = e.where(F.col("event_type") == only)
    return shape_cells(e, spark, sf_dir)


def shape_cells(e: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of any events, such as one batch of them."""
    cells = e.groupBy(
        day_of(F.unix_millis("ts")).alias("dt"), "user_id", (F.col("k") % 6 + 1).alias("ad")
    ).agg(F.count(F.lit(1)).alias("n"))
    return with_places(cells, spark, sf_dir).select(
        "dt", "area", "city", "user_id", F.col("user_id").cast("string").alias("userid"),
        F.col("ad").cast("string").alias("adid"), "n",
    )


def shape_sensor(e: DataFrame) -> DataFrame:
    return e.select(
        F.concat(F.lit("sensor_"), F.col("user_id") % 10 + 1).alias("id"),
        F.unix_seconds("ts").alias("timestamp"), F.col("value").alias("temperature"),
        "event_id", "ts",
    )


def sensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape_sensor(events(spark, sf_dir))


def shape_pay(e: DataFrame) -> DataFrame:
    return e.where(F.col("event_type") == "purchase").select(
        F.col("user_id").cast("string").alias("userId"),
        F.col("k").cast("bigint").alias("productNum"), "event_id", "ts",
    )


def pay_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape_pay(events(spark, sf_dir))


# How event types stand for behaviours.
BEHAVIOR = {"view": "pv", "purchase": "buy", "click": "cart", "signup": "fav"}


def shape_behavior(e: DataFrame) -> DataFrame:
    behavior = F.lit("error")
    for event_type, name in BEHAVIOR.items():
        behavior = F.when(F.col("event_type") == event_type, F.lit(name)).otherwise(behavior)
    return e.select(
        F.col("user_id").alias("userId"), (F.col("k") % 20).cast("bigint").alias("itemId"),
        (F.col("k") % 10).alias("categoryId"), behavior.alias("behavior"),
        F.unix_seconds("ts").alias("timestamp"), "event_id", "ts",
    )


def user_behavior(spark: SparkSession, sf_dir: str, only: str | None = None) -> DataFrame:
    """``only`` names the event type to read, so that the scan can filter on it."""
    e = events(spark, sf_dir)
    return shape_behavior(e.where(F.col("event_type") == only) if only else e)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every conversation turn."""
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line")
    )


def words(spark: SparkSession, sf_dir: str, drop_empty: bool = False) -> DataFrame:
    """Every word of every line, with its place: (conv_id, turn, line_no, pos) is unique."""
    out = lines(spark, sf_dir).select(
        "conv_id", "turn", "line_no", F.posexplode(words_of(F.col("line"))).alias("pos", "word")
    )
    return out.where(F.col("word") != "") if drop_empty else out


def document_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "documents").select(
        F.explode(F.split("text", "\n", -1)).alias("line")
    )
    return line.select(F.explode(words_of(F.col("line"))).alias("word"))


def flume_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines in the app formats; ``error`` events give two kinds of bad line."""
    e = events(spark, sf_dir)
    ms = F.unix_millis("ts").cast("string")
    line = F.concat(ms, F.lit("|"), F.col("props"))
    start = F.concat(F.lit('{"en":"start","u":'), F.col("user_id"), F.lit("}"))
    short_time = F.concat(F.substring(ms, 1, 12), F.lit("|"), F.col("props"))
    open_brace = F.concat(ms, F.lit("|"), F.substring(F.col("props"), 1, 5))
    body = (
        F.when(F.col("event_type") == "signup", start)
        .when(F.col("event_type") != "error", line)
        .when(F.col("k") % 2 == 0, short_time)
        .otherwise(open_brace)
    )
    headers = F.create_map(F.lit("event_id"), F.col("event_id").cast("string"))
    return e.select("event_id", headers.alias("headers"), body.alias("body"))


def change_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table rows as change envelopes, plus transaction marks that carry no rows."""

    def envelope(name: str, target: str, event_type, entry: str = "ROWDATA") -> DataFrame:
        t = table(spark, sf_dir, name)
        return t.select(
            F.lit(entry).alias("entry_type"), F.lit(target).alias("table"),
            event_type.alias("event_type"), F.array(text_map(t.columns)).alias("rows"),
        )

    user_op = F.when(F.col("c_custkey") % 2 == 0, F.lit("INSERT")).otherwise("UPDATE")
    parts = [
        envelope("orders", "order_info", F.lit("INSERT")),
        envelope("lineitem", "order_detail", F.lit("INSERT")),
        envelope("customer", "user_info", user_op),
        envelope("supplier", "base_supplier", F.lit("INSERT")),
        envelope("part", "order_info", F.lit("DELETE")),
        envelope("nation", "order_info", F.lit("INSERT"), "TRANSACTIONBEGIN"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def user_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey",
        F.to_json(
            F.struct(
                F.col("c_name").alias("name"), F.col("c_nationkey").cast("string").alias("age"),
                F.col("o_orderdate").cast("string").alias("record_time"),
            )
        ).alias("value"),
    )


def offsets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(live partitions, saved offsets): event types are topics, six partitions by user id, of
    which four have been read so far."""
    e = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("topic"), F.lit("g2").alias("group"),
        (F.col("user_id") % 6).cast("int").alias("partition"),
    )
    live = e.distinct()
    saved = e.where("partition < 4").groupBy("topic", "group", "partition").agg(
        F.count(F.lit(1)).alias("offset")
    )
    return live, saved


_DAY = "strftime(ts, '%Y-%m-%d')"
_SPLIT_WORDS = (
    "CASE WHEN {l} = '' THEN [''] WHEN rtrim({l}, ' ') = '' THEN [] "
    "ELSE string_split(rtrim({l}, ' '), ' ') END"
)

VIEW_SQL = {
    "ev": """SELECT event_id, ts, user_id, event_type, value, props,
        CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
        epoch_us(ts) // 1000 AS ms, epoch_us(ts) // 1000000 AS sec FROM events""",
    "ads_log": f"""SELECT ms AS "timestamp", r_name AS area, n_name AS city,
        CAST(user_id AS VARCHAR) AS userid, CAST(k % 6 + 1 AS VARCHAR) AS adid, event_type,
        event_id, ts, {_DAY} AS dt, strftime(ts, '%H:%M') AS hm
        FROM ev JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "city_counts": """SELECT dt, area, city, adid, count(*) AS click_count FROM ads_log
        GROUP BY dt, area, city, adid""",
    "click_counts": """SELECT dt, area, city, adid, count(*) AS click_count FROM ads_log
        WHERE event_type = 'click' GROUP BY dt, area, city, adid""",
    "sensor": """SELECT 'sensor_' || CAST(user_id % 10 + 1 AS VARCHAR) AS id,
        sec AS "timestamp", value AS temperature, event_id, ts FROM ev""",
    "pay_info": """SELECT CAST(user_id AS VARCHAR) AS "userId", CAST(k AS BIGINT)
        AS "productNum", event_id, ts FROM ev WHERE event_type = 'purchase'""",
    "user_behavior": """SELECT user_id AS "userId", CAST(k % 20 AS BIGINT) AS "itemId",
        k % 10 AS "categoryId", CASE event_type WHEN 'view' THEN 'pv' WHEN 'purchase' THEN 'buy'
        WHEN 'click' THEN 'cart' WHEN 'signup' THEN 'fav' ELSE 'error' END AS behavior,
        sec AS "timestamp", event_id, ts FROM ev""",
    "conv_lines": """SELECT conv_id, turn, CAST(generate_subscripts(l, 1) - 1 AS INTEGER)
        AS line_no, unnest(l) AS line FROM
        (SELECT conv_id, turn, string_split(text, chr(10)) AS l FROM conversations)""",
    "words": f"""SELECT conv_id, turn, line_no,
        CAST(generate_subscripts(w, 1) - 1 AS INTEGER) AS pos, unnest(w) AS word FROM
        (SELECT conv_id, turn, line_no, {_SPLIT_WORDS.format(l='line')} AS w FROM conv_lines)""",
    "document_words": f"""SELECT unnest(w) AS word FROM (SELECT {_SPLIT_WORDS.format(l='line')}
        AS w FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents))""",
    "flume": """SELECT event_id, CASE WHEN event_type = 'signup'
        THEN '{"en":"start","u":' || CAST(user_id AS VARCHAR) || '}'
        WHEN event_type <> 'error' THEN CAST(ms AS VARCHAR) || '|' || props
        WHEN k % 2 = 0 THEN substr(CAST(ms AS VARCHAR), 1, 12) || '|' || props
        ELSE CAST(ms AS VARCHAR) || '|' || substr(props, 1, 5) END AS body FROM ev""",
    "user_json": """SELECT o_orderkey, json_object('name', c_name, 'age',
        CAST(c_nationkey AS VARCHAR), 'record_time', CAST(o_orderdate AS VARCHAR)) AS value,
        c_name, CAST(c_nationkey AS VARCHAR) AS age, CAST(o_orderdate AS VARCHAR) AS record_time
        FROM orders JOIN customer ON o_custkey = c_custkey""",
}
