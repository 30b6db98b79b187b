"""Streams run to the end of the given tables, each with the batch result as its SQL."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlytics.functions.times import plain
from streamlytics.operators import aggregate as agg
from streamlytics.operators import alerts, enrich, route, topn
from streamlytics.operators import windows as w
from streamlytics.operators.aggregate import nan_min
from streamlytics.plans import views as v
from streamlytics.plans.clicks import QUERY_THRESHOLD, TOP3_SQL, trend_sql
from streamlytics.plans.keyed import BATCH_SQL, BATCHES, batch_of
from streamlytics.plans.registry import query
from streamlytics.plans.windows import (
    COUNT_SQL, MIN_SQL, SUM_SQL, TOP_SQL, VIEWS_SQL, _alert_oracle,
    count_window_sql, session_sql, sliding_sql, total, ttl_sql, tumbling_sql,
)
from streamlytics.session import scratch
from streamlytics.sources.replay import DAY_US, closing_rows, replay, time_slice_sql
from streamlytics.streaming import state
from streamlytics.streaming.clicks_app import ClicksApp
from streamlytics.streaming.keyed import KeyedTable, add_up, keep_all, keep_latest
from streamlytics.streaming.run import each_batch, fan_out, read_state, to_files

def replayed(spark, d, slices=BATCHES, order=None, close=False):
    """The events in equal parts of their time range, shaped.

    ``close`` ends the replay with rows far in the future, so that windows still open at the end
    of the input fire as well.
    """
    raw = v.table(spark, d, "events")
    closing = closing_rows(raw, "ts", "event_type", "30 DAYS") if close else None
    stream = replay(raw, batch_of(spark, d, slices), order=order, closing=closing)
    return v.shape_events(stream)


@query(
    "src_replay", "SELECT event_id, ts, user_id, event_type, value, k FROM ev", "ev"
)
def src_replay(spark, d):
    return to_files(replayed(spark, d).drop("props")).withColumn("ts", plain("ts"))


@query(
    "wm_bounded",
    tumbling_sql("sensor", "id", COUNT_SQL, "1 hour"),
    "ev sensor",
)
def wm_bounded(spark, d):
    s = v.shape_sensor(replayed(spark, d, close=True)).withWatermark("ts", "1 second")
    n = F.count(F.lit(1)).alias("count")
    return w.bounds(to_files(w.window_aggregate(s, ["id"], [n], "1 hour")))


@query(
    "wm_ascending",
    tumbling_sql("sensor", "id", COUNT_SQL, "2 seconds"),
    "ev sensor",
)
def wm_ascending(spark, d):
    s = v.shape_sensor(replayed(spark, d, close=True)).withWatermark("ts", "0 seconds")
    n = F.count(F.lit(1)).alias("count")
    return w.bounds(to_files(w.window_aggregate(s, ["id"], [n], "2 seconds")))


# Every row of the late quarter finds its window closed.
_LATE_SQL = f"""{time_slice_sql("events", "ts", 4, DAY_US)} <> 1"""


@query(
    "late_rows",
    tumbling_sql(
        "sensor", "id", COUNT_SQL, "1 hour", _LATE_SQL
    ),
    "ev sensor",
)
def late_rows(spark, d):
    """The second quarter arrives last, when the watermark has closed its windows."""
    s = v.shape_sensor(replayed(spark, d, 4, [0, 2, 3, 1], close=True)).withWatermark("ts", "0 seconds")
    n = F.count(F.lit(1)).alias("count")
    return w.bounds(to_files(w.window_aggregate(s, ["id"], [n], "1 hour")))


def _pay(spark, d):
    return v.shape_pay(replayed(spark, d, close=True)).withWatermark("ts", "0 seconds")


@query(
    "tumbling_sum_stream",
    tumbling_sql("pay_info", '"userId"', SUM_SQL, "6 hours"),
    "ev pay_info",
)
def tumbling_sum_stream(spark, d):
    return w.bounds(to_files(w.window_aggregate(_pay(spark, d), ["userId"], [total()], "6 hours")))


@query(
    "sliding_sum_stream",
    sliding_sql("pay_info", '"userId"', SUM_SQL, 21600, 3600),
    "ev pay_info",
)
def sliding_sum_stream(spark, d):
    out = w.window_aggregate(_pay(spark, d), ["userId"], [total()], "6 hours", "1 hour")
    return w.bounds(to_files(out))


@query(
    "sliding_min_stream",
    sliding_sql("sensor", "id", MIN_SQL, 10, 5),
    "ev sensor",
)
def sliding_min_stream(spark, d):
    s = v.shape_sensor(replayed(spark, d, close=True)).withWatermark("ts", "1 second")
    low = nan_min("temperature").alias("temperature")
    return w.bounds(to_files(w.window_aggregate(s, ["id"], [low], "10 seconds", "5 seconds")))


@query(
    "session_sum_stream", session_sql(21600), "ev pay_info"
)
def session_sum_stream(spark, d):
    return to_files(w.session_stream(_pay(spark, d), "userId", "productNum", "6 hours"))


def _item_counts(spark, d):
    views = v.shape_behavior(replayed(spark, d, close=True).where("event_type = 'view'"))
    views = views.where("behavior = 'pv'")
    count, total = {"count": F.count(F.lit(1))}, {"count": F.sum("count")}
    return w.paned_stream(
        views.withWatermark("ts", "0 seconds"), ["itemId"], count, total, "1 hour", "5 minutes"
    ).select("itemId", F.unix_millis(F.col("window.end")).alias("windowEnd"), "count")


@query("sliding_item_count_stream", VIEWS_SQL, "ev user_behavior")
def sliding_item_count_stream(spark, d):
    return to_files(_item_counts(spark, d))


@query("hot_items_stream", TOP_SQL, "ev user_behavior")
def hot_items_stream(spark, d):
    """A window's counts leave the second aggregate in one batch, when the watermark passes it, so
    ranking each batch ranks whole windows; every task sends on at most three rows of a window."""
    table = KeyedTable(
        spark, scratch(spark, "hot"), ["windowEnd", "rank"],
        "windowEnd bigint, rank int, itemId bigint, count bigint", keep_all,
    )
    each_batch(_item_counts(spark, d), lambda b, i: table.write(topn.hot_items(b), i))
    return table.read()


@query(
    "state_full_update",
    "SELECT event_type, count(*) AS count FROM ev GROUP BY event_type",
    "ev",
)
def state_full_update(spark, d):
    """Every key after every batch; the table holds the latest batch whole."""
    counts = replayed(spark, d).groupBy("event_type").agg(F.count(F.lit(1)).alias("count"))
    table = KeyedTable(
        spark, scratch(spark, "full"), ["event_type"], "event_type string, count bigint", None
    )
    each_batch(counts, table.write, mode="complete")
    return table.read()


@query(
    "state_incremental",
    "SELECT CAST(user_id AS VARCHAR) AS userid, count(*) AS count FROM ev GROUP BY 1",
    "ev",
)
def state_incremental(spark, d):
    """Only the changed keys after each batch, put into the table."""
    users = replayed(spark, d).select(F.col("user_id").cast("string").alias("userid"))
    table = KeyedTable(
        spark, scratch(spark, "changed"), ["userid"], "userid string, count bigint", keep_latest
    )
    each_batch(agg.word_count(users, "userid"), table.write, mode="update")
    return table.read()


@query(
    "state_expiring",
    """SELECT strftime(ts, '%Y-%m-%d') AS dt, event_type, count(*) AS count FROM ev
    GROUP BY ALL""",
    "ev",
)
def state_expiring(spark, d):
    """Daily counters whose state is dropped a day after their day; the table keeps them."""
    e = replayed(spark, d).withWatermark("ts", "1 day")
    n = F.count(F.lit(1)).alias("count")
    daily = w.window_aggregate(e, ["event_type"], [n], "1 day").select(
        F.date_format("window.start", "yyyy-MM-dd").alias("dt"), "event_type", "count"
    )
    table = KeyedTable(
        spark, scratch(spark, "daily"), ["dt", "event_type"],
        "dt string, event_type string, count bigint", keep_latest,
    )
    each_batch(daily, table.write, mode="update")
    return table.read()


@query(
    "word_count_per_batch",
    """SELECT batch, word, count(*) AS count FROM (SELECT conv_id % 3 AS batch, word FROM words)
    GROUP BY batch, word""",
    "conv_lines words",
)
def word_count_per_batch(spark, d):
    """Counts of each batch on its own; nothing is kept between batches."""
    table = KeyedTable(
        spark, scratch(spark, "words"), ["batch", "word"], "batch bigint, word string, count bigint",
        keep_all,
    )
    stream = replay(v.words(spark, d), (F.col("conv_id") % 3).cast("int"))

    def count(batch, batch_id):
        counts = agg.word_count(batch)
        table.write(counts.withColumn("batch", F.lit(batch_id).cast("bigint")), batch_id)

    each_batch(stream, count)
    return table.read()


@query(
    "side_output_stream",
    """SELECT 'main' AS output, event_id, id, NULL AS alert FROM sensor UNION ALL
    SELECT 'side', event_id, id, 'freezing alert for ' || id FROM sensor WHERE temperature < 32.0""",
    "ev sensor",
)
def side_output_stream(spark, d):
    """Two outputs of one stream; every batch is read once."""
    schema = "event_id bigint, id string, alert string"
    main, side = (
        KeyedTable(spark, scratch(spark, name), ["event_id"], schema, keep_all)
        for name in ("main", "side")
    )
    no_alert = F.lit(None).cast("string").alias("alert")

    def pass_all(batch, batch_id):
        main.write(route.freezing_alerts(batch)[0].select("event_id", "id", no_alert), batch_id)

    def alert(batch, batch_id):
        side.write(route.freezing_alerts(batch)[1], batch_id)

    each_batch(v.shape_sensor(replayed(spark, d)), fan_out(pass_all, alert))
    named = [t.read().withColumn("output", F.lit(n)) for t, n in ((main, "main"), (side, "side"))]
    return named[0].unionByName(named[1])


@query(
    "refreshable_lookup_stream",
    f"""SELECT event_id, CAST(user_id AS VARCHAR) AS userid,
    CASE WHEN c_mktsegment = 'BUILDING' THEN 'rules of batch ' || CAST({BATCH_SQL} AS VARCHAR) END
    AS rule, coalesce(c_mktsegment = 'BUILDING', FALSE) AS matched
    FROM ev LEFT JOIN customer ON user_id = c_custkey""",
    "ev",
)
def refreshable_lookup_stream(spark, d):
    """The rules are loaded anew for each batch; here each load names its batch."""
    table = KeyedTable(
        spark, scratch(spark, "matched"), ["event_id"],
        "event_id bigint, userid string, rule string, matched boolean", keep_all,
    )

    def load_rules(batch_id):
        text = f"rules of batch {batch_id}"
        building = v.table(spark, d, "customer").where("c_mktsegment = 'BUILDING'")
        return building.select(
            F.col("c_custkey").cast("string").alias("userid"), F.lit(text).alias("rule")
        )

    users = replayed(spark, d).select("event_id", F.col("user_id").cast("string").alias("userid"))
    each_batch(users, enrich.refreshed_lookup(load_rules, "userid", table.write))
    return table.read()


@query(
    "state_per_record",
    """SELECT CAST(user_id AS VARCHAR) AS userid, event_id, row_number() OVER
    (PARTITION BY user_id ORDER BY event_id) + CASE WHEN user_id = 1 THEN 1000 ELSE 0 END AS count
    FROM ev""",
    "ev",
)
def state_per_record(spark, d):
    """Counts per record, going on from a start state that is itself a table."""
    users = replayed(spark, d).select(F.col("user_id").cast("string").alias("userid"), "event_id")
    counts = KeyedTable(
        spark, scratch(spark, "counts"), ["userid"], "userid string, count bigint", add_up
    )
    start = v.table(spark, d, "customer").where("c_custkey = 1")
    counts.write(
        start.select(F.col("c_custkey").cast("string").alias("userid"), F.lit(1000).alias("count")),
        state.START,
    )
    out = KeyedTable(
        spark, scratch(spark, "numbered"), ["event_id"],
        "userid string, event_id bigint, count bigint", keep_all,
    )
    each_batch(users, state.running_count_body(counts, out.write, "userid", ["event_id"]))
    return out.read()


def _count_windows(spark, d, size, slide):
    panes = state.pane_table(spark, scratch(spark, "panes"), "userId", size, slide)
    out = KeyedTable(
        spark, scratch(spark, "fired"), ["userId", "seen"],
        "userId string, seen bigint, productNum bigint", keep_all,
    )
    body = state.count_window_body(
        panes, out.write, "userId", "productNum", ["ts", "event_id"], size, slide
    )
    each_batch(v.shape_pay(replayed(spark, d)), body)
    return out.read()


@query("count_tumbling_stream", count_window_sql(10, 10), "ev pay_info")
def count_tumbling_stream(spark, d):
    return _count_windows(spark, d, 10, 10)


@query("count_sliding_stream", count_window_sql(10, 5), "ev pay_info")
def count_sliding_stream(spark, d):
    return _count_windows(spark, d, 10, 5)


@query("minute_trend_stream", trend_sql(60, 20), "ev ads_log")
def minute_trend_stream(spark, d):
    """Every batch replaces the trends it changes."""
    minutes = KeyedTable(
        spark, scratch(spark, "minutes"), ["adid", "minute"], "adid string, minute bigint, n bigint", add_up
    )
    trends = KeyedTable(
        spark, scratch(spark, "trends"), ["window_start", "adid"],
        "window_start timestamp_ntz, window_end timestamp_ntz, adid string, trend string", keep_latest,
    )

    def store(rows, batch_id):
        start, end = (plain(f"window.{x}").alias(f"window_{x}") for x in ("start", "end"))
        trends.write(rows.select(start, end, "adid", "trend"), batch_id)

    log = replayed(spark, d).select(
        F.unix_millis("ts").alias("timestamp"), (F.col("k") % 6 + 1).cast("string").alias("adid")
    )
    each_batch(log, state.minute_trend_body(minutes, store, "1 hour", "20 minutes"))
    return trends.read()


@query("temp_rise_alert_stream", _alert_oracle())
def temp_rise_alert_stream(spark, d):
    s = v.shape_sensor(replayed(spark, d)).withWatermark("ts", "0 seconds")
    return alerts.alert_text(to_files(state.temp_rise_stream(s)))


@query("kv_ttl_count_stream", ttl_sql(1800))
def kv_ttl_count_stream(spark, d):
    counters = KeyedTable(
        spark, scratch(spark, "ttl"), ["key"], "key string, at timestamp, n bigint"
    )
    out = KeyedTable(
        spark, scratch(spark, "ttl_out"), ["key", "at"], "key string, at timestamp, count bigint"
    )
    e = replayed(spark, d).select(F.col("event_type").alias("key"), "ts")
    each_batch(e, state.ttl_counter_body(counters, out.write, "30 minutes"))
    return out.read().withColumn("at", plain("at"))


@query("kv_ttl_state_stream", ttl_sql(1800))
def kv_ttl_state_stream(spark, d):
    """The counters as streaming state with timers, instead of a keyed table."""
    e = replayed(spark, d, close=True).select(F.col("event_type").alias("key"), "ts")
    counts = state.ttl_counts_stream(e.withWatermark("ts", "0 seconds"), "30 minutes")
    return to_files(counts).withColumn("at", plain("at"))


# The app's feedback with a third of the time range as batch instead of a day.
_APP_SQL = f"""batched AS (SELECT *, {BATCH_SQL} AS batch FROM ads_log),
    listed AS (SELECT userid, min(batch) AS listed_in FROM (SELECT batch, dt, userid, adid
    FROM batched GROUP BY ALL HAVING count(*) >= {QUERY_THRESHOLD}) GROUP BY userid),
    kept AS (SELECT b.* FROM batched b LEFT JOIN listed USING (userid)
    WHERE listed_in IS NULL OR batch <= listed_in),
    city_kept AS (SELECT dt, area, city, adid, count(*) AS click_count FROM kept GROUP BY ALL)"""


def _app_sql(body: str) -> str:
    return (
        f"WITH ev AS ({v.VIEW_SQL['ev']}), ads_log AS ({v.VIEW_SQL['ads_log']}), {_APP_SQL} {body}"
    )


def _run_app(spark, d) -> ClicksApp:
    """The events are streamed with the columns the app reads; places join a batch's counts, not its rows."""
    app = ClicksApp(spark, scratch(spark, "app"), QUERY_THRESHOLD, compact_every=2)

    def count(batch, batch_id):
        cells = v.shape_cells(batch, spark, d)
        app.add(cells.select("dt", "area", "city", "userid", "adid", "n"), batch_id)

    raw = v.table(spark, d, "events").select("ts", "user_id", "props")
    clicks = replay(raw, batch_of(spark, d)).select(v.event_time(), "user_id", v.event_k())
    each_batch(clicks, count)
    return app


@query("ads_pipeline_stream", _app_sql(TOP3_SQL.format(src="city_kept")))
def ads_pipeline_stream(spark, d):
    return _run_app(spark, d).top3.read()


@query("blacklist_update_stream", _app_sql("SELECT userid FROM listed"))
def blacklist_update_stream(spark, d):
    return _run_app(spark, d).blacklist.read()


@query(
    "checkpoint_recovery",
    """SELECT event_type, dt, count(*) AS count FROM (SELECT event_type,
    strftime(ts, '%Y-%m-%d') AS dt FROM ev) GROUP BY event_type, dt""",
    "ev",
)
def checkpoint_recovery(spark, d):
    """Stop after the first slice, then start again on the rest from the same checkpoint."""
    raw, path, checkpoint = v.table(spark, d, "events"), scratch(spark, "input"), scratch(spark, "ck")
    table = KeyedTable(
        spark, scratch(spark, "recovered"), ["event_type", "dt"],
        "event_type string, dt string, count bigint", keep_latest,
    )
    for order in ([0], [1, 2]):
        e = v.shape_events(replay(raw, batch_of(spark, d), path=path, order=order))
        counts = e.groupBy("event_type", F.date_format("ts", "yyyy-MM-dd").alias("dt")).agg(
            F.count(F.lit(1)).alias("count")
        )
        each_batch(counts, table.write, mode="update", checkpoint=checkpoint)
    return table.read()


@query(
    "state_read_back",
    f"""SELECT CAST(as_of AS INTEGER) AS as_of, event_type, count(*) AS count FROM
    (SELECT event_type, {BATCH_SQL} AS batch FROM ev), range(0, {BATCHES}) r(as_of)
    WHERE batch <= as_of GROUP BY ALL""",
    "ev",
)
def state_read_back(spark, d):
    """Counters read out of the checkpoint, as of every batch, with a stop before the last one."""
    raw, path, checkpoint = v.table(spark, d, "events"), scratch(spark, "input"), scratch(spark, "ck")
    *first, last = range(BATCHES)
    for order in (first, [last]):
        e = v.shape_events(replay(raw, batch_of(spark, d), path=path, order=order))
        counts = e.groupBy("event_type").agg(F.count(F.lit(1)).alias("count"))
        each_batch(counts, lambda b, i: b.write.format("noop").mode("append").save(),
                   mode="update", checkpoint=checkpoint)
    found = [
        read_state(spark, checkpoint, n).select(
            F.lit(n).alias("as_of"), "key.event_type", "value.count"
        )
        for n in range(BATCHES)
    ]
    return reduce(DataFrame.unionByName, found)


@query(
    "sink_exactly_once",
    "SELECT CAST(user_id AS VARCHAR) AS userid, count(*) AS clicks FROM ev GROUP BY 1",
    "ev",
)
def sink_exactly_once(spark, d):
    """Every batch is delivered twice; its folder is replaced, so increments count once."""
    table = KeyedTable(
        spark, scratch(spark, "once"), ["userid"], "userid string, clicks bigint", add_up
    )

    def deliver(batch, batch_id):
        delta = batch.groupBy(F.col("user_id").cast("string").alias("userid")).agg(
            F.count(F.lit(1)).alias("clicks")
        )
        table.write(delta, batch_id)
        table.write(delta, batch_id)

    each_batch(replayed(spark, d), deliver)
    return table.read()
