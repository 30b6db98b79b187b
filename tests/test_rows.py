"""Parsing, log rules, text edge cases, routing and lookups on hand-made rows."""

import json
import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from streamlytics import schemas
from streamlytics.functions import logs, parse, text, times
from streamlytics.operators import aggregate, enrich, route
from streamlytics.sources import changes, tables, topics
from streamlytics.streaming import sinks


@pytest.mark.parametrize(
    "line, fields",
    [
        ("", [""]),
        (" ", []),
        ("a  b ", ["a", "", "b"]),
        (" a", ["", "a"]),
        ("a b a", ["a", "b", "a"]),
        ("   ", []),
    ],
)
def test_split_drops_only_trailing_empties(spark, line, fields):
    df = spark.createDataFrame([(line,)], "s string")
    assert df.select(text.words_of(F.col("s"))).first()[0] == fields


def test_split_on_a_longer_delimiter(spark):
    df = spark.createDataFrame([("a||b||",)], "s string")
    assert df.select(text.split_fields(F.col("s"), "||")).first()[0] == ["a", "b"]


MS = "1549696569054"


@pytest.mark.parametrize(
    "body, start, event",
    [
        (None, False, False),
        ("{}", True, False),
        (" {a} ", True, False),
        ("\t{a}\n", True, False),
        ("{", False, False),
        (f"{MS}|{{}}", False, True),
        (f"{MS} | {{}}", False, False),
        (f"{MS}| {{}} ", False, True),
        (f"{MS}|{{}}|", False, True),
        (f"{MS}|{{}}||", False, True),
        ("154969656905x|{}", False, False),
        (f"{MS}|{{}}|x", False, False),
        (f"{MS}|", False, False),
        (f"{MS}|{{a\nb}}", False, True),
        (f"{MS}|{{}}\n", False, True),
        ("154969656905|{}", False, False),
    ],
)
def test_log_rules(spark, body, start, event):
    df = spark.createDataFrame([(body,)], "body string")
    got = df.select(logs.is_start_log(F.col("body")), logs.is_event_log(F.col("body"))).first()
    assert tuple(got) == (start, event)


def test_start_anywhere_selects_the_start_rule(spark):
    event = f'{MS}|{{"en":"start"}}'
    df = spark.createDataFrame([(event,), ('{"en":"start"}',), (f"{MS}|{{}}",)], "body string")
    assert rows(logs.keep_clean_logs(df)) == [(f"{MS}|{{}}",), ('{"en":"start"}',)]
    topics_of = df.select(logs.log_topic(F.col("body")).alias("t"))
    assert [r.t for r in topics_of.collect()] == ["topic_start", "topic_start", "topic_event"]


def test_routing_replaces_the_topic_header(spark):
    df = spark.createDataFrame(
        [({"topic": "old", "x": "1"}, "start")], schemas.FLUME_EVENT
    )
    assert logs.route_logs(df).first()["headers"] == {"x": "1", "topic": "topic_start"}


SENSOR_TEXT = ["sensor_1, 1547718199, 35.8", "", "sensor_10, 1547718205, 38.1"]


def test_strict_parse_skips_blank_lines_and_fails_on_bad_ones(spark):
    df = spark.createDataFrame([(x,) for x in SENSOR_TEXT], "value string")
    assert rows(parse.parse_delimited(df, schemas.SENSOR)) == [
        ("sensor_1", 1547718199, 35.8),
        ("sensor_10", 1547718205, 38.1),
    ]
    bad = spark.createDataFrame([("sensor_1, x, 35.8",)], "value string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        parse.parse_delimited(bad, schemas.SENSOR).collect()
    short = spark.createDataFrame([("sensor_1, 1547718199",)], "value string")
    with pytest.raises(Exception, match="INVALID_ARRAY_INDEX"):
        parse.parse_delimited(short, schemas.SENSOR).collect()


def test_lenient_parse_returns_the_rejects(spark):
    lines = [*SENSOR_TEXT, "sensor_1, x, 1", "sensor_1, 5"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    good, bad = parse.parse_delimited_lenient(df, schemas.SENSOR)
    assert good.count() == 2
    assert rows(bad) == [("",), ("sensor_1, 5",), ("sensor_1, x, 1",)]


def test_other_records(spark):
    df = spark.createDataFrame([("1002,zhangsan,18",)], "value string")
    assert rows(parse.parse_delimited(df, schemas.STUDENT)) == [(1002, "zhangsan", 18)]
    df = spark.createDataFrame([("14010012,440221134,7,pv,1573022620",)], "value string")
    assert parse.parse_delimited(df, schemas.USER_BEHAVIOR).first()["behavior"] == "pv"
    df = spark.createDataFrame([("1574400000000 north town 3 5",)], "value string")
    assert rows(parse.parse_ads_log(df)) == [(1574400000000, "north", "town", "3", "5")]
    df = spark.createDataFrame([('{"name":"a","age":"1"}',)], "value string")
    assert rows(parse.parse_json(df)) == [("a", "1", None)]


def test_times(spark):
    df = spark.createDataFrame([(1574400000000,)], "ms long")
    got = df.select(
        times.day_of("ms"), times.minute_of("ms"), times.millis_to_datetime("ms"),
        times.datetime_to_millis(times.millis_to_datetime("ms")),
    ).first()
    assert tuple(got) == ("2019-11-22", "05:20", "2019-11-22 05:20:00", 1574400000000)


def test_nan_is_not_high_and_makes_the_minimum_nan(spark):
    df = spark.createDataFrame([("a", math.nan), ("a", 1.0), ("b", 31.0)], "id string, temperature double")
    tagged = route.tag_high_low(df)
    assert {(r.id, r.tag) for r in tagged.collect()} == {("a", "low"), ("b", "high")}
    low = df.groupBy("id").agg(aggregate.nan_min("temperature").alias("m"))
    got = {r.id: r.m for r in low.collect()}
    assert math.isnan(got["a"]) and got["b"] == 31.0


def test_split_select_and_side_output(spark):
    df = spark.createDataFrame([("a", 30.0), ("b", 31.9), ("c", 32.0)], "id string, temperature double")
    tagged = route.tag_high_low(df)
    assert route.select_tags(tagged, "high", "low").count() == 3
    assert rows(route.co_map(tagged)) == [
        ("a", None, "healthy"),
        ("b", 31.9, "high temperature warning"),
        ("c", 32.0, "high temperature warning"),
    ]
    main, side = route.freezing_alerts(df)
    assert main.count() == 3
    assert [r.alert for r in side.orderBy("id").collect()] == [
        "freezing alert for a", "freezing alert for b",
    ]


def test_rule_lookup_flags_hits_and_reloads(spark):
    log = spark.createDataFrame([("1",), ("2",)], "userid string")

    def load(batch_id):
        return spark.createDataFrame([("1", ["old", "new"][batch_id])], "userid string, rule string")

    seen = []
    body = enrich.refreshed_lookup(load, "userid", lambda df, i: seen.append((i, rows(df))))
    body(log, 0)
    body(log, 1)
    body(log, 1)
    new = (1, [("1", "new", True), ("2", None, False)])
    assert seen == [(0, [("1", "old", True), ("2", None, False)]), new, new]


def test_only_a_small_side_is_broadcast(spark):
    def plan(side, max_bytes):
        joined = spark.range(100).join(enrich.broadcast_if_few(side, max_bytes), "id")
        return joined._jdf.queryExecution().optimizedPlan().toString()

    few = spark.range(5)
    assert "broadcast" in plan(few, 1000) and "broadcast" not in plan(few, 100)
    # Few rows may be wide.
    assert "broadcast" not in plan(few.withColumn("t", F.expr("repeat('x', 10000)")), 1000)


def test_a_log_column_is_no_weight_unless_named(spark):
    log = spark.createDataFrame(
        [(1574400000000, "n", "x", "u", "1", 7, "never")] * 2,
        "timestamp long, area string, city string, userid string, adid string, n long, dt string",
    )
    assert rows(aggregate.daily_user_ad_clicks(log)) == [("2019-11-22", "u", "1", 2)]
    assert rows(aggregate.daily_user_ad_clicks(log, "n", "dt")) == [("never", "u", "1", 14)]


def test_change_rows_are_routed(spark):
    after = [{"id": "1"}, {"id": "2"}]
    envelopes = spark.createDataFrame(
        [
            ("ROWDATA", "order_info", "INSERT", after),
            ("ROWDATA", "order_info", "DELETE", after),
            ("ROWDATA", "user_info", "UPDATE", after[:1]),
            ("ROWDATA", "user_info", "DELETE", after),
            ("TRANSACTIONBEGIN", "order_info", "INSERT", after),
        ],
        schemas.CHANGE_ENVELOPE,
    )
    routed = changes.route_changes(changes.changed_rows(envelopes))
    assert rows(routed.select("topic", changes.after_json("after"))) == [
        ("GMALL_ORDER", '{"id":"1"}'), ("GMALL_ORDER", '{"id":"2"}'), ("GMALL_USER", '{"id":"1"}'),
    ]


@pytest.mark.parametrize(
    "saved, want",
    [
        ([], {"0": 0, "1": 0, "2": 0}),
        ([(0, 7), (1, 9)], {"0": 7, "1": 9, "2": 0}),
        ([(0, 7), (1, 9), (2, 3), (3, 5)], {"0": 7, "1": 9, "2": 3}),
    ],
)
def test_offsets(spark, saved, want):
    live = spark.createDataFrame(
        [("t", "g", p) for p in range(3)], "topic string, group string, partition int"
    )
    stored = spark.createDataFrame([("t", "g", p, o) for p, o in saved], schemas.OFFSETS)
    got = json.loads(topics.starting_offsets_option(topics.reconcile_offsets(live, stored)))
    assert got == {"t": want}


def test_connection_options():
    o = topics.kafka_options("h:9092", ["a", "b"], max_per_trigger=2000)
    assert o["subscribe"] == "a,b" and o["startingOffsets"] == "latest"
    assert o["maxOffsetsPerTrigger"] == "2000"
    assert topics.socket_options("h", 7777) == {"host": "h", "port": "7777"}
    assert sinks.jdbc_options("jdbc:x", "t")["batchsize"] == "1000"


def test_wide_column_round_trip_keeps_missing_cells_null(spark):
    df = spark.createDataFrame([(1, "a", 18), (2, "b", None), (3, None, None)], schemas.STUDENT)
    cells = sinks.to_wide_column(df, "id", "info", ["name", "age"])
    assert cells.count() == 3
    assert rows(tables.read_wide_column(cells, "info", ["name", "age"])) == [
        ("1", "a", "18"), ("2", "b", None),
    ]


def test_kafka_projection(spark):
    df = spark.createDataFrame([(1, "x")], "k int, v string")
    assert sinks.kafka_records(df, "t", "v", key="k").first().asDict() == {
        "topic": "t", "key": "1", "value": "x",
    }
    assert sinks.kafka_records(df, "t", "v").columns == ["topic", "value"]


@pytest.mark.parametrize("parts", [1, 4])
def test_latest_value_breaks_ties(spark, parts):
    from streamlytics.sources.tables import latest_value

    data = [(5, "2.5", i) for i in range(20)] + [(5, "1.5", 99), (4, "9.0", 100)]
    df = spark.createDataFrame(data, "record_time long, wqi string, n int").repartition(parts)
    assert latest_value(df, 0).first()["wqi"] == 2.5
    assert latest_value(df, 0, then="n").first()["wqi"] == 1.5
    assert latest_value(df, 5).first()["wqi"] == 0.0
