"""Windows, top-N and alerts against direct forms and plain Python loops."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from streamlytics import schemas
from streamlytics.operators import aggregate, alerts, topn
from streamlytics.operators import windows as w

BASE = 1573022600  # a whole minute plus 20 s


def timed(spark, data, columns):
    """(seconds, ...) rows with ``ts`` as an instant."""
    df = spark.createDataFrame([(float(s), *rest) for s, *rest in data], ["s", *columns])
    return df.withColumn("ts", F.timestamp_micros((F.col("s") * 1e6).cast("long"))).drop("s")


def test_session_gap_of_exactly_the_limit_merges(spark):
    df = timed(spark, [(BASE + s, "u", 1) for s in (0, 30, 59, 90)], ["userId", "productNum"])
    got = w.sessions(df, "userId", "productNum", "30 seconds")
    at = datetime(2019, 11, 6, 6, 43, 20)
    assert rows(got.select("session_start", "session_end", "productNum")) == [
        (at, at + timedelta(seconds=89), 3),
        (at + timedelta(seconds=90), at + timedelta(seconds=120), 1),
    ]


@pytest.mark.parametrize("limit", [5, None])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sessions_equal_the_built_in_ones(spark, seed, limit):
    rnd = random.Random(seed)
    data = [(BASE + rnd.randrange(4000) / 2, rnd.choice("ab"), rnd.randrange(9)) for _ in range(300)]
    df = timed(spark, data, ["userId", "productNum"])
    want = w.session_stream(df, "userId", "productNum", "7 seconds")
    got = w.sessions(df, "userId", "productNum", "7 seconds", limit).select(*want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("parts", [1, 7])
def test_paned_windows_equal_direct_ones(spark, parts):
    rnd = random.Random(5)
    data = [(BASE + rnd.randrange(7200), rnd.choice("abc"), rnd.randrange(9)) for _ in range(500)]
    df = timed(spark, data, ["k", "v"]).repartition(parts)
    direct = w.window_aggregate(df, ["k"], [F.sum("v").alias("v")], "1 hour", "5 minutes")
    assert rows(w.bounds(w.sliding_sum(df, ["k"], "v", "1 hour", "5 minutes"))) == rows(w.bounds(direct))


def test_paned_windows_need_a_whole_number_of_panes(spark):
    df = timed(spark, [(BASE, "a", 1)], ["k", "v"])
    with pytest.raises(ValueError):
        w.sliding_sum(df, ["k"], "v", "1 minute", "40 seconds")


def test_minute_trend_text(spark):
    ms = [(BASE + s) * 1000 for s in (0, 10, 45, 110)]
    df = spark.createDataFrame([(m, "7") for m in ms], "timestamp long, adid string")
    got = w.minute_trend(df, "3 minutes", "1 minute").select("window.start", "trend")
    assert {r.trend for r in got.collect()} == {
        '[{"06:43":2}]', '[{"06:43":2},{"06:44":1}]', '[{"06:43":2},{"06:44":1},{"06:45":1}]',
        '[{"06:44":1},{"06:45":1}]', '[{"06:45":1}]',
    }


def test_top3_breaks_ties_by_ad(spark):
    data = [("d", "north", f"c{i % 2}", ad, 5) for i, ad in enumerate("4231")]
    counts = spark.createDataFrame(data, schemas.AREA_CITY_ADS)
    assert rows(topn.daily_area_top(counts)) == [
        ("d", "north", "1", 5, 1), ("d", "north", "2", 5, 2), ("d", "north", "3", 5, 3),
    ]


def test_city_counts_roll_up(spark):
    log = spark.createDataFrame(
        [(1574400000000, "n", "x", "u", "1"), (1574400000001, "n", "y", "u", "1")], schemas.ADS_LOG
    )
    city = aggregate.date_area_city_ad_count(log)
    assert rows(aggregate.area_ad_rollup(city)) == [("2019-11-22", "n", "1", 2)]


def test_hot_items_report_text(spark):
    counts = spark.createDataFrame([(7, BASE * 1000, 3), (9, BASE * 1000, 5)], schemas.ITEM_VIEW)
    text = topn.hot_items_report(topn.hot_items(counts)).first()["report"]
    assert text.split("\n") == [
        "时间：2019-11-06 06:43:20.0", "No1: 商品ID=9 浏览量=5", "No2: 商品ID=7 浏览量=3", "=" * 32,
    ]


def alerts_by_loop(readings, hold=5):
    """One pass in order; the clock ends at the last reading of any sensor."""
    fired, last, due = [], {}, {}
    for sensor, t, temp in readings:
        before = last.get(sensor)
        if due.get(sensor) is not None and due[sensor] < t:
            fired.append((sensor, due.pop(sensor)))
        if before is not None and temp < before:
            due.pop(sensor, None)
        elif before is not None and temp > before and sensor not in due:
            due[sensor] = t + hold
        last[sensor] = temp
    end = max(t for _, t, _ in readings)
    return sorted(fired + [(s, d) for s, d in due.items() if d <= end])


def sensor_frame(spark, readings):
    data = [(s, BASE + t, float(x), i) for i, (s, t, x) in enumerate(readings)]
    return spark.createDataFrame(data, "id string, timestamp long, temperature double, event_id long")


def alerts_of(spark, readings, **kwargs):
    got = alerts.temp_rise_alerts(sensor_frame(spark, readings), ["timestamp", "event_id"], **kwargs)
    return sorted((i, t - BASE) for i, t in rows(got))


@pytest.mark.parametrize(
    "readings, want",
    [
        ([(0, 1), (1, 2), (4, 1), (20, 1)], []),
        ([(0, 1), (1, 2), (7, 2)], [6]),
        ([(0, 1), (1, 2), (3, 2), (5, 2), (6, 2)], [6]),
        ([(0, 1), (1, 2), (7, 3), (12, 3)], [6, 12]),
        ([(0, 1), (1, 2), (6, 1), (20, 1)], []),
        ([(0, 1), (1, 2), (6, 3), (7, 4), (12, 5)], [6, 12]),
        ([(0, 0), (1, 0.5), (9, 0.5)], [6]),
        ([(0, 5), (1, 0.0), (2, 1), (9, 1)], [7]),
        ([(0, 1), (1, 2), (5, 2)], []),
        ([(0, 3), (1, 2), (1, 3), (1, 1), (9, 1)], []),
        ([(0, 3), (1, 2), (1, 3), (9, 3)], [6]),
    ],
)
def test_alert_cases(spark, readings, want):
    tagged = [("s", t, x) for t, x in readings]
    assert alerts_by_loop(tagged) == [("s", t) for t in want]
    assert alerts_of(spark, tagged) == [("s", t) for t in want]


@pytest.mark.parametrize("seed, limit", [(1, 10**9), (2, 20), (3, 20)])
def test_alerts_equal_the_loop(spark, seed, limit):
    rnd = random.Random(seed)
    t, readings = 0, []
    for _ in range(900):
        t += rnd.choice([0, 0, 1, 1, 2, 4])
        sensor = "hot" if rnd.random() < 0.5 else rnd.choice("ab")
        # Long rising stretches, so that timers arm again inside one.
        x = t // 40 * 3 + t % 40 + rnd.choice([0, 0, 0, -2]) if sensor == "hot" else rnd.randrange(6)
        readings.append((sensor, t, x))
    assert alerts_of(spark, readings, limit=limit) == alerts_by_loop(readings)


@pytest.mark.parametrize("block", [1, 2, 7, 4096])
def test_runs_that_cross_blocks(spark, block):
    readings = [("s", t, t) for t in range(200)] + [("r", t, -t if t % 50 == 0 else t) for t in range(200)]
    readings += [("q", t, t) for t in (0, 3, 5, 9, 10, 11, 12, 17, 23, 24, 25, 30, 90, 91, 97, 150)]
    readings.sort(key=lambda r: r[1])
    assert alerts_of(spark, readings, block=block) == alerts_by_loop(readings)


@pytest.mark.parametrize("hold", [1, 5, 9])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_one_run_without_a_drop(spark, seed, hold):
    """100,000 rises of one sensor that never falls: no second is skipped, in many blocks."""
    rnd = random.Random(seed)
    t, times = -70_000, []
    for _ in range(100_000):
        t += rnd.choice([1, 1, 1, 2, 3, hold, hold + 1, 40])
        times.append(t)
    want, due = [], None
    for t in times:
        if due is None or t > due:
            want.append(t)
            due = t + hold
    df = spark.createDataFrame([("s", x, None) for x in times], "id string, t bigint, until bigint")
    armed = alerts.armed_rises(df, hold, block=64)
    assert sorted(r.t for r in armed.collect()) == want


def test_alerts_take_no_python(spark):
    readings = [("s", t, t) for t in range(3000)]
    df = sensor_frame(spark, readings)
    got = alerts.temp_rise_alerts(df, ["timestamp", "event_id"], block=16)
    assert got.count() == 499
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_a_session_gap_across_1970(spark):
    data = [("k", s, 1) for s in (-95, -25, 25, 50)]
    df = spark.createDataFrame(data, "k string, s long, v long").withColumn("ts", F.timestamp_seconds("s"))
    got = w.sessions(df, "k", "v", "30 seconds").select(F.unix_timestamp("session_start").alias("t"), "v")
    assert sorted(tuple(r) for r in got.collect()) == [(-95, 1), (-25, 1), (25, 2)]
