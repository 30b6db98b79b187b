"""Keyed tables, state, watermarks, recovery and the running app."""

import random
from collections import defaultdict

import pytest
from conftest import SF, rows
from pyspark.sql import functions as F

from streamlytics import schemas
from streamlytics.functions import parse
from streamlytics.operators import blacklist as bl
from streamlytics.operators import counts, topn
from streamlytics.operators import windows as w
from streamlytics.plans import streams
from streamlytics.session import scratch, shared_dir
from streamlytics.sources.replay import replay, time_slice
from streamlytics.streaming import sinks, state
from streamlytics.streaming.clicks_app import ClicksApp
from streamlytics.streaming.keyed import KeyedTable, add_up, collect_members, keep_all, keep_latest
from streamlytics.streaming.run import each_batch, read_state, state_operators, to_files


def frame(spark, data):
    return spark.createDataFrame(data, "k string, v long")


def filled(spark, fold, batches):
    keys = ["k"]
    schema = "k string" if fold is collect_members else "k string, v long"
    table = KeyedTable(spark, scratch(spark, "t"), keys, schema, fold)
    for i, data in enumerate(batches):
        table.write(frame(spark, data), i)
    return table


BATCHES = [[("a", 1), ("b", 2)], [("a", 5)], [("c", 7)]]


@pytest.mark.parametrize(
    "fold, want",
    [
        (keep_latest, [("a", 5), ("b", 2), ("c", 7)]),
        (add_up, [("a", 6), ("b", 2), ("c", 7)]),
        (collect_members, [("a",), ("b",), ("c",)]),
        (None, [("c", 7)]),
    ],
)
def test_keyed_table(spark, fold, want):
    table = filled(spark, fold, BATCHES)
    assert rows(table.read()) == want
    table.write(frame(spark, BATCHES[2]), 2)  # a repeated batch
    assert rows(table.read()) == want
    table.compact(1)
    assert rows(table.read()) == want
    table.write(frame(spark, [("d", 1)]), 3)
    assert rows(table.read(before=3)) == want
    assert ("d", 1)[: len(want[0])] in rows(table.read())


def test_empty_table_and_history(spark):
    table = filled(spark, add_up, [])
    assert rows(table.read()) == []
    table = filled(spark, add_up, BATCHES)
    assert rows(table.read(before=1)) == [("a", 1), ("b", 2)]
    table.compact(2)
    assert rows(table.read(before=2)) == [("a", 6), ("b", 2)]


def test_an_unfinished_folder_is_not_read(spark):
    import os

    table = filled(spark, add_up, BATCHES)
    folder = f"{table.path}/log/batch=2"
    os.remove(f"{folder.removeprefix('file:')}/_SUCCESS")
    assert rows(table.read()) == [("a", 6), ("b", 2)]


def test_shared_dir_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def clicks(spark, data):
    """(batch, day, user, ad) tuples as an ad log; a batch is a run of days."""
    log = [
        (1704067200000 + d * 86400000 + i, "n", "c", u, a, b) for i, (b, d, u, a) in enumerate(data)
    ]
    return spark.createDataFrame(
        log, "timestamp long, area string, city string, userid string, adid string, batch int"
    )


def simulate(data, threshold):
    """The app as a loop: filter by the list, count, then extend the list."""
    listed, counters, kept, when = set(), defaultdict(int), defaultdict(int), {}
    for b in sorted({x[0] for x in data}):
        mine = [x for x in data if x[0] == b and x[2] not in listed]
        for _, d, u, a in mine:
            counters[d, u, a] += 1
            kept[f"2024-01-{d + 1:02d}", a] += 1
        new = {u for (_, u, _), n in counters.items() if n >= threshold} - listed
        when.update({u: b for u in new})
        listed |= new
    return kept, when


@pytest.fixture(scope="module")
def click_data():
    rnd = random.Random(11)
    # A third of the clicks come from one user.
    return [
        (d // 2, d, "hot" if rnd.random() < 0.33 else f"u{rnd.randrange(12)}", str(rnd.randrange(3)))
        for d in range(8)
        for _ in range(40)
    ]


@pytest.mark.parametrize("parts", [1, 6])
def test_closed_form_of_the_feedback(spark, click_data, parts):
    kept, when = simulate(click_data, 3)
    log = clicks(spark, click_data).repartition(parts)
    cells = log.withColumn("dt", F.date_format(F.timestamp_millis("timestamp"), "yyyy-MM-dd"))
    cells = cells.groupBy("batch", "dt", "area", "city", "userid", "adid").agg(F.count("*").alias("n"))
    assert dict(rows(bl.first_listed(cells, "batch", 3))) == when
    out = bl.kept_with_feedback(cells, "batch", 3).groupBy("dt", "adid").agg(F.sum("n"))
    assert {(r[0], r[1]): r[2] for r in rows(out)} == dict(kept)


def test_the_running_app(spark, click_data):
    kept, when = simulate(click_data, 3)
    app = ClicksApp(spark, scratch(spark, "app"), threshold=3, compact_every=3)
    stream = replay(clicks(spark, click_data), F.col("batch"))
    each_batch(stream.drop("batch"), app)
    assert {r.userid for r in app.blacklist.read().collect()} == set(when)
    got = app.city_counts.read().groupBy("dt", "adid").agg(F.sum("click_count"))
    assert {(r[0], r[1]): r[2] for r in rows(got)} == dict(kept)
    by_day = defaultdict(list)
    for (day, ad), n in kept.items():
        by_day[day].append((-n, ad))
    want = [
        (day, "n", ad, -n, i + 1) for day, ads in by_day.items() for i, (n, ad) in enumerate(sorted(ads))
    ]
    assert rows(app.top3.read()) == sorted(want, key=repr)


def test_a_repeated_batch_changes_nothing(spark, click_data):
    app = ClicksApp(spark, scratch(spark, "app"), threshold=3)
    log = clicks(spark, click_data)
    for b in [0, 0, 1, 1]:
        app(log.where(F.col("batch") == b).drop("batch"), b)
    _, when = simulate([x for x in click_data if x[0] < 2], 3)
    assert {r.userid for r in app.blacklist.read().collect()} == set(when)
    assert app.counters.read().agg(F.sum("click_count")).first()[0] == app.city_counts.read().agg(
        F.sum("click_count")
    ).first()[0]


@pytest.mark.parametrize("parts", [1, 5])
def test_merged_top_equals_ranking_everything(spark, parts):
    """Batches that raise some ads, with ties, groups of fewer than three and null names."""
    rnd = random.Random(parts)
    total, top = defaultdict(int), spark.createDataFrame([], topn_schema())
    names = [f"a{i}" for i in range(6)] + [None]
    for _ in range(6):
        cells = [(rnd.choice("de"), rnd.choice(["n", "s", None]), rnd.choice(names)) for _ in range(5)]
        for c in cells:
            total[c] += rnd.randrange(1, 3)
        changed = spark.createDataFrame([(*c, total[c]) for c in set(cells)], topn_schema(rank=False))
        groups = {c[:2] for c in cells}
        stored = spark.createDataFrame(
            [r for r in map(tuple, top.collect()) if r[:2] in groups], topn_schema()
        )
        others = [r for r in map(tuple, top.collect()) if r[:2] not in groups]
        merged = topn.merged_daily_top(stored, changed.repartition(parts))
        top = spark.createDataFrame(others + [tuple(r) for r in merged.collect()], topn_schema())
    everything = spark.createDataFrame([(*c, n) for c, n in total.items()], topn_schema(rank=False))
    want = topn.daily_area_top(everything.withColumn("city", F.lit("c")))
    assert rows(top) == rows(want)


def topn_schema(rank=True):
    return "dt string, area string, adid string, click_count bigint" + ", rank int" * rank


def test_a_batch_folds_only_keys_it_touches(spark):
    table = filled(spark, add_up, BATCHES)
    assert rows(table.read(only=spark.createDataFrame([("a",), ("x",)], "k string"))) == [("a", 6)]
    table.write(frame(spark, [(None, 4)]), 3)
    assert rows(table.read(only=spark.createDataFrame([(None,)], "k string"))) == [(None, 4)]


def test_dead_counters_leave_the_table(spark):
    """Compaction drops a counter once the newest one is the expiry further on."""
    data = [(m * 60 + s, f"k{m}") for m in range(12) for s in (0, 7)]
    df = seconds(spark, data, ["key"]).select("key", "ts")
    counters = KeyedTable(spark, scratch(spark, "t"), ["key"], "key string, at timestamp, n bigint")
    out = KeyedTable(spark, scratch(spark, "o"), ["key", "at"], "key string, at timestamp, count bigint")
    body = state.ttl_counter_body(counters, out.write, "90 seconds", compact_every=1)
    each_batch(replay(df, time_slice(df, "ts", 4)), body)
    assert rows(out.read()) == rows(state.ttl_counts(df, "90 seconds"))
    assert counters.read().count() == 2


def seconds(spark, data, columns):
    df = spark.createDataFrame(data, ["s", *columns])
    return df.withColumn("ts", F.timestamp_seconds("s")).drop("s")


TTL = [(0, "a"), (19, "a"), (39, "a"), (40, "a"), (7, "b"), (8, "b"), (500, "z")]


def test_ttl_counter(spark):
    """Updates at 0, 19, 39 and 40 s with one-second batches: 39 is exactly the expiry after
    19, so the count starts again."""
    got = state.ttl_counts(seconds(spark, TTL, ["key"]), "20 seconds", "1 second")
    of_a = [r["count"] for r in got.where("key = 'a'").orderBy("at").collect()]
    assert of_a == [1, 2, 1, 2]


def test_ttl_counter_stream_equals_batch(spark):
    rnd = random.Random(3)
    t, data = 0, []
    for _ in range(300):
        t += rnd.choice([0, 1, 3, 12])
        data.append((t, rnd.choice("aab")))
    df = seconds(spark, data, ["key"])
    counters = KeyedTable(spark, scratch(spark, "t"), ["key"], "key string, at timestamp, n bigint")
    out = KeyedTable(
        spark, scratch(spark, "o"), ["key", "at"], "key string, at timestamp, count bigint"
    )
    each_batch(replay(df, time_slice(df, "ts", 4)), state.ttl_counter_body(counters, out.write))
    assert rows(out.read()) == rows(state.ttl_counts(df))
    assert rows(out.read()) == rows(state.ttl_counts(df, limit=7))


def test_per_record_counts_start_from_a_seed(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(10)], "event_id long, k string")
    stream = replay(df, F.floor(F.col("event_id") / 4).cast("int"))
    tally = KeyedTable(spark, scratch(spark, "c"), ["k"], "k string, count bigint", add_up)
    tally.write(spark.createDataFrame([("b", 100), ("z", 5)], "k string, count bigint"), state.START)
    out = KeyedTable(
        spark, scratch(spark, "o"), ["event_id"], "event_id bigint, k string, count bigint", keep_all
    )
    each_batch(stream, state.running_count_body(tally, out.write, "k", ["event_id"]))
    assert rows(out.read()) == sorted(
        [(i, "ab"[i % 2], i // 2 + 1 + (100 if i % 2 else 0)) for i in range(10)], key=repr
    )
    assert rows(tally.read()) == [("a", 5), ("b", 105), ("z", 5)]


@pytest.mark.parametrize("limit", [10, None])
def test_count_windows_over_batches_with_a_hot_key(spark, limit):
    """One key holds nine tenths of a batch; what is carried stays a few panes per key."""
    data = [("hot" if i % 10 else f"k{i % 3}", i) for i in range(400)]
    df = spark.createDataFrame(data, "userId string, event_id long").selectExpr(
        "userId", "event_id", "timestamp_seconds(event_id) AS ts", "event_id * 7 % 13 AS v"
    )
    panes = state.pane_table(spark, scratch(spark, "p"), "userId", 6, 2)
    out = KeyedTable(
        spark, scratch(spark, "o"), ["userId", "seen"], "userId string, seen bigint, v bigint", keep_all
    )
    body = state.count_window_body(
        panes, out.write, "userId", "v", ["ts", "event_id"], 6, 2, limit, compact_every=2
    )

    def twice(batch, batch_id):
        body(batch, batch_id)
        body(batch, batch_id)

    each_batch(replay(df, time_slice(df, "ts", 5)), twice)
    whole = counts.count_windows(df, "userId", "v", ["ts", "event_id"], 6, 2)
    assert rows(out.read()) == rows(whole)
    assert panes.read().groupBy("userId").count().where("count > 3").count() == 0


def test_a_compacted_table_keeps_few_folders(spark):
    table = KeyedTable(spark, scratch(spark, "many"), ["k"], "k string, v long", add_up)
    for i in range(30):
        table.write(frame(spark, [("a", 1), (f"k{i % 3}", 1)]), i)
        if i % 5 == 4:
            table.compact(i)
    assert len(table._finished("log")) + len(table._finished("base")) <= 12
    assert rows(table.read()) == [("a", 30), ("k0", 10), ("k1", 10), ("k2", 10)]


def test_replay_delivers_slices_in_order(spark):
    df = spark.range(100).withColumn("ts", F.timestamp_seconds("id"))
    seen = []
    each_batch(
        replay(df, time_slice(df, "ts", 4)),
        lambda b, i: seen.append(b.agg(F.min("id"), F.max("id")).first()),
    )
    assert [tuple(x) for x in seen] == [(0, 24), (25, 49), (50, 74), (75, 99)]


# Eighteen readings in arrival order; their seconds jump back and forth.
READINGS = [
    ("sensor_1", 1547718199, 35.80018327300259), ("sensor_6", 1547718201, 15.402984393403084),
    ("sensor_7", 1547718202, 6.720945201171228), ("sensor_10", 1547718205, 38.101067604893444),
    ("sensor_1", 1547718206, 35.1), ("sensor_1", 1547718207, 35.6),
    ("sensor_1", 1573022620, 30.0), ("sensor_1", 1573022615, 15.0), ("sensor_1", 1573022617, 12.0),
    ("sensor_1", 1573022621, 10.0), ("sensor_1", 1573022622, 5.0), ("sensor_1", 1573022625, 20.0),
    ("sensor_1", 1573022627, 30.0), ("sensor_1", 1573022631, 2.0), ("sensor_1", 1573022632, 50.0),
    ("sensor_1", 1573022626, 8.0), ("sensor_1", 1573022627, 5.0), ("sensor_1", 1573022628, 8.0),
]


def test_late_readings_are_dropped_and_reported(spark):
    """The last three readings arrive two batches after the watermark has passed them."""
    data = [(i, *r) for i, r in enumerate(READINGS)]
    df = spark.createDataFrame(data, "n int, id string, timestamp long, temperature double")
    df = df.withColumn("ts", F.timestamp_seconds("timestamp"))
    batch = F.when(F.col("n") < 14, 0).when(F.col("n") == 14, 1).otherwise(2)
    stream = replay(df, batch, files_per_slice=1).withWatermark("ts", "1 second")
    low = w.window_aggregate(stream, ["id"], [F.min("temperature").alias("low")], "2 seconds")
    dropped = []
    query = each_batch(low, lambda b, i: dropped.append(rows(w.bounds(b))))
    late = sum(
        s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"]
    )
    assert late == 2  # 626+627 share a window, 628 is alone; rows combine before the drop
    starts = {r[0].second for batch_rows in dropped for r in batch_rows if r[0].year == 2019 and r[0].month == 11}
    # The window that starts at :50 ends one second after the last watermark.
    assert starts == {34, 36, 40, 42, 44, 46}


def test_console_sink_runs(spark, capfd):
    df = spark.range(5).withColumn("ts", F.timestamp_seconds("id"))
    query = sinks.to_console(replay(df, F.lit(0)).select("id"))
    query.option("checkpointLocation", scratch(spark, "ck")).trigger(availableNow=True).start().awaitTermination()


def test_partition_insert_uses_today(spark):
    path = scratch(spark, "insert")
    sinks.insert_partition(frame(spark, [("a", 1)]), path)
    sinks.insert_partition(frame(spark, [("b", 2)]), path)
    got = spark.read.parquet(path)
    assert got.count() == 2
    assert got.where(F.col("dt") == F.current_date()).count() == 2


def test_commit_after_output(spark):
    """A batch whose output fails is delivered again under the same id."""
    df = spark.range(10).withColumn("ts", F.timestamp_seconds("id"))
    path, checkpoint, calls = scratch(spark, "in"), scratch(spark, "ck"), []
    table = KeyedTable(spark, scratch(spark, "t"), ["id"], "id bigint, n bigint", add_up)

    def failing_once(batch, batch_id):
        calls.append(batch_id)
        table.write(batch.select("id", F.lit(1).cast("long").alias("n")), batch_id)
        if len(calls) == 1:
            raise RuntimeError("output lost")

    stream = replay(df, F.lit(0), path=path)
    with pytest.raises(Exception, match="output lost"):
        each_batch(stream, failing_once, checkpoint=checkpoint)
    each_batch(stream, failing_once, checkpoint=checkpoint)
    assert calls == [0, 0]
    assert table.read().agg(F.sum("n")).first()[0] == 10


def test_text_stream_and_ingest_time_windows(spark):
    """Processing-time windows: all lines of one batch are seen at one moment."""
    from streamlytics.sources.tables import text_lines

    path = scratch(spark, "lines")
    spark.createDataFrame([("u1,3",), ("u1,4",), ("u2,5",)], "value string").write.text(path)
    pay = parse.parse_delimited(text_lines(spark, path, streaming=True), schemas.PAY_INFO)
    total = F.sum("productNum").alias("productNum")
    sums = w.window_aggregate(w.at_ingest_time(pay), ["userId"], [total], "1 minute")
    table = KeyedTable(
        spark, scratch(spark, "t"), ["window_start", "userId"],
        "window_start timestamp_ntz, userId string, productNum bigint",
    )
    each_batch(w.bounds(sums), table.write, mode="update")
    assert rows(table.read().select("userId", "productNum")) == [("u1", 7), ("u2", 5)]


def test_streams_over_three_months(spark, tmp_path):
    """Slices follow the time axis, whatever months it spans; windows of all of them fire."""
    from streamlytics.plans import streams

    events = spark.range(900).selectExpr(
        "id AS event_id",
        "cast(timestamp'2024-01-20 00:00:00' + make_dt_interval(0, 0, 0, id * 9000) AS timestamp_ntz) AS ts",
        "id % 7 + 1 AS user_id",
        "element_at(array('click', 'error', 'purchase', 'signup', 'view'), cast(id % 5 + 1 AS int)) AS event_type",
        "cast(id % 90 AS double) AS value",
        "concat('{\"k\": ', id % 100, '}') AS props",
    )
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    d = str(tmp_path)
    for slices in (3, 10):
        seen = []
        each_batch(
            streams.replayed(spark, d, slices), lambda b, i, s=seen: s.append(b.agg(F.min("ts"), F.max("ts")).first())
        )
        assert len(seen) == slices and all(a[1] < b[0] for a, b in zip(seen, seen[1:], strict=False))
    total = streams.tumbling_sum_stream(spark, d).agg(F.sum("productNum")).first()[0]
    assert total == events.where("event_type = 'purchase'").select(F.sum(F.col("event_id") % 100)).first()[0]
    assert streams.count_tumbling_stream(spark, d).count() == 7 * (180 // 7 // 10)


def test_slices_stay_apart_where_partitions_are_empty(spark):
    """24 rows in 8 partitions: dealing them out again leaves files out."""
    df = spark.range(24).selectExpr("id", "cast(id div 8 as int) AS s").repartition(8, "id")
    for width in (8, 5, 1):
        seen = []
        stream = replay(df, F.col("s"), files_per_slice=width)
        each_batch(stream, lambda b, i, seen=seen: seen.append(sorted(r.id for r in b.collect())))
        assert [x for x in seen if x] == [list(range(8 * k, 8 * k + 8)) for k in range(3)]


def test_chained_windows_equal_plain_ones(spark):
    data = [(i, f"2024-01-01 {i * 7 % 24:02d}:{i * 13 % 60:02d}:00", f"k{i % 3}") for i in range(300)]
    df = spark.createDataFrame(data, "id int, t string, key string").selectExpr("id", "cast(t as timestamp) AS ts", "key")
    far = spark.createDataFrame([(-1, "2024-02-01 00:00:00", "k0")], "id int, t string, key string").selectExpr("id", "cast(t as timestamp) AS ts", "key")
    stream = replay(df, time_slice(df, "ts", 3), closing=far).withWatermark("ts", "0 seconds")
    chained = w.paned_stream(stream, ["key"], {"n": F.count("id")}, {"n": F.sum("n")}, "1 hour", "5 minutes")
    plain = w.window_aggregate(df, ["key"], [F.count("id").alias("n")], "1 hour", "5 minutes")
    assert rows(to_files(chained)) == rows(plain)


def test_state_of_expired_counters_falls(spark):
    """Key k<i> is seen in minutes 10 i to 10 i + 9 only, so few counters live at a time."""
    data = [(m * 60 + s, f"k{m // 10}") for m in range(120) for s in (0, 7, 30)]
    df = seconds(spark, data, ["key"]).select("key", "ts")
    far = seconds(spark, [(100 * 86400, "far")], ["key"]).select("key", "ts")
    stream = replay(df, time_slice(df, "ts", 6), closing=far).withWatermark("ts", "0 seconds")
    checkpoint = scratch(spark, "ck")
    got = to_files(state.ttl_counts_stream(stream, "2 minutes"), checkpoint=checkpoint)
    assert rows(got) == rows(state.ttl_counts(df, "2 minutes"))
    names = [r.operatorName for r in state_operators(spark, checkpoint).collect()]
    counters = names.index("transformWithStateInPandasExec")
    live = [
        read_state(spark, checkpoint, b, counters, state.ExpiringCounter.COUNTER).count()
        for b in range(1, 6)
    ]
    assert max(live) <= 2


def test_state_is_read_between_batches(spark):
    df = spark.createDataFrame([(i, f"k{i % 5}") for i in range(60)], "id int, k string")
    checkpoint = scratch(spark, "ck")
    stream = replay(df, F.floor(F.col("id") / 20).cast("int"))
    seen = []
    counts = stream.groupBy("k").agg(F.count("id").alias("n"))
    each_batch(counts, lambda b, i: seen.append(rows(b)), mode="complete", checkpoint=checkpoint)
    for b, want in enumerate(seen):
        assert rows(read_state(spark, checkpoint, b).select("key.k", "value.count")) == want
    assert rows(read_state(spark, checkpoint).select("key.k", "value.count")) == seen[-1]


def test_the_app_streams_only_columns_it_reads(spark, monkeypatch):
    seen, real = [], streams.replay

    def watched(df, *args, **options):
        seen.append(df.columns)
        return real(df, *args, **options)

    monkeypatch.setattr(streams, "replay", watched)
    streams._run_app(spark, SF)
    assert seen == [["ts", "user_id", "props"]]
