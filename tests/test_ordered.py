"""The sliced path gives what a plain window gives, also when one key holds most rows."""

import random

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from streamlytics.operators import aggregate, counts, ordered


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    data = [
        ("hot" if rnd.random() < 0.6 else rnd.choice("abcdefgh"), rnd.randrange(50), i, rnd.randrange(9))
        for i in range(3000)
    ] + [(None, 1, 5000, 3), (None, 2, 5001, 4)]
    rnd.shuffle(data)
    return spark.createDataFrame(data, "key string, t int, seq int, v long").repartition(5).cache()


ORDER = ["t", "seq"]


def plain():
    return Window.partitionBy("key").orderBy(*ORDER)


def upto():
    return plain().rowsBetween(Window.unboundedPreceding, 0)


@pytest.mark.parametrize("limit", [10, 10**9])
def test_running_count(skewed, limit):
    got = ordered.running_count(skewed, ["key"], ORDER, limit=limit)
    want = skewed.withColumn("rn", F.row_number().over(plain()).cast("long"))
    assert rows(got) == rows(want)


def test_only_hot_rows_are_sliced(skewed):
    cold, hot = ordered.slices(skewed, ["key"], ORDER, limit=1000)
    assert {r.key for r in hot.rows.select("key").distinct().collect()} == {"hot"} and hot.split
    assert not cold.split and cold.rows.where("key = 'hot'").count() == 0
    assert cold.rows.count() + hot.rows.count() == skewed.count()
    assert hot.rows.select("_slice").distinct().count() > 1
    (whole,) = ordered.slices(skewed, ["key"], ORDER, limit=10**9)
    assert whole.rows is skewed and not whole.split


@pytest.mark.parametrize("limit", [10, 10**9])
def test_previous_value(skewed, limit):
    got = ordered.previous_value(skewed, ["key"], ORDER, "v", "p", limit=limit)
    assert rows(got) == rows(skewed.withColumn("p", F.lag("v").over(plain())))


@pytest.mark.parametrize("limit", [10, 10**9])
def test_rolling_reduce(skewed, limit):
    got = ordered.running_sum_first(skewed, ["key"], ORDER, "v", "t", limit=limit)
    want = skewed.select(
        "key", F.first("t").over(upto()).alias("t"), "seq", F.sum("v").over(upto()).alias("v")
    )
    assert rows(got) == rows(want)


NAN = float("nan")
HOLES = {
    "starts with nulls": [None] * 12 + [1.0, 2.0] * 14,
    "ends with nulls": [1.0] * 15 + [None] * 25,
    "a slice of nulls": [3.0] * 8 + [None] * 20 + [4.0] * 12,
    "only nulls": [None] * 40,
    "one NaN": [1.0] * 10 + [NAN] + [1.0] * 29,
}


@pytest.mark.parametrize("key", ["k", None])
@pytest.mark.parametrize("values", HOLES.values(), ids=HOLES)
def test_nulls_give_the_same_sliced_or_not(spark, values, key):
    data = [(key, i, i, x) for i, x in enumerate(values)]
    df = spark.createDataFrame(data, "key string, t int, seq int, v double").repartition(3)

    def all_of(limit):
        sums = ordered.running_sum_first(df, ["key"], ORDER, "v", "t", limit=limit)
        firsts = ordered.running_sum_first(df, ["key"], ORDER, "t", "v", limit=limit)
        before = ordered.previous_value(df, ["key"], ORDER, "v", "p", limit=limit)
        count = ordered.running_count(df, ["key"], ORDER, limit=limit)
        # As text, so that NaN equals itself.
        return [[repr(r) for r in rows(x)] for x in (sums, firsts, before, count)]

    assert ordered.slices(df, ["key"], ORDER, 1)[-1].split
    assert all_of(1) == all_of(10**9)


def test_a_hot_key_is_spread(skewed):
    s = ordered.slices(skewed, ["key"], ORDER, limit=10)[-1]
    per_slice = [r["count"] for r in s.rows.groupBy("_slice").count().collect()]
    assert s.split and len(per_slice) == 4
    assert max(per_slice) < 1.5 * 3002 / 4


@pytest.mark.parametrize("limit", [10, 10**9])
def test_last_seen(skewed, limit):
    some = skewed.withColumn("x", F.when(F.col("v") > 6, F.col("seq")))
    got = ordered.last_seen(some, ["key"], ORDER, "x", "y", limit=limit)
    before = plain().rowsBetween(Window.unboundedPreceding, -1)
    assert rows(got) == rows(some.withColumn("y", F.last("x", ignorenulls=True).over(before)))


def runs_by_loop(data, gap):
    out, state = [], {}
    for key, t, seq, v in sorted(data, key=lambda r: (r[0] or "", r[1], r[2])):
        last, run, total = state.get(key, (None, 0, None))
        if last is None or t - last > gap:
            run, total = run + 1, None
        if v is not None:
            total = v + (total or 0)
        state[key] = (t, run, total)
        out.append((key, t, seq, v, run, total))
    return sorted(out, key=repr)


@pytest.mark.parametrize("gap", [0, 3, 40, 10**6])
@pytest.mark.parametrize("limit", [1, 50, 10**9])
def test_runs_equal_the_loop(spark, gap, limit):
    """Runs inside a slice, over one border, and over all slices; values with nulls."""
    rnd = random.Random(gap + 1)
    times = {"hot": 0, "a": 0, None: 0}
    data = []
    for i in range(600):
        key = "hot" if rnd.random() < 0.7 else rnd.choice(["a", None])
        times[key] += rnd.choice([0, 1, 1, 2, 5, 60])
        data.append((key, times[key], i, rnd.choice([None, 1, 2, 7])))
    df = spark.createDataFrame(data, "key string, t int, seq int, v long").repartition(5)
    got = ordered.runs(df, ["key"], ORDER, "t", lambda p: F.col("t") - p > gap, "v", "s", limit)
    assert rows(got.select("key", "t", "seq", "v", "_run", "s")) == runs_by_loop(data, gap)


def fired(values, size, slide):
    out = []
    for i in range(slide, len(values) + 1, slide):
        out.append((i, sum(values[max(0, i - size) : i])))
    return out


@pytest.mark.parametrize("limit", [10, 10**9])
@pytest.mark.parametrize("size, slide", [(10, 10), (10, 5), (6, 2)])
def test_count_windows(spark, limit, size, slide):
    sizes = {"a": 4, "b": 5, "c": 10, "d": 11, "e": 20, "f": 137}
    data = [(k, i, i, (i * 7) % 13) for k, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(data, "key string, t int, seq int, v long").repartition(3)
    got = counts.count_windows(df, "key", "v", ORDER, size, slide, limit=limit)
    want = sorted(
        (k, i, s)
        for k, n in sizes.items()
        for i, s in fired([(i * 7) % 13 for i in range(n)], size, slide)
    )
    assert rows(got) == sorted(want, key=repr)


def test_count_window_size_must_fit(spark):
    with pytest.raises(ValueError):
        counts.count_windows(spark.range(1), "id", "id", ["id"], 10, 3)


def test_running_word_count_emits_every_word(spark):
    df = spark.createDataFrame([(0, "a"), (1, "b"), (2, "a")], "seq int, word string")
    assert rows(aggregate.running_word_count(df, ["seq"])) == [
        (0, "a", 1), (1, "b", 1), (2, "a", 2),
    ]


def test_avg_truncated_survives_big_sums(spark):
    df = spark.createDataFrame([("a", 2**62), ("a", 2**62 + 1), ("a", 2**62)], "k string, timestamp long")
    assert aggregate.avg_truncated(df, "k").first()["avg_truncated"] == float(2**62)
