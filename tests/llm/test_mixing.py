import nasty
from conftest import SF
from pyspark.sql import functions as F

from streamlytics.llm.common import WORD
from streamlytics.llm.mixing import copies, mix_report, mixed, source_targets


def shares(sizes, weights=(1, 2, 3)):
    """Targets by sharing the excess again and again."""
    names = sorted((k for k in sizes if k is not None)) + [k for k in sizes if k is None]
    weight = {k: weights[i % 3] for i, k in enumerate(names)}
    capped, total = set(), sum(sizes.values())
    while True:
        free = [k for k in names if k not in capped]
        level = (total - sum(3 * sizes[k] for k in capped)) / max(1, sum(weight[k] for k in free))
        over = {k for k in free if weight[k] * level > 3 * sizes[k]}
        if not over:
            return {k: 3 * sizes[k] if k in capped else weight[k] * level for k in names}
        capped |= over


def test_targets(spark):
    for sizes in ({"b": 1, "a": 1000, None: 10, "c": 7}, {"x": 5}, {"a": 0, "b": 0}, {"a": 100, "b": 1, "c": 1, "d": 2}):
        df = spark.createDataFrame(list(sizes.items()), "source string, size bigint")
        got = {r.source: r.target for r in source_targets(df).collect()}
        want = shares(sizes)
        assert got.keys() == want.keys()
        assert all(abs(got[k] - want[k]) < 1e-6 for k in want)


def test_mix_meets_its_targets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(
        spark.range(3000).select(
            (F.col("id") + 10_000).alias("doc_id"),
            F.expr("repeat('w ', 1 + cast(id % 37 AS int))").alias("text"),
            F.lit("en").alias("lang"), F.lit("hot").alias("source"), F.lit(0).cast("bigint").alias("n_chars"),
        )
    )
    rows = mix_report(docs).collect()
    again = {tuple(r) for r in mix_report(docs.repartition(5)).collect()}
    assert len(rows) == docs.count() and {tuple(r) for r in rows} == again
    assert all(0 <= r.taken <= 3 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0) for r in rows)
    by = {}
    source = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    for r in rows:
        t = by.setdefault(source[r.doc_id], [r.target, 0, r.source_size])
        t[1] += r.taken
    assert abs(sum(t[0] for t in by.values()) - sum(t[2] for t in by.values())) < 1e-3
    assert all(abs(t[1] - t[0]) <= max(0.05 * t[0], 40) for t in by.values())
    assert abs(by["hot"][1] - by["hot"][0]) <= 40


def test_every_document_has_its_chance(spark):
    """Over many draws (other numbers, same sizes) a document is taken as often as its rate says."""
    rows = [(s * 1000 + i, "w " * n, f"s{s}") for s in range(120) for i, n in enumerate((1, 2, 3, 4, 5, 6, 7, 8))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = copies(docs, weights=(1, 2)).collect()
    rate = {r.size: 0.0 for r in got}
    for r in got:
        rate[r.size] += (r.copies - r.target / r.source_size) / 120
    assert all(abs(v) < 0.2 for v in rate.values())


def test_awkward_rows(spark):
    docs = nasty.docs(spark)
    rows = mix_report(docs).collect()
    assert sorted((r.doc_id or 0, r["size"]) for r in rows) == sorted((r[0] or 0, len((r[1] or "").split())) for r in nasty.ROWS)
    out = mixed(docs)
    assert out.columns == docs.columns
    taken = sum(r.taken for r in rows)
    assert out.select(F.sum(F.regexp_count("text", F.lit(WORD)))).first()[0] == taken
    assert mix_report(nasty.empty(spark)).count() == 0 and mixed(nasty.empty(spark)).count() == 0


def test_equal_rows_are_rounded_one_by_one(spark):
    """A source of one row, 400 times, is taken within one row of its target."""
    rows = [(1, "ten words of text that say the same each time", "a", i) for i in range(400)]
    rows += [(2 + i, "w " * 10, "b", 0) for i in range(267)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, extra int")
    report = [r for r in mix_report(docs).collect() if r.doc_id == 1]
    assert len(report) == 400
    assert abs(sum(r.taken for r in report) - report[0].target) <= report[0]["size"]
    out = mixed(docs).where("doc_id = 1").collect()
    assert len(out) * report[0]["size"] == sum(r.taken for r in report)
    # Every row is taken as often as the rate says, rounded down or up.
    rate = report[0].target / (400 * report[0]["size"])
    per = [sum(r.extra == i for r in out) for i in range(400)]
    assert set(per) <= {int(rate), int(rate) + 1}


def test_own_columns_keep_their_names_and_values(spark):
    names = ["copy", "copies", "text_key", "row", "whole", "more", "rn", "n_rows", "a.b"]
    docs = nasty.docs(spark).withColumns({n: F.col("rank") for n in names if n != "a.b"}).withColumn("a.b", F.col("rank"))
    out = mixed(docs)
    assert out.columns == docs.columns
    assert all(r[n] == r["rank"] for r in out.collect() for n in names)
