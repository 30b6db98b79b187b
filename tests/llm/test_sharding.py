import nasty
from pyspark.sql import functions as F

from streamlytics.llm import sharding
from streamlytics.llm.sharding import KEY_BITS, sharded, with_shards, write_shards


def check(rows, limit):
    """Shards are disjoint prefixes, fit the limit, and none is deeper than needed."""
    shards = {}
    for r in rows:
        shards.setdefault(r.shard, []).append(r)
    for name, own in shards.items():
        total = sum(r.n_bytes for r in own)
        assert {r.shard_bytes for r in own} == {total}
        assert total <= limit or len(own) == 1
        bits = name.split(".")[0]
        assert all(format(r.key, f"0{KEY_BITS}b").startswith(bits) and r.depth == len(bits) for r in own)
        if bits:
            above = [r for r in rows if format(r.key, f"0{KEY_BITS}b").startswith(bits[:-1])]
            assert sum(r.n_bytes for r in above) > limit and len({r.key for r in above}) > 1
    return shards


def test_only_large_buckets_split(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.expr("repeat('x', cast(id % 100 AS int))").alias("text"))
    for limit in (10, 500, 20_000, 10**9):
        rows = sharded(docs, limit).collect()
        assert len(rows) == 3000
        shards = check(rows, limit)
    assert list(shards) == [""]


def test_one_large_document_gets_its_own_shard(spark):
    docs = spark.createDataFrame([(i, "y" * (5000 if i == 3 else 10)) for i in range(50)], "doc_id bigint, text string")
    rows = sharded(docs, 100).collect()
    shards = check(rows, 100)
    assert [len(v) for v in shards.values() if v[0].n_bytes == 5000] == [1]


def test_copies_of_one_row_are_dealt_out(spark):
    docs = spark.createDataFrame([(1, "z" * 40)] * 30 + [(2, "z")], "doc_id bigint, text string")
    rows = sharded(docs, 100).collect()
    assert len(rows) == 31
    assert sorted(len(v) for k, v in check(rows, 100).items() if v[0].doc_id == 1) == [2] * 15


def test_awkward_rows(spark, tmp_path):
    docs = nasty.docs(spark)
    for limit in (1, 200, 10**9):
        rows = sharded(docs, limit).collect()
        assert sorted((r.doc_id or 0, r.n_bytes) for r in rows) == sorted((r[0] or 0, len((r[1] or "").encode())) for r in nasty.ROWS)
    assert sharded(nasty.empty(spark)).count() == 0
    write_shards(docs, f"{tmp_path}/out", 200)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == len(nasty.ROWS) and set(docs.columns) < set(back.columns)


def test_whole_rows_with_their_shards(spark):
    """Rows stay as they were; each shard holds what ``sharded`` says, copies dealt among parts."""
    docs = nasty.docs(spark).unionByName(
        spark.createDataFrame([(90, "z" * 40, "en", "a", 40, "own", 7)] * 30, nasty.SCHEMA)
    )
    docs = docs.withColumns({"n_bytes": F.col("rank"), "shard": F.lit("mine")})
    for limit in (1, 100, 10**9):
        out = with_shards(docs, limit)
        assert sorted(out.columns) == sorted(docs.columns)
        rows = lambda df: sorted(str(r) for r in df.drop("shard").collect())
        assert rows(out) == rows(docs.select(*out.columns))
        sizes = lambda df: sorted(tuple(r) for r in df.collect())
        n_bytes = F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("n")
        want = sharded(docs, limit).groupBy("shard").agg(F.count("*"), F.sum("n_bytes"))
        assert sizes(out.groupBy("shard").agg(F.count("*"), n_bytes)) == sizes(want)
    assert with_shards(nasty.empty(spark)).count() == 0


def test_texts_stay_where_they_are(spark, monkeypatch, capsys):
    """Rows meet their leaf without a shuffle, and the same one where leaves are too many to send."""
    docs = nasty.docs(spark)
    out = with_shards(docs, 10**9)
    out.explain()
    assert "Exchange hashpartitioning" not in capsys.readouterr().out
    rows = lambda df: sorted(str(r) for r in df.collect())
    for limit in (1, 200):
        want = rows(with_shards(docs, limit).withColumn("shard", F.split_part("shard", F.lit("."), F.lit(1))))
        with monkeypatch.context() as m:
            m.setattr(sharding, "FEW_LEAVES", 0)
            got = with_shards(docs, limit).withColumn("shard", F.split_part("shard", F.lit("."), F.lit(1)))
            assert rows(got) == want
