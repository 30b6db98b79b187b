import tracemalloc

import nasty
import numpy as np
from conftest import SF
from pyspark.sql import functions as F

from streamlytics.llm import additive, toxicity
from streamlytics.llm.additive_query import in_held_out, op9
from streamlytics.llm.toxicity_query import CATEGORIES, labelled

MORE = SF.replace("0.001", "0.01")


def test_features_do_not_depend_on_neighbours():
    texts = [nasty.LONG[:3000], "", "A!! B!!\nB!!", "x | y | z", nasty.ROWS[-1][1], None]
    together = additive.text_features(texts)
    assert np.allclose(together, np.vstack([additive.text_features([t]) for t in texts]))
    names = dict(zip(additive.FEATURES, together[2], strict=True))
    assert np.isclose(names["words"], np.log1p(3)) and np.isclose(names["shout"], 2.0)
    assert np.isclose(names["distinct"], 2 / 3) and not together[1].any() and not together[5].any()


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((3000, len(additive.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = additive.fit(x[:2000], y[:2000])
    assert ((model.score(x[2000:]) >= 0.5) == y[2000:]).mean() > 0.9
    none = additive.fit(x[:0], y[:0])
    assert np.allclose(none.score(x[:3]), 0.5)
    assert (additive.fit(x[:50], np.ones(50)).score(x[:50]) > 0.5).all()


def test_quality_on_held_out_documents(spark):
    rows = op9(spark, MORE).join(spark.read.parquet(f"{MORE}/labels.parquet"), "doc_id").where("held_out").collect()
    assert len(rows) > 50
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_quality_of_awkward_rows(spark):
    docs = nasty.docs(spark)
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (6, None), (7, 1)], "doc_id bigint, quality int")
    model = additive.train(docs, labels)
    got = additive.scored(docs, model).collect()
    assert len(got) == len(nasty.ROWS) and all(0 <= r.score <= 1 for r in got)
    same = [r.score for r in got if r.doc_id in (3, 4)]
    assert same[0] == same[1]
    assert additive.scored(nasty.empty(spark), additive.train(nasty.empty(spark), labels)).count() == 0
    assert not docs.where("doc_id IS NULL").where(in_held_out()).count()


def test_terms_are_whole_words_and_their_beginnings():
    parts = ["Some beginnings, some".encode(), b"", "beginnings".encode()]
    owner, found, counts = toxicity.terms(parts)
    assert counts.tolist() == [3, 0, 1]
    a, b = set(found[owner == 0].tolist()), set(found[owner == 2].tolist())
    assert b < a and len(a) == 2 + len(toxicity.PREFIXES)


def test_terms_take_bounded_memory():
    """Two workers beside a grown heap took an executor over its memory."""
    texts = ["some more words of a longer text " * 120] * 2000
    vocabulary = np.unique(toxicity.terms([texts[0].encode()])[1])
    tracemalloc.start()
    row, _, _ = toxicity.described(texts, vocabulary)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 96 << 20 and np.array_equal(np.unique(row), np.arange(2000))


def test_toxicity_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{MORE}/{t}.parquet") for t in ("documents", "labels"))
    held = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    chain = toxicity.train(labelled(docs, labels.where(~held)), CATEGORIES)
    assert len(chain.models) == 3 and len(chain.models[2].dense) == 2
    judged = toxicity.judged(docs, chain).join(labels.where(held), "doc_id")
    rows = [(r[-1], r["p_toxic_any"]) for r in judged.select("p_toxic_any", labels.toxic).collect()]
    marks = np.array([t for t, _ in rows])
    said = np.array([p >= 0.5 for _, p in rows])
    assert said[marks == 0].mean() < 0.03 and said[marks == 1].mean() > 0.6
    left = toxicity.without_toxic(docs, chain)
    assert left.columns == docs.columns
    assert left.count() == toxicity.judged(docs, chain).where("NOT toxic").count()


def test_toxicity_of_awkward_rows(spark):
    docs = nasty.docs(spark)
    marks = docs.select("doc_id", "text", (F.col("doc_id") == 1).cast("int").alias("bad"))
    chain = toxicity.train(marks, ["bad"])
    got = toxicity.judged(docs, chain).collect()
    assert len(got) == len(nasty.ROWS) and [r.doc_id for r in got].count(None) == 2
    none = toxicity.train(marks.limit(0), ["bad"])
    assert {r.p_bad for r in toxicity.judged(docs, none).collect()} == {0.5}
    assert toxicity.judged(nasty.empty(spark), chain).count() == 0
    assert toxicity.without_toxic(docs, chain).columns == docs.columns


def test_repeated_numbers_count_towards_the_sample(spark, monkeypatch):
    """One doc_id under many rows does not bring more rows to the driver than the bound says."""
    docs = spark.range(300).select(F.lit(1).cast("bigint").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id bigint, quality int")
    seen = []
    monkeypatch.setattr(additive, "fit", lambda x, y: seen.append(len(y)))
    additive.train(docs, labels, sample=20)
    monkeypatch.setattr(toxicity, "fit_chain", lambda sparse, y, *_: seen.append(len(y)))
    toxicity.train(docs.withColumn("bad", F.lit(1)), ["bad"], sample=20)
    assert seen == [20, 20]
