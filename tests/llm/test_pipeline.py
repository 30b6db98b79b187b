"""Each pipeline stage against a plain version of its rule, on the rows the stage before kept."""

import corpus_pipeline
import pytest
from conftest import SF
from test_decontaminate import plain
from test_near_dups import brute

from streamlytics.llm.common import written
from streamlytics.llm.mixing import mix_report
from streamlytics.llm.toxicity import judged
from streamlytics.llm.toxicity_query import fitted

NAMES = ["toxicity", "near_dedup", "decontaminate", "mix", "shard"]


@pytest.fixture(scope="module")
def kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], SF), name))
    return dict(zip(["documents", *NAMES], out, strict=True))


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages_and_columns(kept):
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES
    assert all(kept[n].columns == kept["documents"].columns for n in NAMES[:-1])


def test_toxic_documents_go(spark, kept):
    chain = fitted(spark, kept["documents"], SF)
    assert ids(kept["toxicity"]) == ids(judged(kept["documents"], chain).where("NOT toxic"))
    assert kept["toxicity"].count() < kept["documents"].count()


def test_one_of_each_group_stays(kept):
    want = [d for d, _, least in brute(pairs(kept["toxicity"])) if d == least]
    assert ids(kept["near_dedup"]) == sorted(want)


def test_leaks_go(spark, kept):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaking = {d for d, _ in plain(pairs(kept["near_dedup"]), items)}
    assert ids(kept["decontaminate"]) == [d for d in ids(kept["near_dedup"]) if d not in leaking]


def test_copies_follow_the_mix(kept):
    want = []
    for r in mix_report(kept["decontaminate"]).collect():
        want += [r.doc_id] * (r.taken // r["size"] if r["size"] else 0)
    worded = [d for d, t in pairs(kept["mix"]) if (t or "").split()]
    assert sorted(worded) == sorted(want)


def test_every_copy_has_a_shard(kept):
    assert kept["shard"].columns == [*kept["documents"].columns, "shard"]
    assert ids(kept["shard"]) == ids(kept["mix"])
    assert sorted(map(str, pairs(kept["shard"]))) == sorted(map(str, pairs(kept["mix"])))


def test_run_gives_the_last_stage(spark, kept):
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(corpus_pipeline.run(spark, SF)) == rows(kept["shard"])


def test_stages_take_an_empty_table(spark, kept):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, kept["documents"].limit(0), SF).count() == 0
