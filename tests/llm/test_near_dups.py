import random

import nasty
import numpy as np
from pyspark.sql import functions as F

from streamlytics.llm import chosen_path, key_filter
from streamlytics.llm.chosen_path import linked, near_duplicates, without_near_duplicates
from streamlytics.llm.components import components
from streamlytics.llm.shingles import shingle_sets


def words(text):
    return (text or "").encode().lower().split()


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """Per row its set size and the least doc_id its links reach."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                    root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    least = {k: min((d for d in v if d is not None), default=None) for k, v in groups.items()}
    return sorted(((rows[i][0], len(sets[i]), least[find(i)]) for i in range(len(rows))), key=repr)


def family(rng, n, edits, size=120):
    """Copies of one text with some words exchanged, and strangers that share a passage."""
    base = [f"w{rng.randrange(5000)}" for _ in range(size)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(edits)):
            copy[rng.randrange(size)] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out + [
        " ".join(base[:60] + [f"s{rng.randrange(10**6)}" for _ in range(60)]) for _ in range(n // 2)
    ]


def corpus():
    rng = random.Random(3)
    texts = family(rng, 60, 12) + family(rng, 20, 4) + family(rng, 30, 30)
    texts += ["a b", "A  b", "a b c", "", None, texts[0].upper()]
    return [(i * 3 % 1009, t) for i, t in enumerate(texts)]


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def test_equals_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = near_duplicates(df)
    assert got(found) == brute(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found.collect())


def test_small_nodes_and_groups_change_nothing(spark, monkeypatch):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    monkeypatch.setattr(chosen_path, "NODE_ROWS", 8)
    monkeypatch.setattr(chosen_path, "GROUP_SHINGLES", 1500)
    monkeypatch.setattr(chosen_path, "DEPTH", 1)
    assert got(near_duplicates(df)) == brute(rows)


def test_awkward_rows(spark):
    found = got(near_duplicates(nasty.docs(spark)))
    want = brute([(r[0], r[1]) for r in nasty.ROWS])
    # Wordless rows are linked with nothing, so they keep their own number.
    assert found == want
    left = sorted((r.doc_id is None, r.doc_id, r.text) for r in without_near_duplicates(nasty.docs(spark)).collect() if r.text and r.text.strip())
    kept = [(False, r[0], r[1]) for r in nasty.ROWS if r[0] in (1, 6, 7, nasty.BIG)]
    assert left == sorted({*kept, (True, None, nasty.ROWS[9][1])}, key=lambda x: (x[0], x[1] or 0, x[2]))
    wordless = [r.doc_id for r in without_near_duplicates(nasty.docs(spark)).collect() if not (r.text or "").strip()]
    assert sorted(wordless) == [3, 4, 5]


def test_empty_table(spark):
    assert near_duplicates(nasty.empty(spark)).count() == 0
    assert without_near_duplicates(nasty.empty(spark)).columns == nasty.docs(spark).columns


def test_shingle_hashes_match_sets():
    texts = [t for _, t in corpus()] + [nasty.LONG]
    assert [len(s) for s in shingle_sets(texts)] == [len(shingles(t)) for t in texts]
    a, b = shingle_sets([texts[0], texts[1]])
    assert len(np.intersect1d(a, b)) == len(shingles(texts[0]) & shingles(texts[1]))


def test_links_span_every_component():
    sets = list(shingle_sets([t for _, t in corpus() if t]))
    links = linked(sets)
    assert len(links) == len({i for pair in links for i in pair}) - len(_roots(links))


def _roots(links):
    up = {}
    for a, b in links:
        up[a] = b

    def top(i):
        while i in up:
            i = up[i]
        return i

    return {top(b) for _, b in links}


def test_components_of_a_long_chain(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)]
    df = spark.createDataFrame(pairs, "u bigint, v bigint")
    roots = {r.node: r.root for r in components(df).collect()}
    assert roots == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_own_columns_keep_their_names_and_values(spark):
    names = ["text_key", "row", "root", "n_rows", "cls"]
    docs = nasty.docs(spark).withColumns({n: F.col("rank") for n in names})
    out = without_near_duplicates(docs)
    assert out.columns == docs.columns
    assert all(r[n] == r["rank"] for r in out.collect() for n in names)


def test_rows_that_have_no_key_for_sure(spark):
    """No row with a key is passed over, and few others are doubtful."""
    df = spark.range(3000).select(F.when(F.col("id") > 0, F.col("id")).alias("doc_id"), F.xxhash64("id").alias("text_key"))
    keys = df.where("doc_id IS NULL OR doc_id % 10 = 0")
    found = key_filter.marked(df, keys, ["doc_id", "text_key"])
    assert found.columns == [*df.columns, "maybe"] and found.count() == 3000
    assert found.where("maybe AND (doc_id IS NULL OR doc_id % 10 = 0)").count() == keys.count()
    assert found.where("maybe").count() < keys.count() + 30
    assert found.where("maybe IS NULL").isEmpty()
    assert key_filter.marked(df, keys.limit(0), ["doc_id", "text_key"]).where("maybe").isEmpty()


def test_only_doubtful_rows_are_joined(spark, monkeypatch, capsys):
    """Also where every row is doubtful, the same rows stay."""
    docs = nasty.docs(spark).unionByName(nasty.docs(spark).where("doc_id % 2 = 0"))
    rows = lambda df: sorted(str(r) for r in df.collect())
    kept = without_near_duplicates(docs)
    kept.explain()
    assert "bit_or" in capsys.readouterr().out
    some = rows(kept)
    monkeypatch.setattr(key_filter, "WORDS", 1)
    assert rows(without_near_duplicates(docs)) == some


def test_keys_are_told_without_moving_rows(spark, monkeypatch, capsys):
    monkeypatch.setattr(key_filter, "WORDS", 8)
    names = ["doc_id", "text_key"]
    every = [(i if i % 50 else None, i * 7) for i in range(600)]
    df = spark.createDataFrame([(*k, c) for k in every for c in "ab"], "doc_id bigint, text_key bigint, own string")
    for share, few in ((3, 1 << 20), (3, 0), (600, 1 << 20), (1, 1 << 20)):
        keys = spark.createDataFrame([k for k in every if k[1] % share == 0], "doc_id bigint, text_key bigint")
        others = spark.createDataFrame([k for k in every if k[1] % share], "doc_id bigint, text_key bigint")
        found = key_filter.told(df, keys, others, names, few)
        assert found.columns == [*df.columns, "has"]
        assert sorted(map(repr, found.collect())) == sorted(map(repr, df.withColumn("has", df.text_key % share == 0).collect()))
    found.explain()
    assert "hashpartitioning(doc_id" not in capsys.readouterr().out
