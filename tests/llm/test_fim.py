import hashlib
import random
import re

import nasty
import pytest
from pyspark.sql import functions as F

from streamlytics.llm import fim
from streamlytics.llm.fim import SkipList, fill_in_middle, restored, unit_ends

WORDS = r"\w+"


def texts():
    rng = random.Random(5)
    pool = ["a", "bc", " ", "\n", "é", "漢", "😀", "é", "x" * 40, ".", ""]
    return ["", "a", *("".join(rng.choice(pool) for _ in range(rng.randrange(900))) for _ in range(60))]


@pytest.mark.parametrize("unit", [None, r"\w+", r"\S+\s*", r"[^\n]*\n", "x*"])
def test_ranks_are_reached_exactly(unit):
    for text in texts():
        pattern = re.compile(unit) if unit else None
        ends = [0, *(unit_ends(text, pattern) if unit else range(1, len(text) + 1))]
        assert ends[-1] == len(text)
        skips = SkipList(text, pattern)
        assert skips.size == len(ends) - 1
        assert [skips.point(r) for r in range(skips.size + 1)] == ends


def test_a_long_text_has_many_lanes():
    skips = SkipList("ab" * 500_000)
    assert len(skips.lanes) > 3 and skips.point(777_777) == 777_777
    assert max(len(skips.lanes[-1][0]), 1) <= fim.LANE


def want(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    form = "spm" if h4 % 100 < 20 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, n, form, a, b - a, out


@pytest.mark.parametrize("batch", [1, 1 << 22])
def test_awkward_rows_and_round_trip(spark, monkeypatch, batch):
    monkeypatch.setattr(fim, "BATCH_CHARS", batch)
    marked = [(100 + i, f"left <{'<' * i} {m} right{'<' * i}", "en", "a", 3, "k", 1) for i, m in enumerate(["<P>", "<S>", "<M>", "P>", "<P"])]
    open_ended = [(200 + i, "<<<P" * 5 + ">S><M" * i, None, None, None, None, None) for i in range(40)]
    docs = nasty.docs(spark).union(spark.createDataFrame(marked + open_ended, nasty.SCHEMA))
    made = fill_in_middle(docs)
    assert made.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    found = made.withColumn("text", restored(F.col("form"), F.col("output"))).collect()
    source = [(r[0], r[1]) for r in nasty.ROWS + marked + open_ended]
    assert sorted((tuple(r)[:6] for r in found), key=repr) == sorted((want(*r) for r in source), key=repr)
    assert sorted(((r.doc_id, r.text) for r in found), key=repr) == sorted(((d, t or "") for d, t in source), key=repr)
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_words_as_units(spark):
    docs = nasty.docs(spark)
    made = fill_in_middle(docs, seed=2, unit=WORDS).withColumn("text", restored(F.col("form"), F.col("output")))
    texts_by_row = sorted((r[1] or "" for r in nasty.ROWS))
    assert sorted(r.text for r in made.collect()) == texts_by_row
    for r in made.where("form <> 'plain'").collect():
        ends = [0, *unit_ends(r.text, re.compile(WORDS))]
        assert r.n == len(ends) - 1 and r.prefix_chars in ends and r.prefix_chars + r.middle_chars in ends


def test_empty_table(spark):
    assert fill_in_middle(nasty.empty(spark)).count() == 0
