import hashlib
import math
from collections import Counter

import nasty
import numpy as np

from streamlytics.llm import rare_features
from streamlytics.llm.rare_features import WINDOW, entropies, fingerprinted, fingerprints, likeness, nearness


def plain_entropy(window: bytes) -> float:
    n = len(window)
    return -sum(c / n * math.log2(c / n) for c in Counter(window).values())


def test_running_entropies_equal_plain_ones(monkeypatch):
    data = (nasty.LONG[:700] + "aaaa" * 40 + "漢字 😀 é" * 9).encode()
    want = [1000 * plain_entropy(data[i : i + WINDOW]) / 6 for i in range(len(data) - WINDOW + 1)]
    got = entropies(np.frombuffer(data, dtype=np.uint8))
    assert np.abs(got - np.array(want)).max() <= 1
    monkeypatch.setattr(rare_features, "_CHUNK", 100)
    assert np.array_equal(entropies(np.frombuffer(data, dtype=np.uint8)), got)


def test_prints_do_not_depend_on_neighbours():
    texts = [nasty.LONG[:5000].encode(), b"", b"short", nasty.LONG[3000:9000].encode()]
    assert fingerprints(texts) == [fingerprints([t])[0] for t in texts]
    assert fingerprints(texts)[1:3] == ["", ""]


def test_likeness_follows_the_shared_part():
    import random

    rng = random.Random(5)
    text = lambda n: " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 9))) for _ in range(n))  # noqa: E731,E501
    a, b = text(3000), text(3000)
    most, half, none = fingerprints([(a[:-500] + b[:500]).encode(), (a[: len(a) // 2] + b).encode(), b.encode()])
    own = fingerprints([a.encode()])[0]
    assert likeness(own, own) == 1.0
    assert 0.8 < likeness(own, most) < 1
    assert 0.3 < likeness(own, half) < 0.75
    assert likeness(own, none) < 0.1
    assert likeness(own, "") == 0.0 and likeness("", "") == 1.0


def want(rows):
    key = lambda r: (r[0] is not None, r[0] or 0)
    rows = sorted(((r[0], r[1] or "") for r in rows), key=key)
    out = []
    for i, (doc_id, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        out.append((doc_id, len(text), hashlib.sha256((text[: len(text) - half] + following[:half]).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_next_documents_over_partitions(spark, monkeypatch):
    monkeypatch.setattr(rare_features, "PARTITION_DOCS", 7)
    rows = [(i * 7 % 101, f"{i} " * (i * 37 % 90)) for i in range(101)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = fingerprinted(df).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=repr) == want(rows)
    text = dict(rows)
    assert all(r.fingerprint == fingerprints([text[r.doc_id].encode()])[0] for r in got)


def test_awkward_rows(spark):
    got = fingerprinted(nasty.docs(spark)).collect()
    assert sorted((r.doc_id or 0, r.n_chars) for r in got) == sorted((r[0] or 0, len(r[1] or "")) for r in nasty.ROWS)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert fingerprinted(nasty.empty(spark)).count() == 0
    one = fingerprinted(nasty.docs(spark).where(f"doc_id = {nasty.BIG}")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_short_texts_have_prints():
    text = nasty.LONG.encode()
    prints = fingerprints([text[i : i + n] for n in range(8, 140) for i in (0, 50)] + [b"a" * 200])
    assert all(prints)

    def near(a, b):
        return nearness(a, b, *fingerprints([a, b]))

    assert near(b"one two", b"one two") == near(b"", b"") == 1.0
    assert near(b"one two", b"another") == near(b"", b"some text") == 0.0
    a, b = b"The cat sat on the mat while it rained.", b"Invoices are due by the tenth of May!!"
    assert near(a, b) < 0.1 and 0.3 < near(a, a[:20] + b[:19]) < 0.7
    assert near(a, b * 3 + a + b) == 1.0 and near(a, b * 3) < 0.1


def test_short_neighbours_are_not_alike(spark):
    rows = [(1, "The cat sat on the mat."), (2, "Invoices are due by May."), (3, "tiny"), (4, "size")]
    got = fingerprinted(spark.createDataFrame(rows, "doc_id bigint, text string")).orderBy("doc_id").collect()
    assert all(r.near_next < 0.1 for r in got)
    assert all(r.near_edited < 1 for r in got) and all(r.fingerprint for r in got[:2])
