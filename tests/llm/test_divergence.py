import random
import re
from collections import Counter, defaultdict

import nasty
import numpy as np
import pytest

from streamlytics.llm import divergence
from streamlytics.llm.divergence import apart, audit, shares

SCHEMA = "doc_id bigint, text string, lang string, source string, n bigint, term string"


def plain(rows, least=10, top=10):
    """(lang, source, part, item, value, rank) by the definition, with unbounded whole numbers."""
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    docs, cells, groups = Counter(), Counter(), defaultdict(set)
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))
        docs.update((lang, t) for t in set(terms))
        cells.update((lang, source, t) for t in terms)
    out = []
    for lang, sources in groups.items():
        kept = [t for (g, t), n in docs.items() if g == lang and n >= least]
        total = {s: sum(cells[lang, s, t] for t in kept) for s in sources}
        share = lambda n, all_n: 1 + 10**9 * (n + 2) // (all_n + 2 * len(kept))  # noqa: B023, E731
        p = {(s, t): share(cells[lang, s, t], total[s]) for s in sources for t in kept}
        q = {t: share(sum(cells[lang, s, t] for s in sources), sum(total.values())) for t in kept}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(o, sum(f(p[s, t], p[o, t]) for t in kept)) for o in sources if o != s]
            terms = [(t, f(p[s, t], q[t])) for t in kept if cells[lang, s, t] and p[s, t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                found = found if part == "pair" else found[:top]
                out += [(lang, s, part, i, v, r + 1) for r, (i, v) in enumerate(found)]
    return sorted(out)


def made(n=400):
    rng = random.Random(2)
    words = [*"abcdefghij", "Straße", "ÄÖ", "ÄÖ", "漢字", "😀", "Zz", "zz", "x1y", "a_b", "é́"]
    weights = {s: [rng.random() ** 3 for _ in words] for s in ("s1", "s2", "", "s4", None)}
    rows = []
    for i in range(n):
        source = rng.choice(list(weights))
        text = rng.choice([" ", "\x00", "@", "[", "{", "\x7f"]).join(rng.choices(words, weights[source], k=rng.randrange(30)))
        rows.append((i, text, rng.choice(["en", "en", "de", None, ""]), source, 1, "t"))
    return [*rows, *rows[:50], (None, None, "fr", None, 1, "t"), (7, "", "fr", "x", 1, "t"), (8, "a b", "en", "none of these", 0, None)]


@pytest.mark.parametrize("cells,held,piece", [(1 << 19, 400_000, 4 << 20), (7, 3, 10)])
def test_equals_the_plain_version(spark, monkeypatch, cells, held, piece):
    for name, value in (("SHARD_CELLS", cells), ("HELD", held), ("SLICE_BYTES", piece)):
        monkeypatch.setattr(divergence, name, value)
    rows = made()
    found = sorted(map(tuple, audit(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()))
    assert found == plain(rows)


def test_awkward_rows(spark):
    found = audit(nasty.docs(spark), least_docs=1, top=3)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, found.collect())) == plain(nasty.ROWS, 1, 3)


def test_no_terms_and_empty_tables(spark):
    assert audit(nasty.empty(spark)).count() == 0
    rows = [(1, "rare words", "en", "a", 0, None), (2, None, "en", "b", 0, None), (3, "x", "de", "a", 0, None)]
    found = sorted(map(tuple, audit(spark.createDataFrame(rows, SCHEMA)).collect()))
    assert found == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)] == plain(rows)


def test_shares_are_exact_for_large_counts():
    rng = random.Random(4)
    for _ in range(200):
        v = rng.choice([1, 5, 10**6])
        total = rng.randrange(9 * 10**15 // 2)
        n = rng.choice([0, total, rng.randrange(total + 1)])
        assert shares(np.array([n], dtype=np.int64), total, v)[0] == 1 + 10**9 * (n + 2) // (total + 2 * v)
    p, q = np.array([10**9 + 1], dtype=np.int64), np.array([1], dtype=np.int64)
    assert apart(p, q)[0] == 10**18 // (10**9 + 2)
