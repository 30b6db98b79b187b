import random

import nasty

from streamlytics.llm.licenses import TEMPLATES, Templates, licenses, patience, scan
from streamlytics.llm.words import word_places

MIT = TEMPLATES["MIT"]


def found(texts, **options):
    return [(i, name) for i, name, *_ in scan(texts, Templates(TEMPLATES), **options)]


def common(a, b):
    """Length of the longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        old = 0
        for j, y in enumerate(b, 1):
            old, row[j] = row[j], old + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_patience_aligns_in_order():
    rng = random.Random(2)
    for _ in range(300):
        a = [rng.randrange(30) for _ in range(rng.randrange(40))]
        b = [x for x in a if rng.random() < 0.8]
        pairs = patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
        assert len(pairs) <= common(a, b)
    distinct = list(range(100))
    assert len(patience(distinct, [x for x in distinct if x % 3])) == 66
    assert patience([], [1]) == [] and patience([1], []) == []


def test_whole_edited_and_repeated_texts():
    words = MIT.split()
    edited = " ".join(w for i, w in enumerate(words) if i % 12)
    half = " ".join(words[: len(words) // 2])
    filler = "some other words of the text in between " * 50
    texts = [MIT, filler + edited + filler, half, MIT + filler + MIT, "", None, filler, MIT.upper()]
    got = [f for f in found(texts) if f[1] == "MIT"]
    assert got == [(0, "MIT"), (1, "MIT"), (3, "MIT"), (3, "MIT"), (7, "MIT")]
    place = next(scan(["one two\nReleased under the MIT License. end"], Templates(TEMPLATES)))
    assert place == (0, "MIT notice", 2, 6, 1.0)


def test_scattered_words_are_no_license():
    scattered = (" far apart " * 20).join(TEMPLATES["Apache-2.0 notice"].split())
    assert found([scattered]) == []


def test_awkward_rows(spark):
    docs = nasty.docs(spark)
    note = docs.unionByName(spark.createDataFrame([(9, "x\nReleased under the MIT License.", "en", "a", 1, "k", 1)] * 2, nasty.SCHEMA))
    assert [tuple(r)[:4] for r in licenses(note.coalesce(1)).collect()] == [(9, "MIT notice", 1, 5)] * 2
    assert licenses(docs).count() == 0 and licenses(nasty.empty(spark)).count() == 0


def test_neighbouring_licenses_and_prose():
    want = {
        "Released under the BSD License.": ["BSD notice"],
        "It was released in May under the terms of a license.": [],
        "Licensed under CC BY 4.0.": ["CC-BY-4.0 short notice"],
        "Licensed under CC BY-NC-SA 4.0.": ["CC-BY-NC-SA-4.0 notice"],
        "Licensed under CC BY-NC 3.0.": [],
        TEMPLATES["GPL-3.0 notice"].replace("3", "2"): ["GPL-2.0 notice"],
        "This work is licensed under the GNU Lesser General Public License.": [],
        "Released softly under all of the many other words that are near MIT License": [],
        **{TEMPLATES[n]: [n] for n in TEMPLATES if n not in ("Apache-2.0 header",)},
    }
    assert {t: [n for _, n in found([t])] for t in want} == want
    assert sorted(n for _, n in found([TEMPLATES["Apache-2.0 header"]])) == ["Apache-2.0 header", "Apache-2.0 notice"]


def test_texts_that_lost_a_fifth_of_their_words():
    """Each text that keeps 80 to 100 % of a template, its telling words among them, is found."""
    known = Templates(TEMPLATES)
    rng = random.Random(7)
    for k, name in enumerate(known.names):
        words = TEMPLATES[name].split()
        single = [word_places([w.encode()])[0].tolist() for w in words]
        loose = [i for i, own in enumerate(single) if not known.telling[k] & set(own)]
        for percent in (80, 83, 86, 90, 95, 100):
            for _ in range(5):
                gone = set()
                for i in rng.sample(loose, len(loose)):
                    left = sum(len(own) for j, own in enumerate(single) if j not in gone and j != i)
                    if left >= percent / 100 * len(known.words[k]):
                        gone.add(i)
                text = "before it " + " ".join(w for i, w in enumerate(words) if i not in gone) + " after it"
                got = [(n, c) for _, n, _, _, c in scan([text], known)]
                assert name in [n for n, _ in got], (name, percent, text, got)


def test_longer_license_is_named():
    for name in ("BSD-3-Clause", "BSD-2-Clause", "Unlicense", "BSL-1.0", "Zlib"):
        words = TEMPLATES[name].split()
        assert [n for _, n in found([TEMPLATES[name]])] == [name]
        assert [n for _, n in found([" ".join(w for i, w in enumerate(words) if i % 11 != 5)])] == [name]


def test_copies_that_follow_each_other():
    for name in ("MIT notice", "GPL-3.0 notice", "MIT"):
        for n in (2, 3, 5):
            assert found(["the " + " ".join([TEMPLATES[name]] * n)]) == [(0, name)] * n
