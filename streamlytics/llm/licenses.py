"""License texts found by patience alignment.

Only words that occur in some license template are kept of a text, with their places. A template
is looked for where enough of its distinct words lie close together; that stretch is aligned with
the template by patience: words that are unique on both sides are anchors, the longest increasing
run of anchors is kept, and the gaps between them are aligned the same way; a small gap without an
anchor gives its longest common run of words. Coverage is the share
of template words that were aligned. A hit needs all words that tell its license from others, no
word of another variant in between, and few other words; of rivals for one place the best stays.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlytics.llm.common import id_number, id_text
from streamlytics.llm.words import batched, word_places

COVERAGE = 0.8
#: A template may be stretched over this many times its words.
STRETCH = 1.5
#: A gap without anchors is aligned word by word up to this product of its two lengths.
GAP_CELLS = 1024

# Notices and texts of public licenses.
TEMPLATES = {
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "MIT notice": "Released under the MIT License.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": """Licensed under the Apache License, Version 2.0 (the "License"); you may
        not use this file except in compliance with the License. You may obtain a copy of the
        License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or
        agreed to in writing, software distributed under the License is distributed on an "AS IS"
        BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the
        License for the specific language governing permissions and limitations under the
        License.""",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this
        software and associated documentation files (the "Software"), to deal in the Software
        without restriction, including without limitation the rights to use, copy, modify, merge,
        publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons
        to whom the Software is furnished to do so, subject to the following conditions: The above
        copyright notice and this permission notice shall be included in all copies or substantial
        portions of the Software.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with
        or without fee is hereby granted, provided that the above copyright notice and this
        permission notice appear in all copies.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without
        modification, are permitted provided that the following conditions are met:
        Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. Redistributions in binary form must reproduce the
        above copyright notice, this list of conditions and the following disclaimer in the
        documentation and/or other materials provided with the distribution.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without
        modification, are permitted provided that the following conditions are met:
        Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. Redistributions in binary form must reproduce the
        above copyright notice, this list of conditions and the following disclaimer in the
        documentation and/or other materials provided with the distribution. Neither the name of
        the copyright holder nor the names of its contributors may be used to endorse or promote
        products derived from this software without specific prior written permission.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is
        free to copy, modify, publish, use, compile, sell, or distribute this software, either in
        source code form or as a compiled binary, for any purpose, commercial or non-commercial,
        and by any means.""",
    "BSL-1.0": """Permission is hereby granted, free of charge, to any person or organization
        obtaining a copy of the software and accompanying documentation covered by this license
        (the "Software") to use, reproduce, display, distribute, execute, and transmit the
        Software, and to prepare derivative works of the Software, and to permit third-parties to
        whom the Software is furnished to do so, all subject to the following:""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event
        will the authors be held liable for any damages arising from the use of this software.
        Permission is granted to anyone to use this software for any purpose, including commercial
        applications, and to alter it and redistribute it freely, subject to the following
        restrictions:""",
    "GPL-3.0 header": """This program is free software: you can redistribute it and/or modify it
        under the terms of the GNU General Public License as published by the Free Software
        Foundation, either version 3 of the License, or (at your option) any later version.""",
    "CC-BY-4.0 notice": """This work is licensed under a Creative Commons Attribution 4.0
        International License.""",
    "MPL-2.0 header": """This Source Code Form is subject to the terms of the Mozilla Public
        License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain
        one at http://mozilla.org/MPL/2.0/.""",
    "BSD notice": "Released under the BSD License.",
    "CC-BY-4.0 short notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0 notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-ND-4.0 notice": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA-4.0 notice": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-ND-4.0 notice": "Licensed under CC BY-NC-ND 4.0.",
    "GPL-2.0 notice": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0 notice": """This work is licensed under the GNU Lesser General Public License,
        version 3.""",
    "LGPL-2.1 notice": """This work is licensed under the GNU Lesser General Public License,
        version 2.1.""",
    "AGPL-3.0 notice": """This work is licensed under the GNU Affero General Public License,
        version 3.""",
    "GPL-2.0 header": """This program is free software; you can redistribute it and/or modify it
        under the terms of the GNU General Public License as published by the Free Software
        Foundation; either version 2 of the License, or (at your option) any later version.""",
    "LGPL-3.0 header": """This library is free software: you can redistribute it and/or modify it
        under the terms of the GNU Lesser General Public License as published by the Free Software
        Foundation, either version 3 of the License, or (at your option) any later version.""",
    "LGPL-2.1 header": """This library is free software; you can redistribute it and/or modify it
        under the terms of the GNU Lesser General Public License as published by the Free Software
        Foundation; either version 2.1 of the License, or (at your option) any later version.""",
    "AGPL-3.0 header": """This program is free software: you can redistribute it and/or modify it
        under the terms of the GNU Affero General Public License as published by the Free Software
        Foundation, either version 3 of the License, or (at your option) any later version.""",
}

#: Words of a variant: a template without them is no match for a stretch that holds one.
VARIANTS = """lesser affero nc sa nd noncommercial commercial sharealike alike noderivatives
noderivs derivatives""".split()
#: Words that tell licenses apart: those a template has must be aligned.
TELLING = [*VARIANTS, *"mit bsd apache mozilla gnu cc creative 1 2 3 4".split()]


def _increasing(values: list[int]) -> list[int]:
    """Places of a longest increasing run, by patience piles."""
    tops: list[int] = []
    top_at: list[int] = []
    before: list[int] = []
    for i, v in enumerate(values):
        pile = bisect_left(tops, v)
        before.append(top_at[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(v), top_at.append(i)
        else:
            tops[pile], top_at[pile] = v, i
    run, at = [], top_at[-1] if top_at else -1
    while at >= 0:
        run.append(at)
        at = before[at]
    return run[::-1]


def _common(a: list, b: list) -> list[tuple[int, int]]:
    """Places of a longest common subsequence."""
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    pairs, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return pairs


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned places of two word lists, increasing on both sides."""
    found: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        # Equal words at either end need no anchor.
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {b[j]: j for j in range(b0, b1) if in_b[b[j]] == 1}
        anchors = [(i, place[a[i]]) for i in range(a0, a1) if in_a[a[i]] == 1 and a[i] in place]
        kept = [anchors[k] for k in _increasing([j for _, j in anchors])]
        found += kept
        edges = [(a0 - 1, b0 - 1), *kept, (a1, b1)]
        if kept:
            todo += [
                (i + 1, i2, j + 1, j2) for (i, j), (i2, j2) in zip(edges, edges[1:], strict=False)
            ]
        elif (a1 - a0) * (b1 - b0) <= GAP_CELLS:
            found += [(a0 + i, b0 + j) for i, j in _common(a[a0:a1], b[b0:b1])]
    return sorted(found)


class Templates:
    """Template words as hashes, and which templates hold which word."""

    def __init__(self, templates: dict[str, str]):
        self.names = list(templates)
        parts = [templates[n].encode() for n in self.names]
        hashes, _, _, counts = word_places(parts)
        ends = np.cumsum(counts)
        self.words = [hashes[e - c : e].tolist() for e, c in zip(ends, counts, strict=True)]
        self.vocabulary = np.unique(hashes)
        self.holds = np.zeros((len(self.names), len(self.vocabulary)), dtype=bool)
        for k, words in enumerate(self.words):
            self.holds[k, np.searchsorted(self.vocabulary, words)] = True
        self.distinct = self.holds.sum(axis=1)
        self.lengths = counts
        telling, variants = (word_places([" ".join(w).encode()])[0].tolist() for w in (TELLING, VARIANTS))
        self.telling = [set(words) & set(telling) for words in self.words]
        self.foreign = [set(variants) - set(words) for words in self.words]


@cache
def _built_in() -> Templates:
    return Templates(TEMPLATES)


def _score(places: list[int], pairs: list[tuple[int, int]], wanted: int) -> float:
    """Aligned words on both sides, over all of the template and of the stretch."""
    return 2 * len(pairs) / (wanted + places[pairs[-1][0]] - places[pairs[0][0]] + 1)


def _trimmed(places: list[int], pairs: list[tuple[int, int]], wanted: int) -> list[tuple[int, int]]:
    """Pairs without stray ones at the ends, which stretch more than they add."""
    if not pairs:
        return pairs
    pairs = pairs[max(range(len(pairs)), key=lambda k: _score(places, pairs[k:], wanted)) :]
    return pairs[: max(range(len(pairs), 0, -1), key=lambda k: _score(places, pairs[:k], wanted))]


def _found(
    places: list[int], words: list[int], wanted: list[int], need: int, coverage: float, telling: set[int]
) -> Iterator[tuple[int, int, float]]:
    """(first place, last place, coverage) of each time the template occurs.

    ``need`` distinct template words within a template's stretched length start a try; words up to
    as far again are aligned, since the template may begin late in that window.
    """
    span = int(np.ceil(STRETCH * len(wanted))) + 2
    inside: Counter = Counter()
    start, stop = 0, 0
    while start < len(places):
        while stop < len(places) and places[stop] < places[start] + span:
            inside[words[stop]] += 1
            stop += 1
        step = 1
        if len(inside) >= need:
            end = bisect_left(places, places[start] + 2 * span)
            pairs = patience(words[start:end], wanted)
            if len(pairs) >= coverage * len(wanted):
                pairs = _trimmed(places[start:end], pairs, len(wanted))
            if (
                len(pairs) >= coverage * len(wanted)
                and _score(places[start:end], pairs, len(wanted)) >= coverage
                and telling <= {wanted[j] for _, j in pairs}
            ):
                first, last = start + pairs[0][0], start + pairs[-1][0]
                # The alignment may have taken a later copy.
                if first - start >= need:
                    yield from _found(places[start:first], words[start:first], wanted, need, coverage, telling)
                yield places[first], places[last], len(pairs) / len(wanted)
                step = last + 1 - start
        for word in words[start : min(start + step, stop)]:
            inside[word] -= 1
            if not inside[word]:
                del inside[word]
        start += step
        stop = max(start, stop)


def _best(
    hits: list[tuple[int, int, int, float, tuple[int, float]]],
) -> Iterator[tuple[int, int, int, float]]:
    """(template, first, last, coverage) of hits that no better one of another template rivals.

    Rivals share more than half of the longer stretch, so a notice inside a header is none. The one
    with more aligned words is better, then the one with the higher score; where both are equal,
    both stay.
    """
    hits = sorted(hits, key=lambda h: h[1:3])
    beaten = set()
    for i, (k, first, last, _, score) in enumerate(hits):
        for j in range(i + 1, len(hits)):
            other, a, b, _, its = hits[j]
            if a > last:
                break
            if other != k and 2 * (min(last, b) - a + 1) > max(last - first, b - a) + 1 and score != its:
                beaten.add(i if score < its else j)
    for i, hit in enumerate(hits):
        if i not in beaten:
            yield hit[:4]


def scan(texts, templates: Templates, coverage: float = COVERAGE) -> Iterator[tuple[int, str, int, int, float]]:
    """(text number, license, first word, last word, coverage) of every license found."""
    for at, batch in batched(texts):
        hashes, _, owner, counts = word_places(batch)
        if not len(hashes):
            continue
        vocab = templates.vocabulary
        place = np.minimum(np.searchsorted(vocab, hashes), len(vocab) - 1)
        kept = np.flatnonzero(vocab[place] == hashes)
        starts = np.cumsum(counts) - counts
        own, ids = owner[kept], place[kept]
        present = np.zeros((len(batch), len(vocab)), dtype=bool)
        present[own, ids] = True
        # Each aligned word that may be missing takes at most one distinct word with it.
        missing = np.floor((1 - coverage) * templates.lengths + 1e-9)
        need = np.maximum(1, templates.distinct - missing).astype(int)
        enough = present.astype(np.int32) @ templates.holds.T.astype(np.int32) >= need
        hits: dict[int, list] = {}
        for text, k in np.argwhere(enough):
            lo, hi = np.searchsorted(own, [text, text + 1])
            mine = templates.holds[k, ids[lo:hi]]
            places = (kept[lo:hi][mine] - starts[text]).tolist()
            words = hashes[kept[lo:hi][mine]].tolist()
            wanted = templates.words[k]
            begin = starts[text]
            for first, last, share in _found(places, words, wanted, int(need[k]), coverage, templates.telling[k]):
                inner = hashes[begin + first : begin + last + 1].tolist()
                if templates.foreign[k].isdisjoint(inner):
                    score = 2 * share * len(wanted) / (len(wanted) + len(inner))
                    rated = (round(share * len(wanted)), score)
                    hits.setdefault(int(text), []).append((int(k), first, last, share, rated))
        for text, own_hits in hits.items():
            for k, first, last, share in _best(own_hits):
                yield at + text, templates.names[k], first, last, share


def licenses(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, license, first_word, last_word, coverage) of every license text in ``docs``.

    Words are runs of letters and digits, A-Z lower-cased, counted from 0. Defined cases: a null or
    empty text holds none; a license that is repeated is found each time; a short notice that is
    part of a longer one is found as itself too; words of ``TELLING`` count in given templates too; repeated rows give repeated results; an empty
    table gives no rows; other columns are ignored.
    """

    def run(batches):
        known = Templates(templates) if templates is not None else _built_in()
        for pdf in batches:
            found = list(scan(pdf["text"], known, coverage))
            if not found:
                continue
            rows = pdf["doc_id"].iloc[[f[0] for f in found]].reset_index(drop=True)
            yield pd.DataFrame(
                {
                    "doc_id": rows,
                    "license": [f[1] for f in found],
                    "first_word": [f[2] for f in found],
                    "last_word": [f[3] for f in found],
                    "coverage": [f[4] for f in found],
                }
            )

    found = docs.select(id_text(), "text").mapInPandas(
        run,
        "doc_id string, license string, first_word bigint, last_word bigint, coverage double",
    )
    return id_number(found)
