"""Text quality by a generalised additive model with pairwise interactions.

Texts are turned into a few numbers by array operations over many texts at once. Each feature is
cut into quantile bins; cyclic boosting goes round the features again and again, fitting a small
tree over one feature's bins to the gradient and adding it to that feature's lookup table. The
feature pairs with the largest leftover gain get two-dimensional tables the same way. A score is
a sum of looked-up numbers.

Training reads at most ``SAMPLE`` labelled documents, chosen by a hash of their id; a few numbers
of each reach the driver. Scoring reads every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlytics.llm.common import id_number, id_text
from streamlytics.llm.shingles import _of_words, word_hashes

SAMPLE = 20_000
BINS, COARSE = 32, 8
PAIRS = 10
ROUNDS, PAIR_ROUNDS = 200, 60
RATE, SMOOTH = 0.1, 1.0
_BATCH_BYTES = 4 << 20

FEATURES = """words word_bytes upper symbol digit full_stop shout bar short_word wide distinct top
twin triple line repeated_line tail""".split()

_KIND = np.zeros((8, 256), dtype=np.uint8)  # one row of marks per kind of byte
_ascii = np.arange(256)
_alnum = np.array([chr(c).isalnum() and c < 128 for c in _ascii])
_blank = np.isin(_ascii, [9, 10, 11, 12, 13, 32])
_plain = np.isin(_ascii, [ord(c) for c in ".,;:!?'\"()-"])
_KIND[0] = (_ascii >= 65) & (_ascii <= 90)
_KIND[1] = (_ascii < 128) & ~_alnum & ~_blank & ~_plain & (_ascii > 32)
_KIND[2] = (_ascii >= 48) & (_ascii <= 57)
_KIND[3] = np.isin(_ascii, [ord("."), ord(",")])
_KIND[4] = _ascii == ord("!")
_KIND[5] = _ascii == ord("|")
_KIND[6] = _ascii >= 128
_KIND[7] = _ascii == 10


def _share(parts: np.ndarray, of) -> np.ndarray:
    return parts / np.maximum(of, 1)


def features(parts: list[bytes]) -> np.ndarray:
    """A row of numbers per text; all zero for an empty one."""
    data = np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    ends = np.cumsum(sizes + 1)
    starts = ends - sizes - 1
    sums = [np.concatenate(([0], np.cumsum(k[data], dtype=np.int64))) for k in _KIND]
    kinds = np.stack([s[starts + sizes] - s[starts] for s in sums])
    hashes, counts = word_hashes(parts)
    blank = _blank[data]
    word_edges = np.flatnonzero(np.diff(blank, prepend=True))
    first, after = word_edges[::2], word_edges[1::2]
    lengths = after - first
    tails = _KIND[1][data[after - 1]]
    to = np.concatenate(([0], np.cumsum(counts)))
    short = np.concatenate(([0], np.cumsum(lengths <= 3)))
    tail = np.concatenate(([0], np.cumsum(tails, dtype=np.int64)))
    triples = _of_words(hashes, 3) if len(hashes) >= 3 else hashes[:0]
    same = np.concatenate((hashes[1:] == hashes[:-1], [False])) if len(hashes) else np.zeros(0, bool)
    out = np.zeros((len(parts), len(FEATURES)))
    n = counts.astype(np.float64)
    out[:, 0] = np.log1p(n)
    out[:, 1] = _share(sizes - kinds[7], n)
    out[:, 2] = _share(kinds[0], sizes)
    out[:, 3] = _share(kinds[1], sizes)
    out[:, 4] = _share(kinds[2], sizes)
    out[:, 5] = _share(kinds[3], n)
    out[:, 6] = _share(kinds[4], n)
    out[:, 7] = _share(kinds[5], n)
    out[:, 8] = _share(short[to[1:]] - short[to[:-1]], n)
    out[:, 9] = _share(kinds[6], sizes)
    out[:, 14] = _share(kinds[7], n)
    out[:, 16] = _share(tail[to[1:]] - tail[to[:-1]], n)
    for i, (a, b) in enumerate(zip(to[:-1].tolist(), to[1:].tolist(), strict=True)):
        if a == b:
            continue
        repeats = np.unique(hashes[a:b], return_counts=True)[1]
        out[i, 10], out[i, 11] = len(repeats) / (b - a), repeats.max() / (b - a)
        out[i, 12] = same[a : b - 1].sum() / (b - a)
        if b - a >= 3:
            out[i, 13] = len(np.unique(triples[a : b - 2])) / (b - a - 2)
        lines = parts[i].split(b"\n")
        out[i, 15] = 1 - len(set(lines)) / len(lines)
    return out


def _batched(texts) -> Iterator[list[bytes]]:
    batch, size = [], 0
    for text in texts:
        part = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""
        batch.append(part)
        size += len(part)
        if size >= _BATCH_BYTES:
            yield batch
            batch, size = [], 0
    if batch:
        yield batch


def text_features(texts) -> np.ndarray:
    found = [features(b) for b in _batched(texts)]
    return np.vstack(found) if found else np.zeros((0, len(FEATURES)))


@dataclass
class AdditiveModel:
    """Bin edges, one table per feature, and one per chosen pair."""

    edges: list[np.ndarray]
    coarse: list[np.ndarray]
    tables: np.ndarray
    pairs: list[tuple[int, int]]
    pair_tables: np.ndarray
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for f, edges in enumerate(self.edges):
            total += self.tables[f, np.searchsorted(edges, x[:, f], side="right")]
        small = {f: np.searchsorted(self.coarse[f], x[:, f], side="right") for p in self.pairs for f in p}
        for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[small[a], small[b]]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def _leaf(g: float, h: float) -> float:
    return g / (h + SMOOTH)


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """The largest gain of one cut of a run of bins, and its place (0: none)."""
    if len(g) < 2:
        return 0.0, 0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    all_g, all_h = g.sum(), h.sum()
    gain = (
        left_g**2 / (left_h + SMOOTH)
        + (all_g - left_g) ** 2 / (all_h - left_h + SMOOTH)
        - all_g**2 / (all_h + SMOOTH)
    )
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A tree of at most three leaves over one feature's bins, as a step per bin."""
    _, cut = _best_cut(g, h)
    bounds = [0, cut, len(g)] if cut else [0, len(g)]
    if cut:
        halves = [(_best_cut(g[a:b], h[a:b]), a) for a, b in ((0, cut), (cut, len(g)))]
        (gain, at), offset = max(halves)
        if gain > 0 and at:
            bounds = sorted({*bounds, offset + at})
    out = np.zeros(len(g))
    for a, b in zip(bounds, bounds[1:], strict=False):
        out[a:b] = _leaf(g[a:b].sum(), h[a:b].sum())
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best pair of cuts over a table of two features: its gain, and a step per cell."""
    cg, ch = (np.pad(v.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for v in (g, h))
    n, m = g.shape
    i, j = np.arange(1, n)[:, None], np.arange(1, m)[None, :]
    parts = []
    for c in (cg, ch):
        a = c[i, j]
        b, d = c[i, m] - a, c[n, j] - a
        parts.append(np.stack([a, b, d, c[n, m] - a - b - d]))
    gains = (parts[0] ** 2 / (parts[1] + SMOOTH)).sum(axis=0)
    a, b = np.unravel_index(int(np.argmax(gains)), gains.shape)
    values = parts[0][:, a, b] / (parts[1][:, a, b] + SMOOTH)
    out = np.empty((n, m))
    out[: a + 1, : b + 1], out[: a + 1, b + 1 :], out[a + 1 :, : b + 1], out[a + 1 :, b + 1 :] = values
    return float(gains[a, b] - cg[n, m] ** 2 / (ch[n, m] + SMOOTH)), out


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Cyclic boosting under the logistic loss. Without rows, every score is one half."""
    n_features = len(FEATURES)
    quantiles = lambda n: [
        np.unique(np.quantile(x[:, f], np.linspace(0, 1, n + 1)[1:-1])) if len(x) else np.zeros(0)
        for f in range(n_features)
    ]
    edges, coarse = quantiles(BINS), quantiles(COARSE)
    tables = np.zeros((n_features, BINS))
    share = min(max(float(y.mean()), 1e-3), 1 - 1e-3) if len(y) else 0.5
    model = AdditiveModel(edges, coarse, tables, [], np.zeros((0, COARSE, COARSE)), float(np.log(share / (1 - share))))
    if not len(x):
        return model
    margin = np.full(len(x), model.base)

    def pull() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-margin))
        return y - p, p * (1 - p)

    bins = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(edges)]
    for _ in range(ROUNDS):
        for f, own in enumerate(bins):
            g, h = pull()
            size = len(edges[f]) + 1
            step = RATE * _tree(np.bincount(own, g, size), np.bincount(own, h, size))
            tables[f, :size] += step
            margin += step[own]
    small = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(coarse)]
    g, h = pull()

    def grid(a: int, b: int, v: np.ndarray) -> np.ndarray:
        return np.bincount(small[a] * COARSE + small[b], v, COARSE * COARSE).reshape(COARSE, COARSE)

    ranked = sorted(
        ((_quadrants(grid(a, b, g), grid(a, b, h))[0], a, b) for a in range(n_features) for b in range(a)),
        reverse=True,
    )
    model.pairs = [(a, b) for _, a, b in ranked[:PAIRS]]
    model.pair_tables = np.zeros((len(model.pairs), COARSE, COARSE))
    for _ in range(PAIR_ROUNDS):
        for k, (a, b) in enumerate(model.pairs):
            g, h = pull()
            step = RATE * _quadrants(grid(a, b, g), grid(a, b, h))[1]
            model.pair_tables[k] += step
            margin += step[small[a], small[b]]
    return model


def _feature_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        x = list(text_features(pdf["text"]))
        yield pd.DataFrame({"doc_id": pdf["doc_id"], "text_key": pdf["text_key"], "label": pdf["label"], "x": x})


def sampled(docs: DataFrame, labels: DataFrame, label: str, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, text_key, text, label) of the documents of ``sample`` labels at most, by a hash of their id."""
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    chosen = (
        known.select("doc_id", F.col(label).cast("double").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(sample)
    )
    # At most ``sample`` rows of two numbers.
    texts = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("text_key"), "text")
    return texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text_key", "text", "label")


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> AdditiveModel:
    """The model of at most ``sample`` rows. Rows that repeat a doc_id count towards that bound."""
    rows = sampled(docs, labels, label, sample).mapInPandas(
        _feature_rows, "doc_id bigint, text_key bigint, label double, x array<double>"
    )
    # An id may be repeated by any number of rows, so the bound is put on rows once more.
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "text_key", "label").limit(sample)
    # Some 20 numbers per sampled document; sorted, so that sums are added in one order.
    found = sorted((list(r["x"]), r["label"]) for r in rows.collect())
    x = np.array([f for f, _ in found]).reshape(-1, len(FEATURES))
    return fit(x, np.array([v for _, v in found]))


def scored(docs: DataFrame, model: AdditiveModel) -> DataFrame:
    """Per row of ``docs``: doc_id and score, 0 to 1.

    A null or empty text is scored as a text of no words; repeated rows score alike; an empty
    table gives no rows; other columns are ignored.
    """

    def run(batches):
        for pdf in batches:
            x = text_features(pdf["text"])
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "score": model.score(x)})

    return id_number(docs.select(id_text(), "text").mapInPandas(run, "doc_id string, score double"))
