"""Toxicity by a chain of linear classifiers.

A document is described by the words it holds and by its word beginnings, each once as present
and once as a share of its words. Which words and beginnings matter is counted over the labelled
documents: those whose share of toxic documents differs from the rest beyond chance.

Categories are predicted in order. Every later model also reads the earlier categories'
predictions; in training these are out-of-fold, from models that have not seen the document, so a
later model learns how far an earlier one can be trusted.

Training reads at most ``SAMPLE`` labelled documents, chosen by a hash of their id, and keeps at
most ``VOCABULARY`` terms. Scoring reads every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlytics.llm.common import written
from streamlytics.llm.words import batched, word_places

SAMPLE = 20_000
VOCABULARY = 4096
#: A term must be in this many labelled documents, and this far from chance (chi-square).
LEAST_DOCS, LEAST_CHI = 4, 12.0
PREFIXES = (5, 6, 7, 8)
FOLDS = 3
STEPS, PENALTY = 400, 2e-4
REJECT = 0.5
_U = np.uint64



def terms(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, term hash) of every word and word beginning, and the words per text."""
    found, lengths, owner, counts, begin = word_places(parts, PREFIXES)
    owners, hashes = [owner], [found]
    for width in PREFIXES:
        owners.append(owner[lengths > width])
        hashes.append(begin[width])
    return np.concatenate(owners), np.concatenate(hashes), counts


def described(texts, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Known terms: (text number, term number, share of the text's words), small numbers each."""
    rows, columns, shares = [], [], []
    for at, batch in batched(texts):
        owner, found, counts = terms(batch)
        if not len(vocabulary) or not len(found):
            continue
        place = np.minimum(np.searchsorted(vocabulary, found), len(vocabulary) - 1)
        known = vocabulary[place] == found
        pair, n = np.unique(owner[known] * len(vocabulary) + place[known], return_counts=True)
        row, column = pair // len(vocabulary), pair % len(vocabulary)
        share = np.minimum(1.0, 20.0 * n / np.maximum(counts[row], 1))
        rows.append((at + row).astype(np.int32))
        columns.append(column.astype(np.int32))
        shares.append(share.astype(np.float32))
    if not rows:
        return np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.float32)
    return np.concatenate(rows), np.concatenate(columns), np.concatenate(shares)


@dataclass
class Linear:
    """A logistic model over terms and a few dense features.

    ``weights`` has one for each term that is there, then one for each term's share.
    """

    weights: np.ndarray
    dense: np.ndarray
    base: float

    def predict(self, sparse, dense: np.ndarray) -> np.ndarray:
        row, term, share = sparse
        there, part = np.split(self.weights, 2)
        margin = np.bincount(row, there[term] + share * part[term], len(dense))
        return 1 / (1 + np.exp(-np.clip(margin + dense @ self.dense + self.base, -50, 50)))


def fit_linear(sparse, dense: np.ndarray, y: np.ndarray, width: int, use: np.ndarray) -> Linear:
    """Logistic regression on the rows ``use`` by gradient steps of adapted length."""
    row, term, share = sparse if use.all() else [v[use[sparse[0]]] for v in sparse]
    half = width // 2
    weight = use.astype(np.float64) / max(1, use.sum())
    model = Linear(np.zeros(width), np.zeros(dense.shape[1]), 0.0)
    seen = [np.full(width, 1e-12), np.full(dense.shape[1], 1e-12), 1e-12]
    for _ in range(STEPS):
        pull = (model.predict((row, term, share), dense) - y) * weight
        each = pull[row]
        terms_pull = [np.bincount(term, each, half), np.bincount(term, share * each, half)]
        grads = (
            np.concatenate(terms_pull) + PENALTY * model.weights,
            pull @ dense + PENALTY * model.dense,
            pull.sum(),
        )
        seen = [s + g * g for s, g in zip(seen, grads, strict=True)]
        steps = [0.3 * g / np.sqrt(s) for g, s in zip(grads, seen, strict=True)]
        model.weights = model.weights - steps[0]
        model.dense = model.dense - steps[1]
        model.base = model.base - float(steps[2])
    return model


@dataclass
class Chain:
    """One model per category; each reads the log-odds of the categories before it."""

    categories: list[str]
    vocabulary: np.ndarray
    models: list[Linear]

    def predict(self, texts) -> np.ndarray:
        sparse = described(texts, self.vocabulary)
        out = np.zeros((len(texts), len(self.models)))
        for k, model in enumerate(self.models):
            out[:, k] = model.predict(sparse, log_odds(out[:, :k]))
        return out


def log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-3, 1 - 1e-3)
    return np.log(p / (1 - p))


def fit_chain(sparse, y: np.ndarray, vocabulary: np.ndarray, categories: list[str]) -> Chain:
    """``y`` has a column per category. Without rows the chain predicts one half throughout."""
    n, width = len(y), 2 * len(vocabulary)
    fold = np.arange(n) % FOLDS
    outside = np.zeros((n, 0))
    models = []
    for k in range(len(categories)):
        dense = log_odds(outside)
        models.append(fit_linear(sparse, dense, y[:, k], width, np.ones(n, dtype=bool)))
        held = np.zeros(n)
        for f in range(FOLDS):
            part = fit_linear(sparse, dense, y[:, k], width, fold != f)
            held[fold == f] = part.predict(sparse, dense)[fold == f]
        outside = np.column_stack([outside, held])
    return Chain(categories, vocabulary, models)


def _term_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per Arrow batch and term: documents that hold it, and toxic ones among them."""
    for pdf in batches:
        toxic = pdf["any"].to_numpy(dtype=np.float64)
        for at, batch in batched(pdf["text"]):
            owner, found, _ = terms(batch)
            term, place = np.unique(found, return_inverse=True)
            pair = np.unique(owner.astype(np.int64) * max(1, len(term)) + place)
            own, col = pair // max(1, len(term)), pair % max(1, len(term))
            bad = np.bincount(col, toxic[at + own], len(term))
            yield pd.DataFrame(
                {"term": term.view(np.int64), "n": np.bincount(col, minlength=len(term)), "bad": bad.astype(np.int64)}
            )


def choose_terms(rows: DataFrame) -> np.ndarray:
    """The sorted hashes of terms that tell toxic documents from others."""
    total, toxic = rows.agg(F.count("*"), F.coalesce(F.sum("any"), F.lit(0.0))).first()
    if not total or not toxic or toxic == total:
        return np.zeros(0, dtype=_U)
    counts = rows.mapInPandas(_term_counts, "term bigint, n bigint, bad bigint")
    share = toxic / total
    counts = counts.groupBy("term").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    expected = F.col("n") * share
    # Chi-square of a two by two table of (holds the term, is toxic).
    chi = (F.col("bad") - expected) ** 2 / (expected * (1 - share) * (1 - F.col("n") / (total + 1)))
    best = (
        counts.where(F.col("n") >= LEAST_DOCS)
        .withColumn("chi", chi)
        .where(F.col("chi") >= LEAST_CHI)
        .orderBy(F.desc("chi"), "term")
        .limit(VOCABULARY)
    )
    return np.sort(np.array([r["term"] for r in best.select("term").collect()], dtype=np.int64).view(_U))


def sampled_labels(labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """At most ``sample`` labels, by a hash of the document's id."""
    known = labels.where(F.col("doc_id").isNotNull())
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)


def train(labelled: DataFrame, categories: list[str], sample: int = SAMPLE) -> Chain:
    """Fit the chain. ``labelled`` has doc_id, text and a 0/1 column per category, in chain order.

    It is a bounded sample (see ``sampled_labels``): a few numbers of each row reach the driver. Where
    rows that repeat a doc_id make it more than ``sample`` rows, rows equal in doc_id and text count
    once, and at most ``sample`` stay, by a hash of both.
    """
    rows = labelled.select("doc_id", "text", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in categories])
    rows = rows.withColumn("any", F.greatest(*categories) if len(categories) > 1 else F.col(categories[0]))
    rows = written(rows.withColumn("text_key", F.xxhash64("text")), "toxicity-sample")
    if rows.count() > sample:
        pair = ["doc_id", "text_key"]
        kept = rows.select(*pair).distinct().orderBy(F.xxhash64(*pair), *pair).limit(sample)
        same = F.col("r.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("r.text_key") == F.col("k.text_key"))
        # At most ``sample`` rows of two numbers.
        rows = rows.alias("r").join(F.broadcast(kept).alias("k"), same, "left_semi").dropDuplicates(pair)
        rows = written(rows, "toxicity-sample")
    vocabulary = choose_terms(rows)

    def collect(batches):
        for pdf in batches:
            row, column, value = described(pdf["text"], vocabulary)
            order = np.argsort(row, kind="stable")
            cuts = np.searchsorted(row[order], np.arange(1, len(pdf)))
            yield pd.DataFrame(
                {
                    "doc_id": pdf["doc_id"].astype("Int64"),
                    "y": pdf[categories].to_numpy().tolist(),
                    "columns": [c.tobytes() for c in np.split(column[order], cuts)],
                    "shares": [v.tobytes() for v in np.split(value[order], cuts)],
                }
            )

    # Packed, as lists of numbers would take many times the driver's memory.
    schema = "doc_id bigint, y array<double>, columns binary, shares binary"
    # A few known terms per sampled document.
    found = rows.mapInPandas(collect, schema).collect()
    found = sorted(found, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["columns"]))
    y = np.array([r["y"] for r in found]).reshape(-1, len(categories))
    lengths = [len(r["columns"]) // 4 for r in found]
    sparse = (
        np.repeat(np.arange(len(found), dtype=np.int32), lengths),
        np.frombuffer(b"".join(r["columns"] for r in found), dtype=np.int32),
        np.frombuffer(b"".join(r["shares"] for r in found), dtype=np.float32),
    )
    del found
    return fit_chain(sparse, y, vocabulary, categories)


def judged(docs: DataFrame, chain: Chain, reject: float = REJECT) -> DataFrame:
    """Per row of ``docs``: doc_id, ``p_<category>`` per category, and toxic (the last one's verdict).

    Whole texts are read. A null or empty text has no terms and is judged by the base rates alone;
    repeated rows are judged alike; a null doc_id stays null; an empty table gives no rows; other
    columns are ignored.
    """
    names = [f"p_{c}" for c in chain.categories]

    def run(batches):
        for batch in batches:
            p = chain.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, p.T), pa.array(p[:, -1] >= reject)],
                names=["doc_id", *names, "toxic"],
            )

    schema = ", ".join(["doc_id bigint", *[f"{n} double" for n in names], "toxic boolean"])
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, schema)


def without_toxic(docs: DataFrame, chain: Chain, reject: float = REJECT) -> DataFrame:
    """``docs`` without the documents that the chain rejects, all columns as they were."""

    def run(batches):
        for batch in batches:
            p = chain.predict(batch.column("text").to_pylist())
            yield batch.filter(pa.array(p[:, -1] < reject))

    return docs.mapInArrow(run, docs.schema)
