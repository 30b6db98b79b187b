"""Document fingerprints from improbable features.

Every window of ``WINDOW`` bytes has an entropy; windows whose entropy is rare in prose rank as
improbable. A window is selected if it is the most improbable in enough of the neighbourhoods of
``NEIGHBOURS`` windows around it, so selection is local and survives edits elsewhere. Selected windows are hashed
into a chain of Bloom filters of ``FILTER_BITS`` bits with at most ``FILTER_FEATURES`` features
each. Two fingerprints compare by the bits their filters share beyond what chance gives. Texts
under ``WINDOW`` bytes have no such window: all their windows of ``NARROW`` bytes are features.

Entropies come from running sums over all texts of a batch at once: a window differs from the one
before by a byte gained and a byte lost, and how often a byte occurs among its neighbours is
counted by comparing the text with itself shifted.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlytics.llm.common import id_number, id_text, written
from streamlytics.llm.shingles import constants, mix

WINDOW = 64
#: Window of texts under WINDOW bytes.
NARROW = 8
#: A window must be the most improbable one of so many neighbourhoods of so many windows.
NEIGHBOURS, POPULAR = 32, 8
FILTER_BITS = 2048
FILTER_FEATURES = 160
HASHES = 5
#: Filters with fewer features say little and are left out of a comparison with fuller ones.
FEW_FEATURES = 16
#: Documents per range partition.
PARTITION_DOCS = 2000

_SCALE = 1 << 20
_CHUNK = 1 << 16
_BATCH_BYTES = 4 << 20
_U = np.uint64
_SALT = constants(WINDOW // 8, 21) | _U(1)

_n = np.arange(WINDOW + 1, dtype=np.float64)
_NLOGN = np.round(_SCALE * _n * np.log2(np.maximum(_n, 1))).astype(np.int64)
#: What a window's sum changes by when one more of a byte that it has k times comes in.
_GAIN = np.diff(_NLOGN, append=_NLOGN[-1])
_MOST = int(_NLOGN[WINDOW])
#: Entropy per window in thousandths of the largest possible, where prose has most windows.
_USUAL = 690


def _counts(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per byte, how often it occurs among the WINDOW - 1 bytes before it, and after it."""
    n = len(data)
    before, after = np.zeros(n, dtype=np.uint8), np.zeros(n, dtype=np.uint8)
    for start in range(0, n, _CHUNK):
        # A chunk counts the pairs whose first byte it holds.
        stop = min(n, start + _CHUNK)
        for lag in range(1, WINDOW):
            end = min(stop, n - lag)
            if end <= start:
                break
            same = (data[start:end] == data[start + lag : end + lag]).view(np.uint8)
            after[start:end] += same
            before[start + lag : end + lag] += same
    return before, after


def entropies(data: np.ndarray) -> np.ndarray:
    """Entropy of every window, in thousandths of the largest possible."""
    n = len(data) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    before, after = _counts(data)
    gained = np.cumsum(_GAIN[before])
    lost = np.concatenate(([0], np.cumsum(_GAIN[after[: n - 1]])))
    sums = gained[WINDOW - 1 :] - lost
    return (1000 * (_MOST - sums)) // _MOST


def _ranks(entropy: np.ndarray) -> np.ndarray:
    """0 is the most improbable. Windows of nearly one byte say nothing and rank last."""
    rarity = 1000 - np.abs(entropy - _USUAL)
    return np.where(entropy < 100, 2000, rarity)


def selected(ranks: np.ndarray) -> np.ndarray:
    """Windows that are the first of the least rank in at least POPULAR neighbourhoods.

    Where none is, or only windows of nearly one byte are, the one that wins most often.
    """
    n = len(ranks)
    if not n:
        return np.zeros(0, dtype=np.int64)
    key = (ranks << 40) | np.arange(n)
    span = 1
    least = key
    while span < NEIGHBOURS and len(least) > span:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    winners = least & ((1 << 40) - 1)
    edges = np.flatnonzero(np.diff(winners, prepend=-1))
    wins = np.diff(edges, append=len(winners))
    # A text shorter than two neighbourhoods has few of them.
    need = min(POPULAR, len(winners))
    firsts = winners[edges]
    telling = ranks[firsts] < 2000
    chosen = firsts[(wins >= need) & telling]
    if len(chosen):
        return chosen
    return firsts[[np.argmax(np.where(telling, wins + len(winners), wins))]]


def _feature_bits(data: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """HASHES bit positions per selected window."""
    words = data[at[:, None] + np.arange(width)].view(_U)
    h = mix((words * _SALT[: width // 8]).sum(axis=1, dtype=_U))
    return np.stack([(h >> _U(11 * k)) & _U(FILTER_BITS - 1) for k in range(HASHES)], axis=1)


def fingerprint(data: np.ndarray, at: np.ndarray, width: int = WINDOW) -> str:
    """A count and a filter per FILTER_FEATURES features, as base64; '' without features."""
    if not len(at):
        return ""
    bits = _feature_bits(data, at, width).astype(np.int64)
    chain = np.arange(len(at)) // FILTER_FEATURES
    filters = np.zeros((chain[-1] + 1, FILTER_BITS), dtype=np.uint8)
    filters[np.repeat(chain, HASHES), bits.ravel()] = 1
    counts = np.bincount(chain).astype(np.uint8)
    packed = np.packbits(filters, axis=1)
    return base64.b64encode(np.hstack([counts[:, None], packed]).tobytes()).decode()


def fingerprints(parts: list[bytes]) -> list[str]:
    """Fingerprints of many texts, worked out over the joined bytes."""
    out = []
    batch, size = [], 0
    for part in [*parts, None]:
        if part is None or (batch and size + len(part) > _BATCH_BYTES):
            data = np.frombuffer(b"".join(batch), dtype=np.uint8)
            ranks = _ranks(entropies(data))
            at = 0
            for p in batch:
                # Windows over a border are no text's, so each text takes its own only.
                if len(p) < WINDOW:
                    narrow = np.arange(max(0, len(p) - NARROW + 1))
                    out.append(fingerprint(data[at : at + len(p)], narrow, NARROW))
                else:
                    own = ranks[at : at + len(p) - WINDOW + 1]
                    out.append(fingerprint(data[at : at + len(p)], selected(own)))
                at += len(p)
            batch, size = [], 0
        if part is not None:
            batch.append(part)
            size += len(part)
    return out


def _unpacked(print_: str) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(base64.b64decode(print_), dtype=np.uint8).reshape(-1, 1 + FILTER_BITS // 8)
    return raw[:, 0].astype(np.int64), raw[:, 1:]


def likeness(a: str, b: str) -> float:
    """0 to 1: per filter of the smaller print its best normalised overlap, averaged by features.

    Equal prints are fully alike, two empty ones too; an empty one is unlike any other. Prints of
    texts under WINDOW bytes have other features than those of longer ones, see ``nearness``.
    """
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    (n_a, f_a), (n_b, f_b) = sorted((_unpacked(a), _unpacked(b)), key=lambda x: x[0].sum())
    if (n_a >= FEW_FEATURES).any() and (n_b >= FEW_FEATURES).any():
        f_a, n_a = f_a[n_a >= FEW_FEATURES], n_a[n_a >= FEW_FEATURES]
        f_b = f_b[n_b >= FEW_FEATURES]
    bits_a, bits_b = (np.bitwise_count(f).sum(axis=1, dtype=np.int64) for f in (f_a, f_b))
    total = 0.0
    for k, own in enumerate(f_a):
        shared = np.bitwise_count(f_b & own).sum(axis=1, dtype=np.int64)
        chance = bits_a[k] * bits_b / FILTER_BITS
        most = np.minimum(bits_a[k], bits_b)
        best = np.max(np.clip((shared - chance) / np.maximum(most - chance, 1e-9), 0, 1))
        total += float(best) * n_a[k]
    return total / float(n_a.sum())


def _narrow_windows(raw: bytes) -> np.ndarray:
    views = np.lib.stride_tricks.sliding_window_view(np.frombuffer(raw, dtype=np.uint8), NARROW)
    return np.unique(np.ascontiguousarray(views).view(_U))


def nearness(a: bytes, b: bytes, print_a: str, print_b: str) -> float:
    """``likeness`` of two texts' prints, or what stands for it where these cannot be compared.

    Texts of which one has less than a window: the share of the narrow windows of the shorter one
    that the other one holds. Texts under NARROW bytes are fully alike if equal, else not at all.
    """
    if a == b:
        return 1.0
    if min(len(a), len(b)) < NARROW:
        return 0.0
    if (len(a) < WINDOW) == (len(b) < WINDOW):
        return likeness(print_a, print_b)
    few, many = (_narrow_windows(t) for t in sorted((a, b), key=len))
    return float(np.isin(few, many).mean())


def _edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_ROW = """doc_id string, n_chars bigint, edited_sha256 string, fingerprint string,
edited_fingerprint string, near_edited double, near_next double, part int, place string,
text string"""


def _rows(ids, texts: list[str], prints: list[str], part: int) -> pd.DataFrame:
    """Rows of all documents but the last, which is the next of the one before only."""
    edited = [_edited(t, n) for t, n in zip(texts, texts[1:], strict=False)]
    own = [t.encode("utf-8", "surrogatepass") for t in texts]
    raw = [e.encode("utf-8", "surrogatepass") for e in edited]
    edited_prints = fingerprints(raw)
    n = len(edited)
    return pd.DataFrame(
        {
            "doc_id": ids[:n],
            "n_chars": [len(t) for t in texts[:n]],
            "edited_sha256": [hashlib.sha256(r).hexdigest() for r in raw],
            "fingerprint": prints[:n],
            "edited_fingerprint": edited_prints,
            "near_edited": [nearness(*x) for x in zip(own, raw, prints, edited_prints, strict=False)],
            "near_next": [nearness(*x) for x in zip(own, own[1:], prints, prints[1:], strict=False)],
            "part": [part] * n,
            "place": [None] * n,
            "text": [None] * n,
        }
    )


def _border(doc_id, text: str, print_: str, part: int, place: str) -> pd.DataFrame:
    row = {"doc_id": [doc_id], "n_chars": [len(text)], "fingerprint": [print_]}
    rest = {"edited_sha256": None, "edited_fingerprint": None, "near_edited": None, "near_next": None}
    return pd.DataFrame({**row, **rest, "part": [part], "place": [place], "text": [text]})


_ORDER = [c.split()[0] for c in _ROW.split(",")]


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of a sorted partition; its first and last documents also go out with their texts."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    held = None
    for pdf in batches:
        texts = [t if isinstance(t, str) else "" for t in pdf["text"]]
        ids = list(pdf["doc_id"])
        at = 0
        while at < len(texts):
            # Bounded pieces: a few long texts do not pile up.
            size, stop = 0, at
            while stop < len(texts) and (stop == at or size < _BATCH_BYTES):
                size += len(texts[stop])
                stop += 1
            prints = fingerprints([t.encode("utf-8", "surrogatepass") for t in texts[at:stop]])
            if held is None:
                yield _border(ids[at], texts[at], prints[0], part, "first")[_ORDER]
                lead = ([], [], [])
            else:
                lead = ([held[0]], [held[1]], [held[2]])
            now = (lead[0] + ids[at:stop], lead[1] + texts[at:stop], lead[2] + prints)
            if len(now[0]) > 1:
                yield _rows(*now, part)[_ORDER]
            held = (now[0][-1], now[1][-1], now[2][-1])
            at = stop
    if held is not None:
        yield _border(*held, part, "last")[_ORDER]


def _join_borders(pdf: pd.DataFrame) -> pd.DataFrame:
    """The last document of a part with the first of the next part."""
    first, last = pdf[pdf["place"] == "first"], pdf[pdf["place"] == "last"]
    if not len(last):
        return pdf.iloc[:0]
    a, b = last.iloc[0], first.iloc[0]
    out = _rows([a.doc_id, None], [a.text, b.text],
                [a.fingerprint, b.fingerprint], int(a.part))
    return out[_ORDER]


def fingerprinted(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.

    The edited text is the text whose last floor(n_chars / 2) code points are replaced by the
    first as many of the next document's, in order of doc_id (null first), then text hash; after
    the last comes the first. Defined cases: a null text is empty; a text under NARROW bytes
    has the fingerprint '' and is fully alike equal texts only; equal texts have equal fingerprints;
    rows that repeat a doc_id follow each other; a single document is its own next; an empty table
    gives no rows; other columns are ignored.
    """
    width = max(1, -(-docs.count() // PARTITION_DOCS))
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("key"), F.rand(1).alias("salt"))
    # The salt spreads rows that repeat one document.
    spread = rows.repartitionByRange(width, "doc_id", "key", "salt")
    ordered = spread.sortWithinPartitions("doc_id", "key").select(id_text(), "text")
    walked = written(ordered.mapInPandas(_walk, _ROW), "rare-features")
    borders = walked.where("place IS NOT NULL")
    # One row per partition: which non-empty part follows which.
    parts = sorted(r[0] for r in borders.where("place = 'first'").select("part").collect())
    follows = dict(zip(parts, parts[1:] + parts[:1], strict=True))
    done = walked.where("place IS NULL")
    if parts:
        before = {after: part for part, after in follows.items()}
        chain = docs.sparkSession.createDataFrame(list(before.items()), "part int, before int")
        owner = F.when(F.col("place") == "first", F.col("before")).otherwise(F.col("part"))
        ends = borders.join(chain, "part").withColumn("owner", owner)
        ends = ends.groupBy("owner").applyInPandas(lambda pdf: _join_borders(pdf), _ROW)
        done = done.union(ends)
    return id_number(done.drop("part", "place", "text"))
