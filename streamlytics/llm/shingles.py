"""Word shingles of whole texts as 64-bit hashes, for many texts at once."""

from __future__ import annotations

import numpy as np

SHINGLE = 5
#: Text hashed at a time; its arrays take some fifty times as much and stay with the worker.
_CHUNK_BYTES = 1 << 20

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random words."""
    return mix((np.arange(1, n + 1, dtype=_U) + _U(seed)) * _U(0x9E3779B97F4A7C15))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BYTE = constants(256, 1)
_STEP, _JOIN = 0x9E3779B97F4A7C15, _U(0xD6E8FEB86659FD93)
_BACK = pow(_STEP, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, dtype=_U)
    out[0] = 1
    return np.multiply.accumulate(out)


_cache: dict[str, np.ndarray] = {}


def _steps(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _cache or len(_cache["up"]) <= n:
        size = max(n, _CHUNK_BYTES)
        _cache.update(up=_powers(_STEP, size), down=_powers(_BACK, size))
    return _cache["up"], _cache["down"]


def word_hashes(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of ``parts``, and how many words each part has.

    A word's hash is the difference of two prefix sums over the joined bytes, so no word is
    cut out one by one.
    """
    data = _LOWER[np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)]
    up, down = _steps(len(data))
    blank = _BLANK[data]
    edge = np.flatnonzero(np.diff(blank, prepend=True))
    starts, ends = edge[::2], edge[1::2]
    sums = np.zeros(len(data) + 1, dtype=_U)
    np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U))
    bounds = np.cumsum([len(p) + 1 for p in parts])
    counts = np.diff(np.searchsorted(starts, bounds), prepend=0)
    return hashes, counts


def _of_words(words: np.ndarray, width: int) -> np.ndarray:
    n = len(words) - width + 1
    out = words[:n].copy()
    for k in range(1, width):
        out = out * _JOIN + words[k : k + n]
    return mix(out + _U(width))


def shingle_sets(texts, width: int = SHINGLE):
    """Per text, its sorted distinct shingle hashes, in order.

    Fewer words than ``width`` make one shingle of them all; no words (or None) make none.
    """
    batch: list[bytes] = []
    size = 0
    for text in texts:
        part = (text or "").encode("utf-8", "surrogatepass")
        batch.append(part)
        size += len(part)
        if size >= _CHUNK_BYTES:
            yield from _sets(batch, width)
            batch, size = [], 0
    if batch:
        yield from _sets(batch, width)


def _sets(parts: list[bytes], width: int):
    words, counts = word_hashes(parts)
    runs = _of_words(words, width) if len(words) >= width else words[:0]
    at = 0
    for n in counts.tolist():
        if n >= width:
            yield np.unique(runs[at : at + n - width + 1])
        else:
            yield _of_words(words[at : at + n], n) if n else words[:0]
        at += n
