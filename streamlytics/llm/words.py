"""Words as runs of letters and digits, hashed for many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from streamlytics.llm.shingles import _BYTE, _LOWER, _U, _steps, mix

#: Text hashed at a time; its arrays take some thirty times as much, in each Python worker.
BATCH_BYTES = 1 << 20

# Any byte of a character beyond ASCII counts as a letter.
_SPLITS = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])


def batched(texts) -> Iterator[tuple[int, list[bytes]]]:
    """The number of the first text, and the bytes, of pieces of bounded size."""
    batch, size, at = [], 0, 0
    for i, text in enumerate(texts):
        part = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""
        batch.append(part)
        size += len(part)
        if size >= BATCH_BYTES:
            yield at, batch
            batch, size, at = [], 0, i + 1
    if batch:
        yield at, batch


def word_places(parts: list[bytes], beginnings: tuple[int, ...] = ()):
    """Hash, length in bytes and text number of every word, and the words per text.

    With ``beginnings`` also, per width, the hash of the first ``width`` bytes of each longer word.
    """
    data = _LOWER[np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)]
    up, down = _steps(len(data))
    edge = np.flatnonzero(np.diff(_SPLITS[data], prepend=True))
    first, after = edge[::2], edge[1::2]
    sums = np.zeros(len(data) + 1, dtype=_U)
    np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
    bounds = np.cumsum([len(p) + 1 for p in parts])
    counts = np.diff(np.searchsorted(first, bounds), prepend=0)
    owner = np.repeat(np.arange(len(parts)), counts)

    def hashed(a, b, kind):
        return mix((sums[b] - sums[a]) * down[a] + (b - a).astype(_U) + _U(kind << 32))

    lengths = after - first
    begun = {}
    for width in beginnings:
        long = first[lengths > width]
        begun[width] = hashed(long, long + width, width)
    found = (hashed(first, after, 0), lengths, owner, counts)
    return (*found, begun) if beginnings else found
