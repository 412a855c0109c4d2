"""Words of a text as one byte buffer, and exact comparison of runs of words.

A word is a run of characters other than space and U+0009 to U+000D.  Texts become their
words joined by one space, so a run of words is one slice of bytes, and numpy can hash all
windows of a buffer at once.  A hash only brings candidates together: windows count as
equal when their bytes are equal.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_CHUNK = 1 << 20  # bytes hashed at a time; bounds the scratch arrays
_tables: dict[str, np.ndarray] = {}


def pack(text: str | None) -> bytes:
    """The words of a text, joined by one space; null has none."""
    return b" ".join(text.encode().split()) if text else b""


def spans(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offset of each word of a packed text."""
    if not packed:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    gaps = np.flatnonzero(np.frombuffer(packed, np.uint8) == 32)
    return np.concatenate(([0], gaps + 1)), np.concatenate((gaps, [len(packed)]))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the information of 64-bit values over all of their bits."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _tables or len(_tables["power"]) < n:
        size = max(n, 1 << 16)
        for name, base in (("power", _BASE), ("inverse", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _tables[name] = np.cumprod(steps)
    return _tables["power"][:n], _tables["inverse"][:n]


def hashes(packed: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each slice; ``starts`` and ``ends`` ascend."""
    out = np.empty(len(starts), np.uint64)
    data = np.frombuffer(packed, np.uint8)
    first = 0
    while first < len(starts):
        low = int(starts[first])
        last = max(first + 1, int(np.searchsorted(ends, low + _CHUNK, "right")))
        high = int(ends[last - 1])
        power, inverse = _powers(high - low + 1)
        total = np.zeros(high - low + 1, np.uint64)
        np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1)) * power[:-1], out=total[1:])
        a, b = starts[first:last] - low, ends[first:last] - low
        out[first:last] = (total[b] - total[a]) * inverse[a]
        first = last
    return mix(out)


def windows(packed: bytes, starts: np.ndarray, ends: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of ``k`` words, in order of their first word."""
    if len(starts) < k:
        return np.zeros(0, np.uint64)
    return hashes(packed, starts[: len(starts) - k + 1], ends[k - 1 :])


def equal_groups(packed: bytes, starts: np.ndarray, ends: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort slices so that equal ones stand together.

    Returns the order and, for each place in it, the number of its group.  Equal hashes
    are confirmed byte by byte; a run of equal hashes with different bytes is sorted by
    the bytes themselves.
    """
    order = np.argsort(h, kind="stable")
    if not len(order):
        return order, order
    ordered = h[order]
    new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    pairs = np.flatnonzero(~new)
    if len(pairs):
        a, b = order[pairs - 1], order[pairs]
        differ = [
            packed[i:j] != packed[k:m]
            for i, j, k, m in zip(starts[a].tolist(), ends[a].tolist(), starts[b].tolist(), ends[b].tolist())
        ]
        if any(differ):
            run = np.cumsum(new)
            for r in np.unique(run[pairs[np.array(differ)]]).tolist():
                at = np.flatnonzero(run == r)
                texts = sorted((packed[int(starts[i]) : int(ends[i])], int(i)) for i in order[at])
                order[at] = [i for _, i in texts]
                new[at[1:]] = [x[0] != y[0] for x, y in zip(texts, texts[1:])]
    return order, np.cumsum(new) - 1


def covered(first: np.ndarray, k: int, n: int) -> np.ndarray:
    """Which of ``n`` words lie in a window of ``k`` words that starts at one of ``first``."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, first, 1)
    np.add.at(step, first + k, -1)
    return np.cumsum(step[:n]) > 0
