"""Periodic runs of words, by block convolution.

A run repeats its first ``period`` words at least three times.  At scale b, a power of two, the
words are cut into blocks of b.  A run with a period of b to 2b - 1 holds a whole block that
comes again one period later, so each block is searched in the words that follow it, at all
those distances at once: the sum of squared differences of word numbers is a
convolution, computed exactly by a number-theoretic transform, and is zero at a match.  The
distances found are seeds; they are extended word by word to the ends of the run.  Texts are
searched in buffers of many, and a block is only transformed if each of its words comes again
within 2b words, which no match can do without.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from quotelake.llm.arrow import sliced

MIN_LENGTH, MIN_PERIODS = 24, 3
FIRST_SCALE = 8  # serves all periods below 16: a run has 24 words at least
BUFFER = 1 << 18  # words searched together
# fixed values: a prime with roots of unity for all lengths up to 2**23, and a generator of its numbers
PRIME, GENERATOR = 998_244_353, 3
LONGEST = 1 << 22  # words of a block: its windows have the greatest length that can be transformed
ELEMENTS = 1 << 19  # numbers transformed at a time
_P = np.uint64(PRIME)
_roots: dict[tuple[int, bool], np.ndarray] = {}


def _powers(n: int, inverse: bool) -> np.ndarray:
    """The first n / 2 powers of a root of unity of order n, or of its inverse."""
    if (n, inverse) not in _roots:
        root = pow(GENERATOR, (PRIME - 1) // n, PRIME)
        root = pow(root, PRIME - 2, PRIME) if inverse else root
        out = np.ones(max(1, n // 2), np.uint64)
        done = 1
        while done < len(out):
            more = min(done, len(out) - done)
            out[done : done + more] = out[:more] * np.uint64(pow(root, done, PRIME)) % _P
            done += more
        _roots[n, inverse] = out
    return _roots[n, inverse]


def _forward(x: np.ndarray) -> np.ndarray:
    """The transform of each row, in bit-reversed order."""
    rows, n = x.shape
    size = n
    while size > 1:
        y = x.reshape(rows, n // size, 2, size // 2)
        a, b = y[:, :, 0], y[:, :, 1]
        x = np.stack(((a + b) % _P, (a + _P - b) * _powers(size, False) % _P), axis=2).reshape(rows, n)
        size //= 2
    return x


def _backward(x: np.ndarray) -> np.ndarray:
    """From bit-reversed order back, but for the factor n."""
    rows, n = x.shape
    size = 2
    while size <= n:
        y = x.reshape(rows, n // size, 2, size // 2)
        a, b = y[:, :, 0], y[:, :, 1] * _powers(size, True) % _P
        x = np.stack(((a + b) % _P, (a + _P - b) % _P), axis=2).reshape(rows, n)
        size *= 2
    return x


def squared_differences(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Modulo PRIME, the sums over i of (block[i] - window[lag + i])**2 for every lag from 0 to the block's length - 1.

    Rows are independent; a window is twice as long as a block.
    """
    b = blocks.shape[1]
    x = np.zeros(windows.shape, np.uint64)
    x[:, 0] = blocks[:, 0]
    x[:, : b : -1] = blocks[:, 1:]  # reversed around zero, so that the product is a correlation
    cross = _backward(_forward(x) * _forward(windows) % _P)[:, :b] * np.uint64(pow(2 * b, PRIME - 2, PRIME)) % _P
    squares = windows * windows % _P
    before = np.concatenate((np.zeros((len(windows), 1), np.uint64), np.cumsum(squares, axis=1)), axis=1)
    own = (blocks * blocks % _P).sum(axis=1) % _P
    moving = before[:, b : 2 * b] - before[:, :b]
    return (own[:, None] + moving + np.uint64(2) * (_P - cross)) % _P


def _seeds(words: np.ndarray, gap: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """(block start, distance) of zero-mismatch occurrences, at distances of b to 2b - 1, or from 1 at the first scale.

    ``gap`` is the distance from each word to the next equal one.
    """
    m = min(b, LONGEST)
    at = np.flatnonzero(gap[: len(words) // m * m].reshape(-1, m).max(axis=1) < 2 * b) * m
    starts, distances = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    step = max(1, ELEMENTS // (2 * m))
    padded = np.concatenate((words, np.arange(len(words), len(words) + 4 * b)))  # numbers of no word
    for some in (at[i : i + step] for i in range(0, len(at), step)):
        blocks = padded[some[:, None] + np.arange(m)].astype(np.uint64)
        for first in range(0 if b == FIRST_SCALE else b, 2 * b, m):
            windows = padded[some[:, None] + np.arange(first, first + 2 * m)].astype(np.uint64)
            row, lag = np.nonzero(squared_differences(blocks, windows) == 0)
            starts.append(some[row])
            distances.append(lag + first)
    start, distance = np.concatenate(starts), np.concatenate(distances)
    start, distance = start[distance > 0], distance[distance > 0]
    order = np.lexsort((start, distance))
    return start[order], distance[order]


def _agreement(words: np.ndarray, a: int, d: int, step: int) -> int:
    """How many words from ``a`` on, or down, equal those ``d`` later."""
    n, size = 0, 64
    while True:
        if step > 0:
            low, high = a + n, min(a + n + size, len(words) - d)
        else:
            low, high = max(0, a - n - size + 1), a - n + 1
        if high <= low:
            return n
        differ = words[low:high] != words[low + d : high + d]
        differ = differ if step > 0 else differ[::-1]
        if differ.any():
            return n + int(np.argmax(differ))
        n += high - low
        size *= 2


def find_runs(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence of numbers from 0 on, each below twice the sequence's length.

    A run has at least 24 words and three periods; its period is its smallest.  Sorted by
    start, then period.
    """
    if len(words) < MIN_LENGTH:
        return []
    order = np.argsort(words, kind="stable")
    gap = np.full(len(words), 2 * len(words), np.int64)
    same = words[order[1:]] == words[order[:-1]]
    gap[order[:-1][same]] = (order[1:] - order[:-1])[same]
    found: list[tuple[int, int, int]] = []
    b = FIRST_SCALE
    while b == FIRST_SCALE or 3 * b <= len(words):
        _extend(words, min(b, LONGEST), *_seeds(words, gap, b), found)
        b *= 2
    return sorted((s, e - s, p) for s, e, p in found)


def _extend(words: np.ndarray, size: int, start: np.ndarray, distance: np.ndarray, found: list[tuple[int, int, int]]) -> None:
    """Add the runs (start, end, period) that seeds lie in, of blocks of ``size`` words.  Shorter periods have been found before."""

    def beside(s, e, p, start, distance):
        """Of some seeds, those that are not in a run or in repeats of its period."""
        return ~((distance % p == 0) & (start >= s) & (start + distance + size <= e))

    for s, e, p in found:
        if not len(start):
            return
        left = beside(s, e, p, start, distance)
        start, distance = start[left], distance[left]
    while len(start):
        a, d = int(start[0]), int(distance[0])
        right = _agreement(words, a, d, 1)
        low, high = a - _agreement(words, a - 1, d, -1), a + right
        if right >= size and high - low + d >= max(MIN_LENGTH, MIN_PERIODS * d):
            found.append((low, high + d, d))
            left = beside(low, high + d, d, start, distance)
        else:  # too short, or equal only modulo PRIME: the other seeds of this stretch go with it
            left = (distance != d) | (start < low) | (start >= max(high, a + 1))
        start, distance = start[left], distance[left]


def _buffers(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """(doc_id, words) of some texts, about BUFFER words or one text."""
    waiting, size = [], 0
    for batch in sliced(batches):
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            words = text.split() if text else []  # of bytes: at the space and U+0009 to U+000D
            if waiting and size + len(words) > BUFFER:
                yield waiting
                waiting, size = [], 0
            waiting.append((doc, words))
            size += len(words) + 1
    if waiting:
        yield waiting


def runs_of_texts(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each of some sequences of words, searched as one sequence with a number of its own between each two."""
    numbers: dict[bytes, int] = {}
    joined: list[int] = []
    first = []
    for i, words in enumerate(texts):
        first.append(len(joined))
        joined += [numbers.setdefault(w, len(numbers)) for w in words]
        joined.append(-1 - i)
    sequence = np.array(joined, np.int64)
    sequence = np.where(sequence < 0, len(numbers) - 1 - sequence, sequence)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, length, period in find_runs(sequence):
        i = int(np.searchsorted(first, start, "right")) - 1
        out[i].append((start - first[i], length, period))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    step = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        step[start + period] += 1
        step[start + length] -= 1
    return [w for w, n in zip(words, np.cumsum(step[:-1]).tolist()) if not n]


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, runs, collapsed) for every row of ``docs`` (doc_id, text).

    ``runs`` holds (start, length, period) in words, sorted by start, then period;
    ``collapsed`` is the text's words without those that a run holds after its first period,
    joined by one space.  Null and empty texts have no words and no runs.  Repeated rows come
    back as often as they occur, other columns are ignored.  One map, no shuffle: a task
    holds the words of one text, or of some short ones.
    """
    doc_id = docs.schema["doc_id"].dataType
    kind, row = to_arrow_type(doc_id), pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])

    def search(batches):
        for some in _buffers(batches):
            found = runs_of_texts([words for _, words in some])
            kept = [b" ".join(collapse(words, runs)) for (_, words), runs in zip(some, found)]
            flat = np.array([r for runs in found for r in runs], np.int64).reshape(-1, 3)
            ends = np.concatenate(([0], np.cumsum([len(r) for r in found]))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(c) for c in flat.T], fields=list(row)))
            yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in some], kind), lists, pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "runs", "collapsed"])

    schema = f"doc_id {doc_id.simpleString()}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return docs.select("doc_id", "text").mapInArrow(search, schema)
