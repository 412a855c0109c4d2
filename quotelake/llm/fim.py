"""Fill-in-the-middle training texts: prefix, middle and suffix, reordered around three marks.

Cuts are drawn in code points while texts are UTF-8.  A text's index holds only its
exceptions: the code-point positions of characters of more than one byte, and the bytes
they have in excess.  A cut is turned into a byte offset by one binary search among them, and
a text without exceptions needs none: its offsets are its code points.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.llm.arrow import ROWS

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
KEPT_PERCENT = 90  # of a hundred texts, so many are reordered
SPM_PERCENT = 20  # of a hundred reordered texts, so many start with their suffix


@dataclass
class Index:
    """Code points ``at`` that have more than one byte, ascending, and the excess bytes before each of them and in all."""

    size: int  # bytes of the text
    at: np.ndarray
    excess: np.ndarray  # one longer than ``at``

    @property
    def points(self) -> int:
        return self.size - int(self.excess[-1])

    def to_bytes(self, points: np.ndarray) -> np.ndarray:
        """The byte offsets of cuts in code points."""
        return points + self.excess[np.searchsorted(self.at, points)] if len(self.at) else points

    def to_points(self, offsets: np.ndarray) -> np.ndarray:
        """The code points of cuts in bytes; an offset inside a character belongs to its end."""
        if not len(self.at):
            return offsets
        ends = self.at + 1 + self.excess[1:]
        k = np.searchsorted(ends, offsets)
        low = offsets - self.excess[k]
        inside = (k < len(ends)) & (low > self.at[np.minimum(k, len(ends) - 1)])
        return np.where(inside, self.at[np.minimum(k, len(ends) - 1)] + 1, low)


def indexed(data: np.ndarray) -> Index:
    """The index of a text, of its UTF-8 bytes."""
    lead = np.flatnonzero(data >= 0xC0)
    more = 1 + (data[lead] >= 0xE0) + (data[lead] >= 0xF0)
    excess = np.concatenate(([0], np.cumsum(more, dtype=np.int64)))
    return Index(len(data), lead - excess[:-1], excess)


def _draws(doc_id: Column, seed: int) -> list[Column]:
    """The first four groups of eight digits of the hash of seed and id, as numbers; a null id counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint").alias(f"h{i + 1}") for i in range(4)]


def _bytes(texts: pa.StringArray) -> Iterator[np.ndarray]:
    """The bytes of each text, without a copy; a null is empty."""
    if not len(texts):
        return
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    cut = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    empty = data[:0]
    null = texts.is_null().to_numpy(zero_copy_only=False)
    for i in range(len(texts)):
        yield empty if null[i] else data[cut[i] : cut[i + 1]]


def rearrange(data: np.ndarray, h: tuple[int, int, int, int], kept: int = KEPT_PERCENT, spm: int = SPM_PERCENT) -> tuple[int, str, int | None, int | None, bytes]:
    """(code points, form, code points of prefix and of middle, output) of one text."""
    raw, index = data.tobytes(), indexed(data)
    n = index.points
    if not raw or h[2] % 100 >= kept or any(m in raw for m in MARKS):
        return n, "plain", None, None, raw
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = index.to_bytes(np.array([low, high])).tolist()
    prefix, middle, suffix = raw[:a], raw[a:b], raw[b:]
    if h[3] % 100 < spm:
        return n, "spm", low, high - low, SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    return n, "psm", low, high - low, PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle


def restore(output: bytes, form: str) -> bytes:
    """The text that an output was made of.  Each mark is in it once: no text with one is reordered, and no mark
    can lie across the edge of another, as each begins with the only ``<`` in it."""
    if form == "plain":
        return output
    first, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    a, b, c = len(first), output.index(second), output.index(MIDDLE)
    one, two, middle = output[a:b], output[b + len(second) : c], output[c + len(MIDDLE) :]
    return one + middle + two if form == "psm" else two + middle + one


def transformed(docs: DataFrame, seed: int = 1, kept: int = KEPT_PERCENT, spm: int = SPM_PERCENT) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for every row of ``docs`` (doc_id, text).

    ``n`` and the two lengths are code points; the lengths are null if the form is plain.
    Empty texts and texts with a mark in them stay plain; a null text is empty.  Cuts follow
    from ``seed`` and doc_id alone, so equal rows give equal rows; a null doc_id counts as an
    empty one.  Other columns are ignored.  One map, no shuffle.
    """

    @F.arrow_udf("n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")
    def of(texts: pa.Array, h1: pa.Array, h2: pa.Array, h3: pa.Array, h4: pa.Array) -> pa.Array:
        rows = [rearrange(data, h, kept, spm) for data, *h in zip(_bytes(texts), *(x.to_pylist() for x in (h1, h2, h3, h4)))]
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
        columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
        columns[4] = columns[4].cast(pa.string())
        return pa.StructArray.from_arrays(columns, ["n", "form", "prefix_chars", "middle_chars", "output"])

    drawn = docs.select("doc_id", "text", *_draws(F.col("doc_id"), seed))
    return drawn.select("doc_id", of("text", "h1", "h2", "h3", "h4").alias("r")).select("doc_id", "r.*")


def restored(output: Column, form: Column) -> Column:
    """The original text of each output."""

    @F.arrow_udf("string")
    def of(outputs: pa.Array, forms: pa.Array) -> pa.Array:
        parts = []
        for at in range(0, len(outputs), ROWS):
            rows = zip(_bytes(outputs.slice(at, ROWS)), forms.slice(at, ROWS).to_pylist())
            parts += [restore(o.tobytes(), f) for o, f in rows]
        return pa.array(parts, pa.binary()).cast(pa.string())

    return of(output, form)
