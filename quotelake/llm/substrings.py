"""Removal of repeated word windows, by super-k-mer partitioning.

A window of k words is named by its minimiser, the least of the ranks of the short word
groups in it.  Consecutive windows of a document with one minimiser travel as one packed
string to the minimiser's bucket, so equal windows of all documents meet there; sorting
brings them together and the bytes decide.  Two things keep buckets even: a window that
a document with a smaller id has in the same block of the scan is settled there and does not travel, and
word groups that make up a large share of the corpus get the last ranks, so that they
name only windows that hold nothing rarer.  A bucket that is too large all the same is
dealt out once more, by whole windows.

Packed strings overlap: with the ids they carry, they take about four times the text.  So
the texts are scanned more than once, each time for a part of the buckets, and the
strings of one part are gone before the next are packed.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.llm.arrow import ROWS, sliced
from quotelake.llm.scratch import materialised
from quotelake.llm.words import equal_groups, hashes, mix, pack, spans, windows
from quotelake.session import settings

GRAM = 3  # words that make up a minimiser
BLOCK = 4 << 20  # bytes of words handled at a time
PACKED = 4  # times the text: packed strings and the ids they carry
ROUND = 64 << 20  # bytes of text of which all buckets are packed at once
_LAST = np.uint64(1 << 63)
_NO_ID = np.iinfo(np.int64).max  # rows without id come after all others


@dataclass
class _Block:
    """Words of several documents in one buffer; ``piece`` numbers the document of each word."""

    packed: bytes
    starts: np.ndarray
    ends: np.ndarray
    piece: np.ndarray
    doc: np.ndarray  # of each piece
    text_hash: np.ndarray
    offset: np.ndarray  # the piece's first word in its document

    def place(self, word: np.ndarray) -> np.ndarray:
        """The position of words in their documents."""
        first = np.searchsorted(self.piece, np.arange(len(self.doc)))
        return word - first[self.piece[word]] + self.offset[self.piece[word]]


def _pieces(batches: Iterator[pa.RecordBatch], k: int):
    """(doc, text hash, first word, words) of texts; a long text comes in pieces that overlap by k - 1 words."""
    for batch in sliced(batches):
        for doc, text_hash, text in zip(*(c.to_pylist() for c in batch.columns)):
            packed = pack(text)
            doc = _NO_ID if doc is None else doc
            if len(packed) <= BLOCK:
                yield doc, text_hash, 0, packed
                continue
            starts, ends = spans(packed)
            at = 0
            while True:
                to = max(at + 2 * k, int(np.searchsorted(ends, starts[at] + BLOCK, "right")))
                to = min(to, len(starts))
                yield doc, text_hash, at, packed[int(starts[at]) : int(ends[to - 1])]
                if to == len(starts):
                    break
                at = to - k + 1


def _join(pieces) -> _Block:
    packed = b" ".join(p[3] for p in pieces)
    starts, ends = spans(packed)
    counts = [p[3].count(b" ") + 1 for p in pieces]
    column = lambda i: np.array([p[i] for p in pieces], np.int64)
    return _Block(packed, starts, ends, np.repeat(np.arange(len(pieces)), counts), column(0), column(1), column(2))


def _blocks(batches: Iterator[pa.RecordBatch], k: int, least: int) -> Iterator[_Block]:
    """Blocks of the texts that have at least ``least`` words."""
    waiting, size = [], 0
    for piece in _pieces(batches, k):
        if piece[3].count(b" ") + 1 < least or not piece[3]:
            continue
        if waiting and size + len(piece[3]) > BLOCK:
            yield _join(waiting)
            waiting, size = [], 0
        waiting.append(piece)
        size += len(piece[3]) + 1
    if waiting:
        yield _join(waiting)


def _frequent(batches: Iterator[pa.RecordBatch], share: float) -> Iterator[pa.RecordBatch]:
    """(gram, n): word groups with at least a quarter of the share in their block; null has the words and bytes of all."""
    words = size = 0
    for b in _blocks(batches, GRAM, GRAM):
        words, size = words + len(b.starts), size + len(b.packed)
        grams, n = np.unique(windows(b.packed, b.starts, b.ends, GRAM), return_counts=True)
        often = n >= max(2, share / 4 * len(b.starts))
        yield pa.RecordBatch.from_arrays([pa.array(grams[often].view(np.int64)), pa.array(n[often].astype(np.int64)), pa.nulls(int(often.sum()), pa.int64())], ["gram", "n", "bytes"])
    yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([words], pa.int64()), pa.array([size], pa.int64())], ["gram", "n", "bytes"])


def _ranges(flags: np.ndarray, at: np.ndarray, to: np.ndarray, doc: np.ndarray, text_hash: np.ndarray) -> list[tuple]:
    """Rows (doc, text hash, packed first and last word) of documents with a flagged window."""
    rows = np.flatnonzero(flags)
    if not len(rows):
        return []
    rows = rows[np.lexsort((at[rows], text_hash[rows], doc[rows]))]
    d, h, a, z = doc[rows], text_hash[rows], at[rows], to[rows]
    same = (d[1:] == d[:-1]) & (h[1:] == h[:-1])
    new = np.concatenate(([True], ~same | (a[1:] > z[:-1])))  # windows of one length: ends ascend with starts
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:] - 1, [len(rows) - 1]))
    pair = np.stack((a[first], z[last]), axis=1)
    d, h = d[first], h[first]
    cut = np.concatenate(([0], np.flatnonzero((d[1:] != d[:-1]) | (h[1:] != h[:-1])) + 1, [len(d)])).tolist()
    return [(int(d[i]), int(h[i]), pair[i:j].astype("<i8").tobytes()) for i, j in zip(cut, cut[1:])]


_ROW = pa.schema([("bucket", pa.int32()), ("blob", pa.binary()), ("doc", pa.int64()), ("text_hash", pa.int64()), ("found", pa.binary())])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ROW)], schema=_ROW)


def _repeats(b: _Block, at: np.ndarray, k: int) -> np.ndarray:
    """Whether each window ``at`` is also in a document with a smaller id in the block."""
    starts, ends = b.starts[at], b.ends[at + k - 1]
    order, group = equal_groups(b.packed, starts, ends, hashes(b.packed, starts, ends))
    doc = b.doc[b.piece[at]][order]
    out = np.zeros(len(at), bool)
    if len(at):
        least = np.minimum.reduceat(doc, np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))))
        out[order] = doc > least[group]
    return out


def _scatter(batches: Iterator[pa.RecordBatch], k: int, frequent: np.ndarray, buckets: int, turn: int = 0, rounds: int = 1) -> Iterator[pa.RecordBatch]:
    """Super-k-mers of this turn's buckets, packed by bucket, and the ranges of theirs that a block can settle itself."""
    squeeze = zstandard.ZstdCompressor(level=1)
    for b in _blocks(batches, k, k):
        n = len(b.starts) - k + 1
        at = np.flatnonzero(b.piece[:n] == b.piece[k - 1 :])
        rank = windows(b.packed, b.starts, b.ends, GRAM) >> np.uint64(1)
        if len(frequent):
            near = np.minimum(np.searchsorted(frequent, rank), len(frequent) - 1)
            rank = np.where(frequent[near] == rank, rank | _LAST, rank)
        least, width = rank, 1
        while width < k - GRAM + 1:  # the minimum over a window, by doubling
            step = min(width, k - GRAM + 1 - width)
            least = np.minimum(least[: len(least) - step], least[step:])
            width += step
        dealt = mix(least[at])
        at, dealt = (x[dealt % np.uint64(rounds) == turn] for x in (at, dealt))
        settled = _repeats(b, at, k)
        word = b.place(at)
        rows = [(int(d & 0x7FFFFFFF) % buckets, None, d, h, f) for d, h, f in _ranges(settled, word, word + k, b.doc[b.piece[at]], b.text_hash[b.piece[at]])]
        at, word, dealt = at[~settled], word[~settled], dealt[~settled]
        if len(at):
            new = np.concatenate(([True], (at[1:] != at[:-1] + 1) | (least[at[1:]] != least[at[:-1]])))
            first = np.flatnonzero(new)
            last = np.concatenate((first[1:] - 1, [len(at) - 1]))
            bucket = (dealt[first] // np.uint64(rounds) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            first, last, bucket = first[order], last[order], bucket[order]
            low, high = b.starts[at[first]], b.ends[at[last] + k - 1]
            piece = b.piece[at[first]]
            columns = np.stack((b.doc[piece], b.text_hash[piece], word[first], last - first + k), axis=1)
            cut = np.concatenate(([0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(bucket)])).tolist()
            low, high = low.tolist(), high.tolist()
            for i, j in zip(cut, cut[1:]):
                strings = b" ".join([b.packed[low[x] : high[x]] for x in range(i, j)])
                blob = struct.pack("<q", j - i) + columns[i:j].T.astype("<i8").tobytes() + strings
                rows.append((int(bucket[i]), squeeze.compress(blob), None, None, None))
        if rows:
            yield _rows(rows)


def _unpacked(inflate: zstandard.ZstdDecompressor, blob: bytes) -> tuple[np.ndarray, bytes]:
    """(doc, text hash, first word, words) of each packed string, and the strings."""
    raw = inflate.decompress(blob)
    n = struct.unpack_from("<q", raw)[0]
    return np.frombuffer(raw, "<i8", 4 * n, 8).reshape(4, n), raw[8 + 32 * n :]


def _joined(parts: list[tuple[np.ndarray, bytes]], k: int) -> tuple[_Block, np.ndarray]:
    """Packed strings as one block, and where its windows start."""
    columns = np.concatenate([c for c, _ in parts], axis=1)
    packed = b" ".join([s for _, s in parts])
    starts, ends = spans(packed)
    piece = np.repeat(np.arange(columns.shape[1]), columns[3])
    at = np.flatnonzero(piece[: len(starts) - k + 1] == piece[k - 1 :])
    return _Block(packed, starts, ends, piece, columns[0], columns[1], columns[2]), at


def _deal(parts: list[tuple[np.ndarray, bytes]], k: int, bucket: int, shares: int, squeeze: zstandard.ZstdCompressor) -> pa.RecordBatch:
    """The windows of a bucket that is too large, dealt to shares by a hash of the whole window."""
    b, at = _joined(parts, k)
    word, piece = b.place(at), b.piece[at]
    share = (hashes(b.packed, b.starts[at], b.ends[at + k - 1]) % np.uint64(shares)).astype(np.int64)
    order = np.lexsort((at, share))
    at, word, piece, share = at[order], word[order], piece[order], share[order]
    # neighbours that go to one share still travel as one string
    new = np.concatenate(([True], (at[1:] != at[:-1] + 1) | (share[1:] != share[:-1]) | (piece[1:] != piece[:-1])))
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:] - 1, [len(at) - 1]))
    columns = np.stack((b.doc[piece[first]], b.text_hash[piece[first]], word[first], last - first + k))
    low, high = b.starts[at[first]].tolist(), b.ends[at[last] + k - 1].tolist()
    rows, share = [], share[first]
    cut = np.concatenate(([0], np.flatnonzero(share[1:] != share[:-1]) + 1, [len(share)])).tolist()
    for i, j in zip(cut, cut[1:]):
        strings = b" ".join([b.packed[low[x] : high[x]] for x in range(i, j)])
        blob = struct.pack("<q", j - i) + columns[:, i:j].astype("<i8").tobytes() + strings
        rows.append((bucket, squeeze.compress(blob), int(share[i]), None, None))
    return _rows(rows)


def _gather(batches: Iterator[pa.RecordBatch], k: int, limit: int, shares: int) -> Iterator[pa.RecordBatch]:
    """Ranges of the windows that a smaller document has, bucket by bucket.

    A bucket with more than ``limit`` bytes is settled as it arrives: a window that has been
    found behind a smaller document is done with, so only the first of equal windows wait.  Where
    those are too many as well, they and all that follow leave the bucket, window by window, for one of
    ``shares`` shares (the row's ``doc``); equal windows have the same share.  Without
    shares a bucket holds them all.
    """
    inflate, squeeze = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)

    def settle(parts, last):
        """The ranges found, and what later windows of the bucket must still be compared with."""
        b, at = _joined(parts, k)
        word, piece = b.place(at), b.piece[at]
        again = _repeats(b, at, k)
        found = _ranges(again, word, word + k, b.doc[piece], b.text_hash[piece])
        if last:
            return found, []
        at, word = at[~again], word[~again]
        cut = np.flatnonzero((at[1:] != at[:-1] + 1) | (b.piece[at[1:]] != b.piece[at[:-1]]))
        first, final = np.concatenate(([0], cut + 1)), np.concatenate((cut, [len(at) - 1]))
        kept = np.stack((b.doc[b.piece[at[first]]], b.text_hash[b.piece[at[first]]], word[first], final - first + k))
        strings = [b.packed[i:j] for i, j in zip(b.starts[at[first]].tolist(), b.ends[at[final] + k - 1].tolist())]
        return found, [(kept, b" ".join(strings))]

    def out(rows):
        return _rows([(0, None, *r) for r in rows])

    bucket, parts, size, most, leaving = None, [], 0, limit, False
    for batch in batches:
        through = [r for r in zip(*(c.to_pylist() for c in batch.columns[2:])) if r[2] is not None]
        if through:
            yield out(through)
        for number, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if blob is None:
                continue
            if parts and number != bucket and leaving:
                yield _deal(parts, k, bucket, shares, squeeze)
                parts = []
            elif parts and (number != bucket or size > most):
                found, parts = ([], parts) if leaving else settle(parts, number != bucket)
                if found:
                    yield out(found)
                size = sum(c.nbytes + len(s) for c, s in parts)
                leaving = leaving or bool(shares) and size > limit // 2
                most = limit if leaving else max(limit, 2 * size)
                if leaving and parts:
                    yield _deal(parts, k, bucket, shares, squeeze)
                    parts = []
            if number != bucket:
                bucket, leaving, most = number, False, limit
            if not parts:
                size = 0
            parts.append(_unpacked(inflate, blob))
            size += parts[-1][0].nbytes + len(parts[-1][1])
    if parts and leaving:
        yield _deal(parts, k, bucket, shares, squeeze)
    elif parts and (found := settle(parts, True)[0]):
        yield out(found)


def _once(df: DataFrame, label: str) -> DataFrame:
    """As ``materialised``, for rows that are not made again: what was shuffled for them goes at once."""
    with settings(df.sparkSession, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        return materialised(df, label)


def repeated_ranges(docs: DataFrame, k: int = 13, share: float = 1e-4, bucket_bytes: int = 16 << 20, rounds: int | None = None) -> DataFrame:
    """(doc, text_hash, found): for documents with a repeated window, the word ranges that they cover.

    ``share`` is the part of all words from which on a word group is ranked last; at most
    4 / ``share`` groups are.  ``bucket_bytes`` is the amount of packed text that a task
    sorts at once; a bucket with more text of its own than that is dealt out once more.
    The buckets are filled in ``rounds`` scans, each of which packs its part of the
    windows: by default in two, or in one if the text is small.
    """
    spark = docs.sparkSession
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    counted = (
        texts.mapInArrow(lambda b: _frequent(b, share), "gram bigint, n bigint, bytes bigint")
        .groupBy("gram")
        .agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
    )
    counted = materialised(counted, "grams")
    total = counted.filter("gram is null").first()
    words, size = (total["n"] or 0, total["bytes"] or 0) if total else (0, 0)
    often = counted.filter(F.col("gram").isNotNull() & (F.col("n") >= max(2, share * words))).select("gram").collect()
    frequent = np.unique(np.array([r[0] for r in often], np.int64).view(np.uint64) >> np.uint64(1))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rounds = rounds or (2 if size > ROUND else 1)
    # half full when they are even
    buckets = min(-(-max(4 * tasks, 2 * PACKED * size // bucket_bytes + 1) // rounds), 1 << 30)
    parts = max(tasks, buckets // 16)  # a task takes several buckets, one after another
    shares = 8 * tasks
    rows = "bucket int, blob binary, doc bigint, text_hash bigint, found binary"

    def gathered(turn: int) -> DataFrame:
        moved = (
            texts.mapInArrow(lambda b: _scatter(b, k, frequent, buckets, turn, rounds), rows)
            .repartitionById(parts, F.col("bucket") % F.lit(parts))
            .sortWithinPartitions("bucket")
        )
        return _once(moved.mapInArrow(lambda b: _gather(b, k, bucket_bytes, shares), rows), "gathered")

    found = reduce(DataFrame.unionByName, [gathered(turn) for turn in range(rounds)])
    # what left the buckets that were too large: a share of one bucket is a bucket here
    left = found.filter(F.col("blob").isNotNull())
    if not left.isEmpty():
        dealt = left.select(F.pmod(F.xxhash64("bucket", "doc"), F.lit(1 << 30)).cast("int").alias("bucket"), "blob", *(F.lit(None).cast(t).alias(n) for n, t in (("doc", "bigint"), ("text_hash", "bigint"), ("found", "binary"))))
        dealt = dealt.repartitionById(shares, F.col("bucket") % F.lit(shares)).sortWithinPartitions("bucket")
        again = dealt.mapInArrow(lambda b: _gather(b, k, bucket_bytes, 0), rows)
        found = found.filter(F.col("blob").isNull()).unionByName(again)
    return found.groupBy("doc", "text_hash").agg(F.collect_set("found").alias("found"))


def _cut(packed: bytes, found) -> tuple[int, int, bytes]:
    """(words, removed, the kept words joined by one space)."""
    n = packed.count(b" ") + 1 if packed else 0
    if found is None or not len(found):
        return n, 0, packed
    step = np.zeros(n + 1, np.int64)
    for a, z in np.concatenate([np.frombuffer(f, "<i8").reshape(-1, 2) for f in found]).tolist():
        step[a] += 1
        step[z] -= 1
    gone = np.cumsum(step[:n]) > 0
    if gone.all():
        return n, n, b""
    return n, int(gone.sum()), b" ".join([w for w, g in zip(packed.split(b" "), gone.tolist()) if not g])


def remove_repeats(docs: DataFrame, k: int = 13, **options) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for every row of ``docs`` (doc_id, text).

    A word goes if a window of ``k`` words over it also starts in a document with a smaller
    doc_id; windows are those of the input.  Of copies only the smallest id keeps its words.
    Null and empty texts have no words.  Rows without doc_id come after all others and do
    not repeat one another.  Rows of the same doc_id do not repeat one another either.
    Other columns are ignored.
    """

    return _cut_rows(docs, k, options, "kept", bytes.decode)


def _cut_rows(docs: DataFrame, k: int, options: dict, name: str, of) -> DataFrame:
    @F.arrow_udf(f"n_words bigint, n_removed bigint, {name} string")
    def cut(texts: pa.Array, found: pa.Array) -> pa.Array:
        rows = []
        for at in range(0, len(texts), ROWS):
            pairs = zip(texts.slice(at, ROWS).to_pylist(), found.slice(at, ROWS).to_pylist())
            rows += [(n, gone, of(kept)) for n, gone, kept in (_cut(pack(t), f) for t, f in pairs)]
        columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.string()))]
        return pa.StructArray.from_arrays(columns, ["n_words", "n_removed", name])

    return _with_ranges(docs, k, options).select("doc_id", cut("text", "found").alias("r")).select("doc_id", "r.*")


def _with_ranges(docs: DataFrame, k: int, options: dict) -> DataFrame:
    ranges = _once(repeated_ranges(docs, k, **options), "ranges")
    key = F.coalesce(F.col("doc_id"), F.lit(_NO_ID))
    rows = docs.select("doc_id", "text", key.alias("doc"), F.xxhash64("text").alias("text_hash"))
    return rows.join(ranges, ["doc", "text_hash"], "left")


def repeat_digests(docs: DataFrame, k: int = 13, **options) -> DataFrame:
    """As ``remove_repeats``, with the SHA-256 of the kept words in place of the words."""
    return _cut_rows(docs, k, options, "kept_sha256", lambda kept: hashlib.sha256(kept).hexdigest())
