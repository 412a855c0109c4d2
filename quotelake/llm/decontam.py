"""Benchmark passages in documents, by latent semantic retrieval.

Benchmark items are cut into passages.  Their TF-IDF vectors (document frequencies are
those of the corpus) are reduced by a randomised singular value decomposition whose
products run over the passages' partitions.  A decomposition takes no more passages than it
has dimensions, so that every passage lies wholly in its latent space; a larger benchmark has
several.  Windows of the documents are folded into each latent space.  There a window is near
a passage if their product reaches that of the fewest and lightest words that can make a
match; words around a copy, however heavy, do not count against it.  Near ones are compared
word by word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.llm.arrow import sliced
from quotelake.llm.scratch import materialised, unused
from quotelake.llm.words import hashes, mix, spans
from quotelake.session import local_rows

WINDOW, STRIDE = 32, 16
MIN_WORDS = 5
RANK = 256  # dimensions, and passages at most, of one decomposition
POWERS = 2
AROUND = 64  # words of a document, from every STRIDE on, in which a passage's words are close together
SPAN, STEP = AROUND + STRIDE, 2 * STRIDE  # windows of the documents and their step: two such stretches each
SURE, LIKELY, ANSWER = 0.8, 0.6, 0.8
ANSWER_WORDS = 8
BLOCK = 1 << 20  # bytes of text handled at a time
ITEM_BYTES = 256 << 10  # benchmark text per index; bounds the index at about 45,000 words and 70 MB
ITEM_COUNT = 2048  # items per index
_KEEP = bytes(c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256))


def normal(text: str | None) -> bytes:
    """Lower-case letters and digits, as words joined by one space."""
    return b" ".join(text.lower().encode().translate(_KEEP).split()) if text else b""


def lcs(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, with one bit per word of ``a``."""
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for y in b:
        m = where.get(y, 0)
        if m:
            hit = row & m
            row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


@dataclass
class Part:
    """Passages that were decomposed together: at most RANK, so that none has a share outside the latent space."""

    items: np.ndarray  # item of each passage
    words: list[list[int]]  # word hashes of each passage
    answers: list[list[int]]  # the last words of its item
    rows: np.ndarray  # the row in ``weighted`` of each place in the vocabulary, or -1; the last one, of no word, is -1
    weighted: np.ndarray  # word x dimension, times the word's weight; the last row, of no word, is zero
    latent: np.ndarray  # passage x dimension, of length one
    spelled: np.ndarray  # passage x word, as rows in ``weighted``; short passages end in the row of no word
    sizes: np.ndarray  # words of each passage
    least: np.ndarray  # how many of them a match has at least
    light: np.ndarray  # sum of squared weights of its ``least`` lightest words
    need: np.ndarray  # product with a window that has any ``least`` of its words, at least


@dataclass
class Index:
    """Benchmark passages in latent spaces, and the words that lead there."""

    parts: list[Part]
    vocabulary: np.ndarray  # sorted word hashes
    slots: np.ndarray  # the top bits of a hash to a first guess of its place
    idf: np.ndarray
    other: float  # the weight of a word that no item has: the median of those that have one

    def places(self, h: np.ndarray) -> np.ndarray:
        return _places(self.vocabulary, self.slots, h)


def _table(vocabulary: np.ndarray) -> np.ndarray:
    """For each value of the top 20 bits, the first word from there on; -1 where there is none."""
    top = (vocabulary >> np.uint64(44)).astype(np.int64)
    out = np.full(1 << 20, -1, np.int32)
    out[top[::-1]] = np.arange(len(top))[::-1]
    return out


def _places(vocabulary: np.ndarray, slots: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The place of each hash among the sorted ones, or -1."""
    out = slots[(h >> np.uint64(44)).astype(np.int64)]
    maybe = np.flatnonzero(out >= 0)
    at = np.minimum(np.searchsorted(vocabulary, h[maybe]), len(vocabulary) - 1)
    out[maybe] = np.where(vocabulary[at] == h[maybe], at, -1)
    return out


def _word_hashes(packed: bytes) -> np.ndarray:
    return hashes(packed, *spans(packed))


def _blocks(batches: Iterator[pa.RecordBatch]):
    """(ids, first word of each text and the end, word hashes) of about a megabyte of texts, or of one text."""
    ids, texts, size = [], [], 0
    for batch in sliced(batches):
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            packed = normal(row[-1])
            if not packed:
                continue
            if texts and size + len(packed) > BLOCK:
                yield _block(ids, texts)
                ids, texts, size = [], [], 0
            ids.append(row[:-1])
            texts.append(packed)
            size += len(packed) + 1
    if texts:
        yield _block(ids, texts)


def _block(ids, texts):
    counts = [t.count(b" ") + 1 for t in texts]
    return ids, np.concatenate(([0], np.cumsum(counts))), _word_hashes(b" ".join(texts))


def _frequencies(batches, vocabulary, slots) -> Iterator[pa.RecordBatch]:
    """(word, n): in how many texts of the partition each word of the benchmark is; -1 counts the texts."""
    seen, texts = np.zeros(len(vocabulary), np.int64), 0
    for ids, first, h in _blocks(batches):
        place = _places(vocabulary, slots, h)
        doc = np.repeat(np.arange(len(ids)), np.diff(first))
        known = place >= 0
        pair = np.unique(doc[known] * len(vocabulary) + place[known])
        seen += np.bincount(pair % len(vocabulary), minlength=len(vocabulary))
        texts += len(ids)
    at = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(([-1], at)).astype(np.int32)), pa.array(np.concatenate(([texts], seen[at])))], ["word", "n"])


def _product(matrix: DataFrame, right: np.ndarray) -> np.ndarray:
    """The transposed matrix times itself times ``right``, summed over the partitions of the rows (words, weights)."""
    shared = matrix.sparkSession.sparkContext.broadcast(right)

    def part(batches):
        total = np.zeros(shared.value.shape)
        for batch in batches:
            for words, weights in zip(*(c.to_pylist() for c in batch.columns)):
                i, x = np.array(words, np.int64), np.array(weights)
                total[i] += np.outer(x, x @ shared.value[i])
        at = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array([r.tobytes() for r in total[at]], pa.binary())], ["word", "row"])

    out = np.zeros(right.shape)
    sums = matrix.select("words", "weights").mapInArrow(part, "word int, row binary").toArrow()
    np.add.at(out, sums["word"].to_numpy(), np.array([np.frombuffer(r) for r in sums["row"].to_pylist()]).reshape(-1, right.shape[1]))
    return out


def latent_basis(matrix: DataFrame, columns: int, rank: int = RANK, seed: int = 1) -> np.ndarray:
    """The leading right singular vectors of the rows, by randomised range finding with power steps."""
    rank = min(rank, columns)
    extra = min(columns, rank + 8)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((columns, extra)))[0]
    for _ in range(POWERS):
        q = np.linalg.qr(_product(matrix, q))[0]
    values, vectors = np.linalg.eigh(q.T @ _product(matrix, q))
    keep = np.argsort(-values)[:rank]
    return (q @ vectors[:, keep[values[keep] > 1e-9]]).astype(np.float32)


def build_index(docs: DataFrame, items: list[tuple[int, str]]) -> Index | None:
    """Index some benchmark items against the whole corpus ``docs`` (text); None if they have no passage."""
    spark = docs.sparkSession
    owner, words, answers = [], [], []
    for item, text in items:
        h = _word_hashes(normal(text)).tolist()
        if len(h) < MIN_WORDS:
            continue
        starts = list(range(0, max(1, len(h) - WINDOW + 1), STRIDE))
        if starts[-1] + WINDOW < len(h):
            starts.append(len(h) - WINDOW)
        for s in starts:
            owner.append(item)
            words.append(h[s : s + WINDOW])
            answers.append(h[-ANSWER_WORDS:])
    if not words:
        return None
    vocabulary = np.unique(np.array([x for w in words for x in w], np.uint64))
    slots = _table(vocabulary)
    counted = docs.select("text").mapInArrow(lambda b: _frequencies(b, vocabulary, slots), "word int, n bigint")
    counted = {r[0]: r[1] for r in counted.groupBy("word").agg(F.sum("n")).collect()}  # a number per benchmark word
    n = counted.pop(-1, 0)
    df = np.zeros(len(vocabulary))
    df[list(counted)] = list(counted.values())
    idf = np.log((n + 2) / (df + 1)) + 1e-3
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    parts = [_part(spark, [(owner[i], words[i], answers[i]) for i in some], vocabulary, idf) for some in np.array_split(order, -(-len(order) // RANK))]
    return Index(parts, vocabulary, slots, idf, float(np.median(idf)))


def _part(spark: SparkSession, passages: list[tuple[int, list[int], list[int]]], vocabulary: np.ndarray, idf: np.ndarray) -> Part:
    """Decompose some passages (item, words, answer), at most RANK."""
    owner, words, answers = (list(c) for c in zip(*passages))
    own = np.unique(np.array([x for w in words for x in w], np.uint64))
    at_own = np.searchsorted(vocabulary, own)
    place_to_row = np.full(len(vocabulary) + 1, -1, np.int32)
    place_to_row[at_own] = np.arange(len(own))
    idf = idf[at_own]
    spelled = np.full((len(words), WINDOW), len(own), np.int32)
    sizes = np.array([len(w) for w in words])
    least = np.ceil(np.where(sizes > ANSWER_WORDS, LIKELY, SURE) * sizes - 1e-9).astype(np.int64)
    rows, light, need = [], [], []
    for i, w in enumerate(words):
        spelled[i, : len(w)] = np.searchsorted(own, np.array(w, np.uint64))
        at, tf = np.unique(spelled[i, : len(w)], return_counts=True)
        x = tf * idf[at]
        rows.append((at.tolist(), (x / np.linalg.norm(x)).tolist()))
        light.append((np.sort(idf[spelled[i, : len(w)]])[: least[i]] ** 2).sum())
        need.append(light[i] / np.linalg.norm(x))
    schema = T.StructType([T.StructField("words", T.ArrayType(T.IntegerType())), T.StructField("weights", T.ArrayType(T.DoubleType()))])
    matrix = local_rows(spark, rows, schema).repartition(min(8, len(rows)))
    basis = latent_basis(matrix, len(own))
    latent = np.stack([np.array(x) @ basis[at] for at, x in rows]).astype(np.float32)
    weighted = np.zeros((len(own) + 1, basis.shape[1]), np.float32)
    weighted[:-1] = basis * idf[:, None].astype(np.float32)
    return Part(np.array(owner, np.int64), words, answers, place_to_row, weighted, latent, spelled, sizes, least, np.array(light), np.array(need))


def _hits(index: Index, first: np.ndarray, h: np.ndarray) -> Iterator[tuple[int, int, float, float]]:
    """(text, item, cosine, common subsequence) of passages found in the texts of a block."""
    place = index.places(h)
    weights = np.where(place >= 0, index.idf[place], index.other)
    counts = np.diff(first)
    per_text = np.maximum(1, -(-(counts - SPAN) // STEP) + 1)
    text = np.repeat(np.arange(len(counts)), per_text)
    number = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    low = first[text] + number * STEP
    high = np.minimum(low + SPAN, first[text + 1])
    for part in index.parts:
        yield from _part_hits(part, first, h, place, weights, text, low, high)


def _part_hits(index: Part, first, h, place, weights, text, low, high) -> Iterator[tuple[int, int, float, float]]:
    """The hits of one part in windows from ``low`` to ``high``."""
    row = index.rows[place]
    known = np.concatenate(([0], np.cumsum(row >= 0)))
    mass = np.concatenate(([0.0], np.cumsum(np.where(row >= 0, weights**2, 0.0))))
    enough = (known[high] - known[low] >= index.least.min()) & (mass[high] - mass[low] >= index.light.min() * (1 - 1e-6) - 1e-9)
    need = (index.need * 0.999 - 1e-4).astype(np.float32)  # single precision
    at = np.flatnonzero(enough)
    for some in (at[i : i + 2048] for i in range(0, len(at), 2048)):
        product = _fold(index, row, low[some], high[some]) @ index.latent.T
        near, passages = np.divmod(np.flatnonzero(product >= need), product.shape[1])
        for w, p in _shared(index, row, low[some], high[some], near, passages):
            i = some[w]
            found = 0.0, 0.0
            for start in range(low[i], max(low[i] + 1, high[i] - AROUND + STRIDE), STRIDE):
                end = min(start + AROUND, high[i])
                common = lcs(index.words[p], h[start:end].tolist())
                if common < index.least[p]:
                    continue
                share = common / index.sizes[p]
                if share < SURE:  # a paraphrase must have the answer as well
                    after = h[start : min(first[text[i] + 1], end + 2 * WINDOW - STRIDE)].tolist()
                    if lcs(index.answers[p], after) < ANSWER * len(index.answers[p]):
                        continue
                found = max(found, (share, _cosine(index, p, row[start:end], h[start:end], weights[start:end])))
            if found[0]:
                yield int(text[i]), int(index.items[p]), found[1], found[0]


def _shared(index: Part, rows: np.ndarray, low: np.ndarray, high: np.ndarray, near: np.ndarray, passages: np.ndarray) -> Iterator[tuple[int, int]]:
    """Of the pairs of a window and a passage, those with enough words of the passage in the window in any order."""
    if not len(near):
        return
    present = np.zeros((len(low), len(index.weighted)), bool)
    for j in range((high - low).max()):
        here = np.flatnonzero(low + j < high)
        present[here, rows[low[here] + j]] = True
    present[:, -1] = False  # -1 is the row of no word
    for a in range(0, len(near), 1 << 15):
        w, p = near[a : a + (1 << 15)], passages[a : a + (1 << 15)]
        keep = present[w[:, None], index.spelled[p]].sum(axis=1) >= index.least[p]
        yield from zip(w[keep].tolist(), p[keep].tolist())


def _cosine(index: Part, p: int, rows: np.ndarray, h: np.ndarray, weights: np.ndarray) -> float:
    """The cosine of a passage and the words of its number that are most like it."""
    n = min(int(index.sizes[p]), len(h))
    products = np.concatenate(([0.0], np.cumsum(index.weighted[rows] @ index.latent[p], dtype=float)))
    squares = np.concatenate(([0.0], np.cumsum(weights**2)))
    best = int(np.argmax((products[n:] - products[:-n]) / np.sqrt(squares[n:] - squares[:-n])))
    _, one, tf = np.unique(h[best : best + n], return_index=True, return_counts=True)
    return min(1.0, float((products[best + n] - products[best]) / np.linalg.norm(tf * weights[best : best + n][one])))


def _fold(index: Part, rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Windows in the latent space, one word of each at a time."""
    out = np.zeros((len(low), index.weighted.shape[1]), np.float32)
    row = np.empty_like(out)
    for j in range((high - low).max()):
        word = np.where(low + j < high, rows[np.minimum(low + j, len(rows) - 1)], -1)
        out += np.take(index.weighted, word, axis=0, out=row, mode="wrap")  # -1 is the row of no word
    return out


def _scan(batches, shared) -> Iterator[pa.RecordBatch]:
    index = shared.value
    for ids, first, h in _blocks(batches):
        best: dict[tuple[int, int], tuple[float, float]] = {}
        for text, item, cosine, share in _hits(index, first, h):
            best[text, item] = max(best.get((text, item), (0.0, 0.0)), (share, cosine))
        if best:
            rows = [(*ids[t], item, cosine, share) for (t, item), (share, cosine) in best.items()]
            types = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["doc_id", "text_hash", "item_id", "cosine", "lcs_share"])


def _item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in blocks of bounded size; a block at a time is on the driver."""
    rows = benchmark.select("item_id", "text").dropna()
    size, count = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    n = max(-(-size // ITEM_BYTES), -(-count // ITEM_COUNT))
    for i in range(n):
        yield sorted(tuple(r) for r in rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i).collect())


def contaminations(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_hash, item_id, cosine, lcs_share): pairs of a document and an item of which it has a passage.

    A passage is found if 0.8 of its words are in the document in order, close together, or
    0.6 of them and the item's last words.  Words are close together within any 49 words, and
    within some 64.  An item of up to eight words consists of last words: 0.8 of them must
    be close together.  ``cosine`` is that of the passage and as many words of the document.  Items of fewer than five words, null items and
    null texts match nothing.  Repeated documents and items give one pair.  ``text_hash``
    tells apart documents without an id or with the same one.  A benchmark beyond 256 KB is
    taken in blocks, each with an index of its own and a pass over the documents; so is one of more
    than 2,048 items.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    schema = "doc_id bigint, text_hash bigint, item_id bigint, cosine double, lcs_share double"
    found = spark.createDataFrame([], schema)
    for items in _item_blocks(benchmark):
        if (index := build_index(docs, items)) is None:
            continue
        shared = spark.sparkContext.broadcast(index)
        found = found.unionByName(rows.mapInArrow(lambda b, shared=shared: _scan(b, shared), schema))
    return found.groupBy("doc_id", "text_hash", "item_id").agg(F.max("cosine").alias("cosine"), F.max("lcs_share").alias("lcs_share"))


def uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a benchmark passage."""
    i, h = unused(docs, "_id"), unused(docs, "_hash")
    bad = materialised(contaminations(docs, benchmark).select(F.col("doc_id").alias(i), F.col("text_hash").alias(h)).distinct(), "contaminated")
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col(i)) & (F.xxhash64("text") == F.col(h)), "left_anti")
