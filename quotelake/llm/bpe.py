"""BPE encoding by content-defined chunks that documents share.

A rolling hash cuts texts where their content says so, mid-word or not, so copies and shared passages
fall into the same chunks wherever they stand.  Equal chunks meet in a bucket and are encoded
once; their ids go back to the blocks of documents that hold them.  At a join the word that
was cut makes other tokens than its halves: the stretch around the join is encoded anew, from
some words before it to some words after it, and the stretch grows until its first and last
words have the very tokens that they have in the chunks.  Those ids replace the chunks' own
ends, which must be the ones that were expected there.
"""

from __future__ import annotations

import json
import os
import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from tokenizers import Tokenizer

from quotelake.llm.arrow import sliced, values

BLOCK = 8 << 20  # bytes of text cut together
SPAN = 32  # bytes that the rolling hash sees
MASK = np.uint32(2047)  # a chunk ends at one place in 2,048
LEAST = 256  # bytes of a chunk, at least
BUCKETS = 1  # of each task
AT_ONCE = 8 << 20  # bytes of distinct chunks that are encoded together, of one bucket or more
KEPT_BYTES = 32 << 20  # of a larger bucket, so many are taken together
KEPT_WORDS = 1 << 19  # words of each kind whose ids a worker keeps
KEPT_BESIDE = 1 << 17  # words beside joins whose ids a worker keeps
PARTS = 4096  # a chunk is encoded once for each so many partitions of the input, so that a bucket stays small
EMIT = 1 << 20  # ids in a batch
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_MULTIPLY = [np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D), np.uint32(0x27D4EB2F), np.uint32(0x165667B1)]
_loaded: dict[tuple, Encoder | Decoder] = {}


class Known:
    """Ids of words met before, so that a word is not encoded again; emptied when there are too many."""

    def __init__(self, encode, dtype: np.dtype) -> None:
        self.encode = encode
        self.words, self.ids, self.ends = pa.array([], pa.large_string()), np.zeros(0, dtype), np.zeros(0, np.int64)

    def places(self, words: pa.Array) -> np.ndarray:
        """The places of distinct words in the table, which learns those that it lacks."""
        at = pc.index_in(words, value_set=self.words)
        if len(self.words) + at.null_count > KEPT_WORDS and len(self.words):
            self.__init__(self.encode, self.ids.dtype)
            return self.places(words)
        missing = at.is_null()
        fresh = words.filter(missing)
        first = len(self.words)
        if len(fresh):
            ids, ends = self.encode(fresh.to_pylist())
            self.words = pa.concat_arrays([self.words, fresh])
            self.ends = np.concatenate((self.ends, ends + len(self.ids)))
            self.ids = np.concatenate((self.ids, ids))
        out = at.fill_null(0).to_numpy().copy()
        out[missing.to_numpy(zero_copy_only=False)] = np.arange(first, first + len(fresh))
        return out


def _tokenizer(definition: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    tokenizer = Tokenizer.from_str(definition)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _dtype(tokenizer: Tokenizer) -> np.dtype:
    return np.dtype("<u2" if tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")


class Encoder:
    """A tokenizer that drops white space, so that words between blanks have ids of their own."""

    def __init__(self, definition: str) -> None:
        self.tokenizer = _tokenizer(definition)
        self.dtype = _dtype(self.tokenizer)
        parts = ["It's", "naïve", "x1--y", "don't", "日本", "ß"]
        alone = [i for p in parts for i in self.whole(p).tolist()]
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if self.whole(" \n".join(parts)).tolist() != alone or any(set(t) & set(" \t\n\v\f\r") for t in self.added):
            raise ValueError("the tokenizer keeps white space; its texts cannot be cut at blanks")
        self.plain, self.letters = self._for_letters(json.loads(definition))
        self.stems, self.others = Known(self._plain, self.dtype), Known(self._any, self.dtype)
        self.beside: dict[bytes, bytes] = {}

    def _for_letters(self, parts: dict) -> tuple[Tokenizer | None, str]:
        """The model alone, if words of letters, and the marks after them, have ids of their own whatever the letters' case; those letters."""
        suffix = parts["model"].get("end_of_word_suffix")
        if not suffix or any(t.isalpha() for t in self.added):
            return None, ""
        steps = parts.get("pre_tokenizer") or {}
        steps = [s for s in steps.get("pretokenizers", [steps]) if s.get("type") == "ByteLevel" and not s["use_regex"] and not s["add_prefix_space"]]
        parts["normalizer"], parts["pre_tokenizer"] = None, {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, *steps]}
        self.plain = _tokenizer(json.dumps(parts))
        last = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), bool)
        last[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
        self.last = last
        lower = lambda w: pc.utf8_lower(pa.array([w]))[0].as_py()
        latin = [c for c in map(chr, range(0xC0, 0x180)) if c.isalpha() and len(lower(c)) == 1]
        both = [np.split(ids, ends[:-1]) for ids, ends in (self._any([f"x{c}Y" for c in latin]), self._plain([lower(f"x{c}Y") for c in latin]))]
        agree = [c for c, a, b in zip(latin, *both) if np.array_equal(a, b)]
        marks = ("", ".", ",", ";", ":", "!", "?", "?!", "...")
        for w in ("it", "The", "ABCXYZ", "don"):
            if any(self.whole(w + m).tolist() != [*self._plain([lower(w)])[0].tolist(), *self.whole(m).tolist()] for m in marks):
                return None, ""
        return self.plain, f"^[A-Za-z{''.join(agree)}]+$"

    def whole(self, text: str) -> np.ndarray:
        """Ids of a text as the tokenizer gives them."""
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype)

    def _plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of lower-case letters, by the model alone, and where each word's end."""
        lists = [" ".join(words[i : i + 1024]) for i in range(0, len(words), 1024)]
        found = self.plain.encode_batch_fast(lists, add_special_tokens=False)
        ids = np.concatenate([np.zeros(0, self.dtype), *(np.array(e.ids, self.dtype) for e in found)])
        return ids, np.flatnonzero(self.last[ids]) + 1

    def _any(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of any characters, and where each word's end."""
        out, size = [np.zeros(0, self.dtype)], []
        for at in range(0, len(words), 1024):
            some = words[at : at + 1024]
            # special tokens belong to no word
            if special := any(t in w for w in some for t in self.added):
                found = [self.whole(w) for w in some]
                out += found
                size += map(len, found)
            if not special:
                found = self.tokenizer.encode_batch([some], is_pretokenized=True, add_special_tokens=False)[0]
                out.append(np.array(found.ids, self.dtype))
                size += np.diff(np.searchsorted(found.word_ids, np.arange(len(some) + 1))).tolist()
        return np.concatenate(out), np.cumsum(np.array(size, np.int64))

    def _pieces(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Two pieces of each of some words, letters and marks or the word and nothing; the ids of all pieces and where they end."""
        out = np.zeros((len(words), 2), np.int32)  # piece 0 is empty
        simple, rest, marks = np.zeros(len(words), bool), words, pa.array([], pa.large_string())
        marked = simple
        if self.plain is not None:
            stems = pc.utf8_rtrim(words, characters=".,;:!?")
            simple = pc.match_substring_regex(stems, self.letters).to_numpy(zero_copy_only=False)
            marked = simple & pc.not_equal(pc.binary_length(words), pc.binary_length(stems)).to_numpy(zero_copy_only=False)
            letters = pc.utf8_lower(stems.filter(pa.array(simple))).dictionary_encode()
            out[simple, 0] = 1 + self.stems.places(letters.dictionary)[letters.indices.to_numpy()]
            rest, marks = words.filter(pa.array(~simple)), pc.replace_substring_regex(words.filter(pa.array(marked)), "^.*[^.,;:!?]", "")
        others = pa.concat_arrays([rest, marks]).dictionary_encode()
        place = 1 + len(self.stems.words) + self.others.places(others.dictionary)[others.indices.to_numpy()]
        out[~simple, 0], out[marked, 1] = place[: len(rest)], place[len(rest) :]
        ids = np.concatenate((self.stems.ids, self.others.ids))
        return out, ids, np.concatenate(([0], self.stems.ends, self.others.ends + len(self.stems.ids)))

    def texts(self, parts: list[bytes]) -> list[np.ndarray]:
        """Ids of some texts; each distinct word among them is encoded once."""
        data = np.frombuffer(b"\n".join([b"", *parts, b""]), np.uint8)
        blank = _BLANK[data]
        edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        starts, stops = edge[::2], edge[1::2]
        lengths = stops - starts
        offsets = np.concatenate(([0], np.cumsum(lengths)))
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[~blank])]).dictionary_encode()
        pieces, ids, ends = self._pieces(words.dictionary.cast(pa.large_string()))
        size = np.diff(ends, prepend=0).astype(np.int32)
        used = pieces[words.indices.to_numpy()]
        per_word = size[used].sum(axis=1)
        used = used.reshape(-1)
        used = used[used > 0]
        wide = np.int32 if len(data) < 1 << 28 else np.int64
        end = np.cumsum(size[used], dtype=wide)
        shift = ends.astype(wide)[used] - end  # from places in the result to places in ``ids``
        flat = ids[np.arange(end[-1] if len(end) else 0, dtype=shift.dtype) + np.repeat(shift, size[used])]
        borders = np.cumsum([len(p) + 1 for p in parts])
        cut = np.concatenate(([0], np.cumsum(per_word)))[np.searchsorted(starts, borders)]
        return np.split(flat, cut[:-1]) if parts else []

    def word(self, word: bytes) -> bytes:
        """Ids of one word, as they stand in memory."""
        found = self.beside.get(word)
        if found is None:
            if len(self.beside) >= KEPT_BESIDE:
                self.beside = {}
            found = self.beside[word] = self.whole(word.decode()).tobytes()
        return found


class Decoder:
    """The text of ids; without a decoder of its own the library joins tokens by a space."""

    def __init__(self, definition: str) -> None:
        tokenizer = _tokenizer(definition)
        self.dtype = _dtype(tokenizer)
        self.tokenizer = tokenizer if tokenizer.decoder is not None else None
        self.tokens = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size(with_added_tokens=True))]

    def text(self, ids: list[int]) -> str:
        if self.tokenizer:
            return self.tokenizer.decode(ids, skip_special_tokens=False)
        return " ".join(map(self.tokens.__getitem__, ids))


def _load(kind: type, definition: Broadcast):
    """The encoder or decoder of this worker; it serves all of its tasks."""
    key = kind, xxhash.xxh3_64_intdigest(definition.value)
    if key not in _loaded:
        for old in [k for k in _loaded if k[0] is kind]:
            del _loaded[old]
        _loaded[key] = kind(definition.value)
    return _loaded[key]


def ends(data: np.ndarray) -> np.ndarray:
    """The places inside a buffer of UTF-8 where the hash of the bytes before them ends a chunk."""
    if len(data) <= SPAN:
        return np.zeros(0, np.int64)
    h = (data.astype(np.uint32) + np.uint32(1)) * np.uint32(0x2545F491)
    h ^= h >> np.uint32(15)
    width = 1
    for m in _MULTIPLY:  # a hash of twice as many bytes from two neighbouring ones
        h = h[:-width] * m + h[width:]
        width *= 2
    h ^= h >> np.uint32(13)
    at = np.flatnonzero(h[:-1] & MASK == 0) + SPAN
    return at[data[at] & 0xC0 != 0x80]


def borders(data: np.ndarray, places: np.ndarray) -> list[int]:
    """The borders among ``places`` of a text: chunks of LEAST bytes at least, each with a blank."""
    blanks = np.concatenate(([0], np.cumsum(_BLANK[data]))) if len(places) else np.zeros(1, np.int64)
    out, last = [], 0
    for p in places.tolist():
        if p - last >= LEAST and blanks[p] > blanks[last] and blanks[-1] > blanks[p] and p < len(data):
            out.append(p)
            last = p
    return out


@dataclass
class Join:
    """The ids around a border, and the ids of the chunks' ends that they replace."""

    left: np.ndarray
    right: np.ndarray
    ids: np.ndarray


def join(encoder: Encoder, left: bytes, right: bytes) -> Join:
    """Encode around the border of two chunks, over more and more words, until it agrees with both at its ends."""
    n = 2
    while True:
        before, after = left.rsplit(None, n), right.split(None, n)
        a = left[len(before[0]) :] if len(before) > n else left
        b = right[: len(right) - len(after[n])] if len(after) > n else right
        ids = encoder.whole((a + b).decode())
        tail, head = ([encoder.word(w) for w in x.split()] for x in (a, b))
        found = ids.tobytes()
        if (a == left and b == right) or tail and head and found.startswith(tail[0]) and found.endswith(head[-1]):
            return Join(np.frombuffer(b"".join(tail), ids.dtype), np.frombuffer(b"".join(head), ids.dtype), ids)
        n *= 2


@dataclass
class Recipe:
    """How the texts of a block are put together: their chunks by number, and their joins."""

    doc_ids: list = field(default_factory=list)
    chunks: list[list[int]] = field(default_factory=list)
    joins: list[list[int]] = field(default_factory=list)
    distinct: list[Join] = field(default_factory=list)


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """(doc_id, text in UTF-8) of about BLOCK bytes, or of one text."""
    waiting, size = [], 0
    for batch in sliced(batches):
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            text = text or b""
            if waiting and size + len(text) > BLOCK:
                yield waiting
                waiting, size = [], 0
            waiting.append((doc, text))
            size += len(text)
    if waiting:
        yield waiting


_TRAVEL = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("kind", pa.int32()), ("payload", pa.binary())])
_TRAVEL_SQL = "bucket int, block bigint, kind int, payload binary"


def _travel(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _TRAVEL)], schema=_TRAVEL)


def _cut(batches: Iterator[pa.RecordBatch], definition: Broadcast, buckets: int) -> Iterator[pa.RecordBatch]:
    """A recipe for each block, and its distinct chunks packed by bucket."""
    encoder, squeeze = _load(Encoder, definition), zstandard.ZstdCompressor(level=9)
    part = TaskContext.get().partitionId()
    for number, rows in enumerate(_blocks(batches)):
        recipe, chunks, joins = Recipe(), {}, {}
        data = np.frombuffer(b"".join([t for _, t in rows]), np.uint8)
        places, first = ends(data), 0
        for doc, text in rows:
            low, high = np.searchsorted(places, (first + SPAN, first + len(text)))
            cut = [0, *borders(data[first : first + len(text)], places[low:high] - first), len(text)]
            first += len(text)
            pieces = [text[a:b] for a, b in zip(cut, cut[1:]) if b > a]
            recipe.doc_ids.append(doc)
            recipe.chunks.append([chunks.setdefault(p, len(chunks)) for p in pieces])
            mine = []
            for a, b in zip(recipe.chunks[-1], recipe.chunks[-1][1:]):
                if (a, b) not in joins:
                    joins[a, b] = len(recipe.distinct)
                    recipe.distinct.append(join(encoder, pieces[len(mine)], pieces[len(mine) + 1]))
                mine.append(joins[a, b])
            recipe.joins.append(mine)
        block = part << 32 | number
        out = [(block % buckets, block, 0, squeeze.compress(pickle.dumps(recipe)))]
        dealt: dict[int, list[tuple[int, bytes]]] = {}
        for chunk, n in chunks.items():
            dealt.setdefault(xxhash.xxh3_64_intdigest(chunk, part // PARTS) % buckets, []).append((n, chunk))
        out += [(bucket, block, 1, squeeze.compress(pickle.dumps(some))) for bucket, some in dealt.items()]
        yield _travel(out)


def _encode(batches: Iterator[pa.RecordBatch], definition: Broadcast) -> Iterator[pa.RecordBatch]:
    """The ids of the chunks of each block; equal chunks of a bucket are encoded once.  Recipes pass."""
    encoder = _load(Encoder, definition)
    squeeze, inflate = zstandard.ZstdCompressor(level=9), zstandard.ZstdDecompressor()
    waiting: list[tuple[int, list[int], list[int]]] = []  # block, numbers, places of the chunks
    place: dict[bytes, int] = {}
    bucket, size = None, 0

    def encoded_rows():
        ids = encoder.texts(list(place))
        for block, numbers, places in waiting:
            own = [ids[i] for i in places]
            packed = pickle.dumps((np.array(numbers, np.int32), np.array([len(x) for x in own], np.int64), np.concatenate(own)))
            yield _travel([(0, block, 1, squeeze.compress(packed))])

    for batch in batches:
        for at in range(batch.num_rows):
            number, block, kind, payload = (c[at].as_py() for c in batch.columns)
            if kind == 0:
                yield _travel([(0, block, 0, payload)])
                continue
            if size > (KEPT_BYTES if number == bucket else AT_ONCE):
                yield from encoded_rows()
                waiting, place, size = [], {}, 0
            bucket = number
            numbers, places = [], []
            for n, chunk in pickle.loads(inflate.decompress(payload)):
                if chunk not in place:
                    place[chunk] = len(place)
                    size += len(chunk)
                numbers.append(n)
                places.append(place[chunk])
            waiting.append((block, numbers, places))
    if waiting:
        yield from encoded_rows()


def assemble(chunks: list[np.ndarray], joins: list[Join]) -> np.ndarray:
    """The ids of a text from those of its chunks and joins."""
    if not joins:
        return chunks[0] if chunks else np.zeros(0, np.uint16)
    out = []
    for i, own in enumerate(chunks):
        low = len(joins[i - 1].right) if i else 0
        high = len(own) - (len(joins[i].left) if i < len(joins) else 0)
        agree = low <= high and (not i or np.array_equal(own[:low], joins[i - 1].right)) and (i == len(joins) or np.array_equal(own[high:], joins[i].left))
        if not agree:
            raise ValueError("a chunk's ids differ from those expected at its join")
        if i:
            out.append(joins[i - 1].ids)
        out.append(own[low:high])
    return np.concatenate(out)


def _assemble(batches: Iterator[pa.RecordBatch], doc_id: pa.DataType, decode: Broadcast | None) -> Iterator[pa.RecordBatch]:
    """The ids of each text, block by block, and with ``decode`` the text that they decode to; a block's recipe comes first."""
    inflate = zstandard.ZstdDecompressor()
    text = _load(Decoder, decode).text if decode else None

    def emit(rows):
        cut = np.concatenate(([0], np.cumsum([len(x) for _, x in rows]))).astype(np.int32)
        flat = np.concatenate([x for _, x in rows]).astype(np.int32)
        columns = [pa.array([d for d, _ in rows], doc_id), pa.ListArray.from_arrays(pa.array(cut), pa.array(flat))]
        if text:
            columns.append(pa.array([text(x.tolist()) for _, x in rows], pa.string()))
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"][: len(columns)])

    def texts(recipe, found):
        waiting, size = [], 0
        for doc, chunks, joins in zip(recipe.doc_ids, recipe.chunks, recipe.joins):
            waiting.append((doc, assemble([found[i] for i in chunks], [recipe.distinct[i] for i in joins])))
            size += len(waiting[-1][1])
            if size > EMIT:
                yield emit(waiting)
                waiting, size = [], 0
        if waiting:
            yield emit(waiting)

    at, recipe, found = None, None, {}
    for batch in batches:
        for i in range(batch.num_rows):
            block, kind, payload = (c[i].as_py() for c in batch.columns[1:])
            if block != at:
                if recipe is not None:
                    yield from texts(recipe, found)
                at, recipe, found = block, None, {}
            content = pickle.loads(inflate.decompress(payload))
            if kind == 0:
                recipe = content
            else:
                numbers, lengths, ids = content
                found.update(zip(numbers.tolist(), np.split(ids, np.cumsum(lengths)[:-1])))
    if recipe is not None:
        yield from texts(recipe, found)


def _definition(spark: SparkSession, path: str) -> Broadcast:
    """The tokenizer's file, a few MB whatever the corpus, read on the driver."""
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


def encoded(docs: DataFrame, path: str, decoded: bool = False) -> DataFrame:
    """(doc_id, ids) for every row of ``docs`` (doc_id, text): the tokenizer's ids without special tokens of its own.

    With ``decoded``, a third column has the text that the ids decode to.

    ``path`` is a tokenizer file of the tokenizers library; its truncation and padding are not
    used, and it must drop white space.  Strings of special tokens in a text become those
    tokens, as in the library.  Null and empty texts have no ids.  Repeated rows come back
    as often as they occur, other columns are ignored.  The rows must come from files or a
    checkpoint, so that a repeated task sees the same rows in the same order.
    """
    spark = docs.sparkSession
    definition = _definition(spark, path)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    doc_id = docs.schema["doc_id"].dataType
    kind = to_arrow_type(doc_id)
    cut = docs.select("doc_id", "text").mapInArrow(lambda b: _cut(b, definition, tasks * BUCKETS), _TRAVEL_SQL)
    met = cut.repartitionById(tasks, F.col("bucket") % F.lit(tasks)).sortWithinPartitions("bucket")
    back = met.mapInArrow(lambda b: _encode(b, definition), _TRAVEL_SQL).repartition(tasks, "block").sortWithinPartitions("block", "kind")
    text = definition if decoded else None
    return back.mapInArrow(lambda b: _assemble(b, kind, text), f"doc_id {doc_id.simpleString()}, ids array<int>" + ", decoded string" * decoded)


def decoded(spark: SparkSession, ids: Column, path: str) -> Column:
    """The text of each list of ids, special tokens included; a null list has none."""
    definition = _definition(spark, path)

    @F.arrow_udf("string")
    def of(lists: pa.Array) -> pa.Array:
        text = _load(Decoder, definition).text
        return pa.array([text(x or []) for x in values(lists)], pa.string())

    return of(ids)
