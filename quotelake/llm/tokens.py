"""Token ids in training order: fixed-stride binary shards that can be read from any slot.

Texts are tokenised and packed where they are read.  Every sequence has an index, its
partition and its number in it, and a keyed Feistel permutation of the index range gives it
a place.  The range of places is cut into equal parts: a task takes one part, sorts it and
writes it as one shard.  A sequence's slot is its rank among all places, known from the
number of sequences in the shards before.  One shuffle, no sampling, no second tokenisation.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
import tiktoken
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.llm.arrow import sliced
from quotelake.llm.scratch import open_store
from quotelake.llm.words import mix
from quotelake.session import local_rows, scratch_path

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# fixed value: the pattern that the byte-level vocabularies were made with
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG_RUN = 10_000  # characters
PER_PARTITION = 1 << 28  # sequences that a partition can have
ROUNDS = 4
READ_RECORDS = 4096


def permute(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """A keyed permutation of 0 to ``size`` - 1: a Feistel network, walked until the value is in range."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    keys = mix(np.arange(ROUNDS, dtype=np.uint64) + np.uint64(key * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    out = np.asarray(index, np.uint64).copy()
    todo = np.arange(len(out))
    while len(todo):
        a, b = out[todo] >> np.uint64(half), out[todo] & low
        for k in keys:
            a, b = b, a ^ (mix(b ^ k) & low)
        out[todo] = (a << np.uint64(half)) | b
        todo = todo[out[todo] >= np.uint64(size)]
    return out.astype(np.int64)


def load_ranks(path: str) -> dict[bytes, int]:
    """The merges of a vocabulary file: a base64 token and its id per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


# fixed value: the characters that the pattern takes for white space
_RUN = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_RUN)


def encode(encoding: tiktoken.Encoding, text: str) -> list[int]:
    """The ids of a text; a long run of white space is taken out of the pattern's way.

    The pattern makes one piece of such a run, up to its last character if a word follows,
    but searches it with a step of recursion for each character.
    """
    ids, done = [], 0
    for run in _RUN.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        ids += encoding.encode_ordinary(text[done : run.start()])
        ids += encoding._encode_single_piece(text[run.start() : end].encode())
        done = end
    return ids + encoding.encode_ordinary(text[done:]) if done else encoding.encode_ordinary(text)


def encoding(ranks: dict[bytes, int]) -> tiktoken.Encoding:
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@dataclass(frozen=True)
class Layout:
    """``length`` tokens a sequence, each of ``width`` bytes; texts end with the token ``end``, which also pads."""

    length: int
    end: int

    @property
    def dtype(self) -> np.dtype:
        return np.dtype("<u2" if self.end < 1 << 16 else "<u4")

    @property
    def stride(self) -> int:
        return self.length * self.dtype.itemsize


def _pack(batches: Iterator[pa.RecordBatch], ranks: Broadcast, layout: Layout, partitions: int, shards: int, key: int) -> Iterator[pa.RecordBatch]:
    codec = encoding(ranks.value)
    part, done = TaskContext.get().partitionId(), 0
    size = partitions * PER_PARTITION
    squeeze = zstandard.ZstdCompressor(level=1)
    tail, tail_docs, tail_ends = np.zeros(0, layout.dtype), [], []

    def emit(tokens, docs, ends, n):
        """The first ``n`` sequences of the tokens; ``ends`` are the ends of the documents."""
        nonlocal done
        place = permute(np.arange(done, done + n, dtype=np.uint64) + np.uint64(part * PER_PARTITION), size, key)
        done += n
        if part >= partitions or done > PER_PARTITION:
            raise ValueError("the rows are not partitioned as planned; materialise them first")
        first = np.searchsorted(ends, np.arange(n) * layout.length, "right")
        last = np.searchsorted(ends, np.minimum(np.arange(1, n + 1) * layout.length, len(tokens)), "left")
        rows = [tokens[i * layout.length : (i + 1) * layout.length] for i in range(n)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array((place // -(-size // shards)).astype(np.int32)),
                pa.array(place),
                pa.array([len(r) for r in rows], pa.int32()),
                pa.array([docs[a : b + 1] for a, b in zip(first.tolist(), last.tolist())], pa.list_(pa.int64())),
                pa.array([squeeze.compress(r.tobytes()) for r in rows], pa.binary()),
            ],
            ["shard", "place", "n_tokens", "doc_ids", "payload"],
        )

    for batch in sliced(batches):
        docs, ends, parts, total = list(tail_docs), list(tail_ends), [tail], len(tail)
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if not text:
                continue
            ids = encode(codec, text)
            ids.append(layout.end)
            parts.append(np.array(ids, layout.dtype))
            total += len(ids)
            docs.append(doc)
            ends.append(total)
        tokens, n = np.concatenate(parts), total // layout.length
        for at in range(0, n, 1024):  # a batch holds a few MB
            m = min(1024, n - at)
            low = at * layout.length
            near = np.searchsorted(ends, low, "right")
            yield emit(tokens[low : low + m * layout.length], docs[near:], np.array(ends[near:], np.int64) - low, m)
        low = n * layout.length
        near = int(np.searchsorted(ends, low, "right"))
        tail, tail_docs, tail_ends = tokens[low:], docs[near:], [e - low for e in ends[near:]]
    if len(tail):
        yield emit(tail, tail_docs, np.array(tail_ends, np.int64), 1)


def _write(batches: Iterator[pa.RecordBatch], folder: str, layout: Layout) -> Iterator[pa.RecordBatch]:
    """Write a sorted part as one shard; it takes its name when whole, so a repeated task replaces it."""
    context = TaskContext.get()
    store, base = open_store(folder)
    draft = f"{base}/.draft-{context.partitionId():06d}-{context.taskAttemptId()}"
    inflate = zstandard.ZstdDecompressor()
    out, shard, position = None, None, 0
    for batch in sliced(batches):
        if out is None:
            store.create_dir(base, recursive=True)
            out, shard = store.open_output_stream(draft, compression=None), batch.column(0)[0].as_py()
        sums = []
        for payload, n in zip(batch.column(4).to_pylist(), batch.column(2).to_pylist()):
            record = inflate.decompress(payload) + layout.dtype.type(layout.end).tobytes() * (layout.length - n)
            sums.append(zlib.crc32(record))
            out.write(record)
        at = np.arange(position, position + batch.num_rows, dtype=np.int64)
        position += batch.num_rows
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(at), batch.column(2), pa.array(sums, pa.int64()), batch.column(3)], ["shard", "position", "n_tokens", "crc32", "doc_ids"])
    if out is not None:
        out.close()
        store.move(draft, f"{base}/{_name(shard)}")


def _name(shard: int) -> str:
    return f"shard-{shard:06d}.bin"


def write_shards(docs: DataFrame, folder: str, length: int = 2048, key: int = 1, shards: int | None = None, vocabulary: str = VOCABULARY, end: int = 50256) -> DataFrame:
    """Tokenise ``docs`` (doc_id, text) and return a row for each sequence.

    (slot, shard, byte_offset, n_tokens, crc32 of the record, doc_ids).  Sequences are full
    but for the last of a partition, which is padded with ``end`` like every text's end.
    Null and empty texts have no tokens and are in no sequence.  A row without doc_id has a
    null in doc_ids, repeated rows are tokenised as often as they occur, other columns are
    ignored.  The rows must come from files or a checkpoint, so that a repeated task sees
    the same rows in the same order.  ``folder``/index holds the rows.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text")
    partitions = max(1, rows.rdd.getNumPartitions())
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    layout = Layout(length, end)
    ranks = spark.sparkContext.broadcast(load_ranks(vocabulary))
    packed = rows.mapInArrow(lambda b: _pack(b, ranks, layout, partitions, shards, key), "shard int, place bigint, n_tokens int, doc_ids array<bigint>, payload binary")
    ordered = packed.repartitionById(shards, F.col("shard")).sortWithinPartitions("place")
    ordered.mapInArrow(lambda b: _write(b, folder, layout), "shard int, position bigint, n_tokens int, crc32 bigint, doc_ids array<bigint>").write.parquet(f"{folder}/written")
    written = spark.read.parquet(f"{folder}/written")
    counts = sorted(tuple(r) for r in written.groupBy("shard").agg(F.count("*")).collect())  # a number per shard
    first = [0, *accumulate(n for _, n in counts)]
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("of_shard", "first_slot")])
    starts = local_rows(spark, [(s, f) for (s, _), f in zip(counts, first)], schema)
    slots = written.join(F.broadcast(starts), F.col("shard") == F.col("of_shard")).select(
        (F.col("first_slot") + F.col("position")).alias("slot"), "shard", (F.col("position") * layout.stride).alias("byte_offset"), "n_tokens", "crc32", "doc_ids"
    )
    slots.write.parquet(f"{folder}/index")
    return spark.read.parquet(f"{folder}/index")


def read_shards(spark: SparkSession, folder: str, length: int = 2048, end: int = 50256, first_slot: int = 0, count: int | None = None) -> DataFrame:
    """(slot, n_tokens, tokens) of ``count`` slots from ``first_slot`` on; each shard is read from its first wanted byte.

    ``tokens`` has the whole record; what follows the first ``n_tokens`` is padding.  A record
    that does not have the checksum of the index is an error.  Up to READ_RECORDS
    neighbouring records are read by one task.
    """
    layout = Layout(length, end)
    wanted = spark.read.parquet(f"{folder}/index").filter(F.col("slot") >= first_slot)
    if count is not None:
        wanted = wanted.filter(F.col("slot") < first_slot + count)
    parts = wanted.groupBy("shard", F.floor(F.col("byte_offset") / (READ_RECORDS * layout.stride)).alias("block")).agg(F.sort_array(F.collect_list(F.struct("byte_offset", "slot", "n_tokens", "crc32"))).alias("records"))

    def read(batches):
        store, base = open_store(folder)
        for batch in batches:
            for shard, records in zip(batch.column(0).to_pylist(), batch.column(2)):
                rows = records.values
                offset, slot, n_tokens, sums = (rows.field(i).to_numpy() for i in range(4))
                with store.open_input_file(f"{base}/{_name(shard)}") as file:
                    file.seek(int(offset[0]))
                    for at in range(0, len(slot), 256):
                        n = min(256, len(slot) - at)
                        data = file.read(n * layout.stride)
                        found = [zlib.crc32(data[i : i + layout.stride]) for i in range(0, n * layout.stride, layout.stride)]
                        if len(data) != n * layout.stride or found != sums[at : at + n].tolist():
                            raise ValueError(f"{_name(shard)}: records from byte {offset[at]} on are damaged")
                        tokens = pa.array(np.frombuffer(data, layout.dtype).astype(np.int32))
                        lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * layout.length), tokens)
                        yield pa.RecordBatch.from_arrays([pa.array(slot[at : at + n]), pa.array(n_tokens[at : at + n]), lists], ["slot", "n_tokens", "tokens"])

    return parts.mapInArrow(read, "slot bigint, n_tokens int, tokens array<int>")


def shard_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "llm-shards")
