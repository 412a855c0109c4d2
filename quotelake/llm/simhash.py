"""Near-duplicates by SimHash, found with multi-index hashing.

Two 64-bit fingerprints that differ in at most four bits agree in one of three segments
up to one bit (by the general pigeonhole principle, up to one bit in the first or the
second segment, or exactly in the third).  Every fingerprint is put into a table once per segment;
the lookups enumerate the Hamming ball of each segment, and complete distances
decide.  The shuffles carry distinct fingerprints only, so copies cost nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.llm.arrow import values
from quotelake.llm.components import components
from quotelake.llm.scratch import materialised, unused
from quotelake.llm.words import spans

SEED = 42
_LANES = np.uint64(0x0101010101010101)
_PIECE = 1 << 18  # shingles hashed at a time
_PAIRS = 1 << 21  # distances computed at a time


def fingerprint(text: str | None, k: int = 4) -> int:
    """The SimHash of a text as an unsigned number; a text without words has zero."""
    packed = b" ".join(text.encode().lower().split()) if text else b""
    if not packed:
        return 0
    starts, ends = spans(packed)
    if len(starts) > k:
        starts, ends = starts[: len(starts) - k + 1], ends[k - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    counts = np.zeros((8, 8), np.int64)  # byte of the hash, bit of the byte
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), _PIECE):
        pairs = zip(starts[at : at + _PIECE].tolist(), ends[at : at + _PIECE].tolist())
        h = np.array([digest(packed[a:b], SEED) for a, b in pairs], np.uint64)
        h = np.concatenate((h, np.zeros(-len(h) % 255, np.uint64)))
        for bit in range(8):  # eight counters in the bytes of a word; 255 rows cannot overflow them
            lanes = ((h >> np.uint64(bit)) & _LANES).reshape(-1, 255).sum(axis=1, dtype=np.uint64)
            counts[:, bit] += lanes.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return sum(1 << int(i) for i in np.flatnonzero(2 * counts.reshape(-1) > len(starts)))


def simhash(text: Column, k: int = 4) -> Column:
    """The fingerprint of each text as a bigint with the same bits."""

    @F.arrow_udf("bigint")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(t, k) for t in values(texts)], np.uint64).view(np.int64))

    return of(text)


def _segments(max_bits: int) -> list[tuple[int, int, int]]:
    """(shift, width, radius) of each segment: the radii plus one each add up to ``max_bits`` + 1."""
    n = max(1, (max_bits + 2) // 2)  # so no radius is above one
    if max_bits > 20:
        raise ValueError("at most 20 bits")
    radius = [1 if i < max_bits + 1 - n else 0 for i in range(n)]
    cuts = [64 * i // n for i in range(n + 1)]
    return [(a, b - a, r) for a, b, r in zip(cuts, cuts[1:], radius)]


def _key(fp: Column, shift: Column, mask: Column) -> Column:
    return F.call_function("shiftrightunsigned", fp, shift).bitwiseAND(mask)


def _index_rows(prints: DataFrame, max_bits: int, probes: bool) -> DataFrame:
    """(segment, key, probe, fp): a fingerprint's own keys, or all keys of its Hamming balls."""
    rows = []
    for s, (shift, width, radius) in enumerate(_segments(max_bits)):
        flips = [0, *(1 << b for b in range(width))] if probes and radius else [0]
        rows += [(s, shift, (1 << width) - 1, f) for f in flips]
    place = F.explode(
        F.array(*(F.struct(*(F.lit(v).cast(t).alias(n) for n, v, t in zip(("s", "shift", "mask", "flip"), r, ("int", "int", "bigint", "bigint")))) for r in rows))
    ).alias("p")
    # shift is a folded constant array, so the explosion costs no lookup
    return prints.select("fp", place).select(
        F.col("p.s").alias("s"),
        F.expr("(shiftrightunsigned(fp, p.shift) & p.mask) ^ p.flip").alias("key"),
        F.lit(probes).alias("probe"),
        "fp",
    )


def _grid(table: DataFrame, max_bits: int, block: int) -> DataFrame:
    """How finely to cut crowded keys: table blocks ``nt`` and lookup shares ``np`` of a key.

    A key is crowded if more than ``block`` fingerprints carry it; the lookups of the keys
    around it come from its own fingerprints, so their number follows from the same counts.
    """
    crowded = table.groupBy("s", "key").agg(F.count("*").alias("n")).filter(F.col("n") > block)
    flips = []
    for s, (_, width, radius) in enumerate(_segments(max_bits)):
        flips += [(s, f) for f in [0, *(1 << b for b in range(width) if radius)]]
    arrays = [F.array(*(F.lit(f).cast("bigint") for t, f in flips if t == s)) for s in range(len(_segments(max_bits)))]
    around = F.element_at(F.array(*arrays), F.col("s") + 1)
    near = crowded.select("s", "key", "n", F.explode(around).alias("flip")).select(
        "s",
        F.col("key").bitwiseXOR(F.col("flip")).alias("key"),
        F.when(F.col("flip") == 0, F.col("n")).otherwise(0).alias("t"),
        "n",
    )
    parts = lambda c: F.ceil(F.sum(c) / block).cast("int")
    return near.groupBy("s", "key").agg(F.greatest(F.lit(1), parts("t")).alias("nt"), F.greatest(F.lit(1), parts("n")).alias("np"))


def _forest(table: np.ndarray, probes: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Pairs within the distance that connect what all such pairs of a crowded cell connect: one per lookup and merge."""
    label = np.arange(len(table))
    out = []
    for p in probes:
        at = np.flatnonzero(np.bitwise_count(table ^ p) <= max_bits)
        if not len(at):
            continue
        roots, member = np.unique(label[at], return_index=True)
        out += [(int(p), int(x)) for x in table[at[member]] if x != p]
        if len(roots) > 1:
            label[np.isin(label, roots)] = roots[0]
    return out


def _links(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell, table before lookups, to links that keep each cell connected as it is.

    A cell's table is bounded by the grid; its lookups stream past in batches.
    """

    def emit(a, b):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.asarray(a, np.uint64).view(np.int64)), pa.array(np.asarray(b, np.uint64).view(np.int64))], ["u", "v"]
        )

    cell, table = None, np.zeros(0, np.uint64)
    for batch in batches:
        cells = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)], axis=1)
        probe = batch.column(4).to_numpy(zero_copy_only=False).astype(bool)
        fp = batch.column(5).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        if not len(fp):
            continue
        edges = np.flatnonzero((cells[1:] != cells[:-1]).any(axis=1)) + 1
        low, high = np.concatenate(([0], edges)), np.concatenate((edges, [len(fp)]))
        left, right = [], []  # small cells, compared together
        pending = 0
        for a, b in zip(low.tolist(), high.tolist()):
            here = tuple(cells[a])
            middle = a + int(np.searchsorted(probe[a:b], True))
            if here != cell:
                cell, table = here, fp[a:middle]
            elif middle > a:
                table = np.concatenate((table, fp[a:middle]))
            lookups = fp[middle:b]
            if not len(table) or not len(lookups):
                continue
            if len(table) <= 32:
                left.append(np.repeat(table, len(lookups)))
                right.append(np.tile(lookups, len(table)))
                pending += len(left[-1])
            elif found := _forest(table, lookups, max_bits):
                yield emit(*zip(*found))
            if pending > _PAIRS:
                yield _close(left, right, max_bits, emit)
                left, right, pending = [], [], 0
        if pending:
            yield _close(left, right, max_bits, emit)


def _close(left, right, max_bits, emit):
    x, y = np.concatenate(left), np.concatenate(right)
    near = (np.bitwise_count(x ^ y) <= max_bits) & (x != y)
    pairs = np.unique(np.stack((np.minimum(x, y)[near], np.maximum(x, y)[near]), axis=1), axis=0)
    return emit(pairs[:, 0], pairs[:, 1])


def fingerprint_links(prints: DataFrame, max_bits: int = 4, block: int = 2048) -> DataFrame:
    """Links (u, v) between distinct fingerprints ``fp`` within ``max_bits`` of each other.

    Every two such fingerprints end in one component; inside a crowded cell only a
    spanning set of the pairs is returned.  A key with more than ``block`` fingerprints is
    cut into a grid of table blocks and lookup shares that together compare every pair.
    """
    table = _index_rows(prints, max_bits, False)
    grid = materialised(_grid(table, max_bits, block), "grid")
    rows = table.unionByName(_index_rows(prints, max_bits, True)).join(grid, ["s", "key"], "left")
    share = lambda n, seed: F.coalesce(F.pmod(F.xxhash64("fp", F.lit(seed)), n), F.lit(0)).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.coalesce(n, F.lit(1)) - 1)
    cells = (
        rows.withColumn("t", F.explode(F.when(F.col("probe"), every(F.col("nt"))).otherwise(F.array(share(F.col("nt"), 1)))))
        .withColumn("l", F.explode(F.when(F.col("probe"), F.array(share(F.col("np"), 2))).otherwise(every(F.col("np")))))
        .select("s", "key", "t", "l", "probe", "fp")
        .repartition("s", "key", "t", "l")
        .sortWithinPartitions("s", "key", "t", "l", "probe")
    )
    return cells.mapInArrow(lambda batches: _links(batches, max_bits), "u bigint, v bigint")


def near_duplicates(docs: DataFrame, k: int = 4, max_bits: int = 4, block: int = 2048) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs`` (doc_id, text).

    Null and empty texts have fingerprint zero and link like any other.  A row without
    doc_id keeps its row; a component's id is its smallest doc_id that is not null, or null
    if it has none.  Repeated rows give repeated rows.  Other columns are ignored.
    """
    prints = materialised(docs.select("doc_id", simhash(F.col("text"), k).alias("fp")), "prints")
    of_print = _groups(prints, max_bits, block)
    return prints.join(of_print, prints["fp"] == of_print["print"]).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _groups(prints: DataFrame, max_bits: int, block: int) -> DataFrame:
    """(print, root, component_id) of each fingerprint in ``prints`` (doc_id, fp); a group has one root."""
    distinct = materialised(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = components(fingerprint_links(distinct.select("fp"), max_bits, block))
    labelled = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    ids = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    return materialised(labelled.join(ids, "root").select(F.col("fp").alias("print"), "root", "component_id"), "groups")


def one_per_group(docs: DataFrame, k: int = 4, max_bits: int = 4) -> DataFrame:
    """The documents that stay: one row of each group, with the group's id if it has one.

    It is the first in the order of doc_id (null last), fingerprint, text and the other
    columns, the last two by their hashes, so every run keeps the same one.
    """
    # maps and variants have no hash; rows that differ in nothing else are taken for equal
    hashed = [c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    of_text, of_row = unused(docs, "_text"), unused(docs, "_row")
    marked = docs.withColumns({of_text: F.xxhash64("text"), of_row: F.xxhash64(*(F.col(f"`{c}`") for c in hashed), *(F.col(f"`{c}`").isNull() for c in hashed))})
    prints = marked.select("doc_id", simhash(F.col("text"), k).alias("fp"), F.col(of_text).alias("t"), F.col(of_row).alias("r"))
    prints = materialised(prints, "prints")
    of_print = _groups(prints, max_bits, 2048)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "fp", "t", "r")
    first = prints.join(of_print, prints["fp"] == of_print["print"]).groupBy("root").agg(F.min(order).alias("first"))
    t, r = unused(marked, "_t"), unused(marked, "_r")
    stays = materialised(first.select(F.col("first.t").alias(t), F.col("first.r").alias(r)).distinct(), "stays")
    kept = marked.join(stays, (F.col(of_text) == F.col(t)) & (F.col(of_row) == F.col(r)), "left_semi")
    return kept.dropDuplicates([of_text, of_row]).drop(of_text, of_row)
