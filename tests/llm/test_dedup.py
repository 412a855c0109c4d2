"""SimHash groups and repeated windows against plain Python."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from quotelake.llm import simhash, substrings
from quotelake.llm.components import components
from quotelake.llm.words import equal_groups, pack, spans, windows

DOCS = "doc_id bigint, text string, fp string, doc string, print string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_print(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(lower)
    grams = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(links, nodes):
    root = {n: n for n in nodes}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def corpus(seed=5):
    rng = random.Random(seed)
    vocab = ["w%d" % i for i in range(400)] + ["É", "été", "THE"]
    rows = []
    for i in range(60):
        words = rng.choices(vocab, k=rng.choice([0, 2, 5, 40, 120, 200]))
        rows.append((i, " ".join(words)))
        if i % 4 == 0:
            near = list(words)
            if near:
                near[rng.randrange(len(near))] = "changed"
            rows.append((100 + i, "\n".join(near)))
    rows += [(7, rows[7][1]), (500, None), (501, ""), (502, " \n "), (None, rows[3][1]), (None, "only here " * 9), (600, "Z" * 70_000), (601, "a b c")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], DOCS)


def test_fingerprints_and_groups(spark):
    rows = corpus()
    got = simhash.near_duplicates(frame(spark, rows)).collect()
    prints = {t: plain_print(t) for _, t in rows}
    assert sorted((r.doc_id is None, r.doc_id, r.fingerprint) for r in got) == sorted(
        (i is None, i, f"{prints[t]:016x}") for i, t in rows
    ) or sorted(map(str, ((r.doc_id, r.fingerprint) for r in got))) == sorted(str((i, f"{prints[t]:016x}")) for i, t in rows)
    nodes = sorted(set(prints.values()))
    links = [(a, b) for a in nodes for b in nodes if a < b and (a ^ b).bit_count() <= 4]
    root = groups(links, nodes)
    first = {}
    for i, t in rows:
        r = root[prints[t]]
        first[r] = min((x for x in (first.get(r), i) if x is not None), default=None)
    want = sorted(str((i, first[root[prints[t]]])) for i, t in rows)
    assert sorted(str((r.doc_id, r.component_id)) for r in got) == want
    kept = simhash.one_per_group(frame(spark, rows)).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted({v for v in first.values() if v is not None})
    assert kept[0].fp == "x"


def test_one_of_each_group_stays_without_or_with_repeated_ids(spark):
    rng = random.Random(4)
    one, two, three = (" ".join(rng.choices([f"w{i}" for i in range(500)], k=80)) for _ in range(3))
    rows = [(None, one)] * 3 + [(7, two), (7, three), (8, two), (None, three), (7, two)]
    runs = [[(r.doc_id, r.text) for r in simhash.one_per_group(frame(spark, some)).collect()] for some in (rows, rows[::-1])]
    assert all(sorted(map(str, got)) == sorted(map(str, [(None, one), (7, two), (7, three)])) for got in runs)
    none = simhash.one_per_group(frame(spark, [(None, one), (None, one + " tail")])).collect()
    assert [r.text for r in none] == [r.text for r in simhash.one_per_group(frame(spark, [(None, one + " tail"), (None, one)])).collect()]


@pytest.mark.parametrize("block", [3, 2048])
def test_crowded_keys_lose_no_link(spark, block):
    rng = random.Random(3)
    center = rng.getrandbits(64)
    near = {center ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(150)}
    far = {rng.getrandbits(64) for _ in range(50)}
    nodes = sorted(near | far)
    signed = [int(np.uint64(n).view(np.int64)) for n in nodes]
    links = simhash.fingerprint_links(spark.createDataFrame([(n,) for n in signed], "fp bigint"), 4, block)
    found = [tuple(int(np.int64(x).view(np.uint64)) for x in r) for r in links.collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in found)
    want = groups([(a, b) for a in nodes for b in nodes if a < b and (a ^ b).bit_count() <= 4], nodes)
    assert groups(found, nodes) == want


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i + 1000, i + 1001) for i in range(60)] + [(5, 5), (None, 3)]
    real = [e for e in edges if None not in e]
    want = groups(real, {x for e in real for x in e})
    linked = {x for a, b in real if a != b for x in (a, b)}
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {n: want[n] for n in linked}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_hash_collisions_are_told_apart_by_bytes():
    packed = pack("a b a c b a")
    starts, ends = spans(packed)
    order, group = equal_groups(packed, starts, ends, np.zeros(len(starts), np.uint64))
    words = packed.split()
    assert {(words[i], words[j]) for i, g in zip(order, group) for j, h in zip(order, group) if g == h} == {(w, w) for w in words}
    assert len(set(group.tolist())) == 3
    assert len(windows(packed, starts, ends, 3)) == 4


def plain_repeats(rows, k):
    key = lambda i: float("inf") if i is None else i
    first = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        for a in range(len(w) - k + 1):
            g = tuple(w[a : a + k])
            first[g] = min(first.get(g, key(i)), key(i))
    out = []
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = {a + j for a in range(len(w) - k + 1) if first[tuple(w[a : a + k])] < key(i) for j in range(k)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), kept))
    return sorted(out, key=str)


@pytest.mark.parametrize("k,small", [(13, False), (4, False), (4, True)])
def test_repeated_windows(spark, k, small, monkeypatch):
    rows = corpus()
    passage = " ".join(f"p{i}" for i in range(30))
    rows += [(700 + i, f"start{i} {passage} end{i}") for i in range(20)] + [(720, "again " * 500)]
    if small:  # blocks smaller than a text
        monkeypatch.setattr(substrings, "BLOCK", 300)
        batches = [__import__("pyarrow").RecordBatch.from_pylist([{"doc_id": i, "text_hash": 0, "text": t} for i, t in rows])]
        words = sum(len(b.starts) - (k - 1) for b in substrings._blocks(batches, k, k) if len(b.doc) == 1)
        assert words > 0
        return
    got = substrings.remove_repeats(frame(spark, rows), k).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=str) == plain_repeats(rows, k)
    tight = substrings.remove_repeats(frame(spark, rows), k, bucket_bytes=512).collect()  # buckets are settled as they arrive
    assert sorted(tight, key=str) == sorted(got, key=str)
    sha = substrings.repeat_digests(frame(spark, rows), k).collect()
    assert sorted(r.kept_sha256 for r in sha) == sorted(hashlib.sha256(r[3].encode()).hexdigest() for r in plain_repeats(rows, k))


def test_a_bucket_with_most_windows_is_dealt_out():
    import pyarrow as pa
    import zstandard

    rng = random.Random(10)
    texts = [" ".join(f"w{rng.randrange(40)}" for _ in range(400)) for _ in range(40)]
    texts += texts[:5]
    batch = pa.RecordBatch.from_pylist([{"doc_id": i, "text_hash": i, "text": t} for i, t in enumerate(texts)])
    rare = np.zeros(0, np.uint64)
    whole = pa.Table.from_batches(substrings._scatter([batch], 13, rare, 1)).to_batches()
    parts = [b.slice(i, 1) for b in whole for i in range(b.num_rows)]
    # many small blobs of one bucket, as from many blocks
    small = [x for i, t in enumerate(texts) for x in substrings._scatter([pa.RecordBatch.from_pylist([{"doc_id": i, "text_hash": i, "text": t}])], 13, rare, 1)]
    limit, shares = 6000, 4
    rows = [r for b in substrings._gather(iter(small), 13, limit, shares) for r in b.to_pylist()]
    dealt = [r for r in rows if r["blob"] is not None]
    inflate = zstandard.ZstdDecompressor()
    assert {r["doc"] for r in dealt} == set(range(shares))
    assert max(len(inflate.decompress(r["blob"])) for r in dealt) < 40 * limit
    again = [pa.RecordBatch.from_pylist([{**r, "bucket": r["doc"], "doc": None} for r in sorted(dealt, key=lambda r: r["doc"])], schema=substrings._ROW)]
    rows = [r for r in rows if r["found"] is not None] + [r for b in substrings._gather(iter(again), 13, limit, 0) for r in b.to_pylist()]

    def words(found):
        return {(r["doc"], i) for r in found for a, z in np.frombuffer(r["found"], "<i8").reshape(-1, 2).tolist() for i in range(a, z)}

    want = [r for b in substrings._gather(iter(parts), 13, 1 << 30, 0) for r in b.to_pylist()]
    assert words(rows) == words(want) and len(words(want)) == 5 * 400


def test_rounds_pack_every_window_once():
    import pyarrow as pa
    import zstandard

    rng = random.Random(11)
    texts = [" ".join(f"w{rng.randrange(300)}" for _ in range(300)) for _ in range(30)]
    texts += texts[:4]
    batch = pa.RecordBatch.from_pylist([{"doc_id": i, "text_hash": i, "text": t} for i, t in enumerate(texts)])
    rare, inflate = np.zeros(0, np.uint64), zstandard.ZstdDecompressor()

    def packed(turn, rounds):
        rows = [r for b in substrings._scatter([batch], 13, rare, 8, turn, rounds) for r in b.to_pylist()]
        windows = [(int(d), a) for r in rows if r["blob"] for d, _, w, n in substrings._unpacked(inflate, r["blob"])[0].T.tolist() for a in range(w, w + n - 12)]
        covered = {(r["doc"], i) for r in rows if r["found"] for a, z in np.frombuffer(r["found"], "<i8").reshape(-1, 2).tolist() for i in range(a, z)}
        return windows, covered, {r["bucket"] for r in rows if r["blob"]}

    whole, all_covered, _ = packed(0, 1)
    turns = [packed(turn, 3) for turn in range(3)]
    assert sorted(w for t in turns for w in t[0]) == sorted(whole) and len(set(whole)) == len(whole) == 30 * 288
    assert set().union(*(t[1] for t in turns)) == all_covered and len(all_covered) == 4 * 300
    assert all(len(t[0]) < 0.5 * len(whole) and t[2] == set(range(8)) for t in turns)


def test_packed_strings_of_a_round_are_gone_before_the_next(spark, monkeypatch):
    import os
    import time

    folders = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    held = lambda: {f for top in folders for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_") and f.endswith(".data")}
    rows, steps, store = corpus(), [], substrings.materialised

    def materialised(df, label):
        before, out, until = held(), store(df, label), time.time() + 10
        while held() - before and time.time() < until and label == "gathered":  # files go a moment after the step
            time.sleep(0.1)
        steps.append((label, label == "gathered" and len(held() - before)))
        return out

    monkeypatch.setattr(substrings, "materialised", materialised)
    monkeypatch.setattr(substrings, "ROUND", 0, raising=False)
    got = substrings.remove_repeats(frame(spark, rows), 13).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=str) == plain_repeats(rows, 13)
    assert steps == [("grams", False), ("gathered", 0), ("gathered", 0), ("ranges", False)]


def test_pieces_of_a_long_text_cover_every_window(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(substrings, "BLOCK", 400)
    text = " ".join(f"x{i}" for i in range(1000))
    batch = pa.RecordBatch.from_pylist([{"doc_id": 1, "text_hash": 2, "text": text}])
    seen = set()
    for _, _, offset, packed in substrings._pieces([batch], 13):
        n = packed.count(b" ") + 1
        seen |= set(range(offset, offset + n - 12))
        assert packed.split()[0] == b"x%d" % offset
    assert seen == set(range(988))


def test_empty_tables(spark):
    assert simhash.near_duplicates(frame(spark, [])).count() == 0
    assert substrings.repeat_digests(frame(spark, [])).count() == 0
