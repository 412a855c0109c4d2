"""Periodic runs, BPE by chunks and fill-in-the-middle texts against plain Python."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from tokenizers import Tokenizer

from quotelake.llm import bpe, catalog, fim, periodic
from tests.oracle import compare

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, ids string, runs string, n string, output string, block string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows):
    return spark.createDataFrame([(*r, "i", "r", "n", "o", "b") for r in rows], DOCS)


def files(spark, tmp_path, rows):
    """The rows from a file, as operators that number their blocks need them."""
    path = str(tmp_path / "docs")
    frame(spark, rows).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def plain_runs(w):
    found = {}
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i - s + q >= max(24, 3 * q):
                found.setdefault((s, i - s + q), q)  # the smallest period comes first
            i += 1
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_collapse(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def periodic_text(rng):
    w = []
    for _ in range(rng.randrange(5)):
        unit = [str(rng.randrange(rng.choice([1, 2, 3, 50]))) for _ in range(rng.choice([1, 2, 3, 7, 8, 9, 15, 16, 17, 31, 33, 70]))]
        w += unit * rng.randrange(1, 8)
        w = w[: len(w) - rng.randrange(len(unit))]
    return w


def test_transform_is_exact():
    rng = np.random.default_rng(2)
    for b in (1, 2, 8, 64):
        blocks = rng.integers(0, 1 << 20, (5, b)).astype(np.uint64)
        windows = rng.integers(0, 1 << 20, (5, 2 * b)).astype(np.uint64)
        windows[0, :b] = blocks[0]
        want = [[sum((int(x) - int(y)) ** 2 for x, y in zip(blocks[r], windows[r, lag:])) % periodic.PRIME for lag in range(b)] for r in range(5)]
        assert periodic.squared_differences(blocks, windows).tolist() == want


def test_runs_of_many_texts_at_once():
    rng = random.Random(3)
    for _ in range(60):
        texts = [[w.encode() for w in periodic_text(rng)] for _ in range(rng.randrange(1, 6))]
        assert periodic.runs_of_texts(texts) == [plain_runs(t) for t in texts]


def test_long_blocks_are_searched_in_parts(monkeypatch):
    monkeypatch.setattr(periodic, "LONGEST", 16)
    rng = random.Random(4)
    for q in (17, 40, 100, 333):
        w = [str(rng.randrange(9)) for _ in range(50)] + [str(rng.randrange(9)) for _ in range(q)] * 4
        assert periodic.runs_of_texts([w]) == [plain_runs(w)]


def test_periodic_rows(spark):
    rng = random.Random(5)
    rows = [(i, "\n".join(periodic_text(rng))) for i in range(50)]
    rows += [(7, rows[7][1]), (None, "a b " * 40), (60, None), (61, ""), (62, " \t "), (63, "é日 " * 30), (64, "x y z " * 30_000), (65, "one " * 23), (66, "one " * 24)]
    got = periodic.periodic_runs(frame(spark, rows)).collect()
    want = []
    for i, t in rows:
        w = WORD.findall(t or "")
        runs = [(0, 90_000, 3)] if i == 64 else plain_runs(w)
        want.append(str((i, runs, plain_collapse(w, runs) if i != 64 else "x y z")))
    assert sorted(str((r.doc_id, [tuple(x) for x in r.runs], r.collapsed)) for r in got) == sorted(want)
    assert periodic.periodic_runs(frame(spark, []).limit(0)).count() == 0


def test_op11_against_plain(spark):
    got = {r.doc_id: r for r in catalog.op11_periodic(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    made = 0
    for doc, text in docs:
        w = WORD.findall(text or "")
        h, n = zlib.crc32(str(doc).encode()), len(w)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
            made += 1
        runs, r = plain_runs(w) if n < 4000 else None, got[doc]
        if runs is None:
            continue
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None, None, None))
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{x},{q}\n" for s, x, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(plain_collapse(w, runs).encode()).hexdigest()
    assert made > 5


def library():
    return Tokenizer.from_file(catalog.BPE_VOCABULARY)


def mixed_text(rng, n):
    words = ["the", "Häuser", "I'll", "naïve,", "x1--y!", "日本語", "ΣΑΣ", "e\u0301t\u00e9", "\u00a0", "İstanbul", "J\u030c", "<|endoftext|>", "a<|startoftext|>b", "<|ENDOFTEXT|>", "...", "\x1c", "ǆ", "ﬁn", "12,5%", "don't.", "A.B.", "THE?!"]
    return "".join(rng.choice(words) + rng.choice([" ", " ", "\n", "\t ", "  "]) for _ in range(n))


@pytest.fixture(scope="module")
def encoder():
    with open(catalog.BPE_VOCABULARY, encoding="utf-8") as file:
        return bpe.Encoder(file.read())


def test_texts_have_the_ids_of_the_library(encoder):
    rng, tokenizer = random.Random(6), library()
    texts = [mixed_text(rng, n) for n in (0, 1, 5, 40, 400)] + ["".join(rng.choices("aäé .,!'\u0301<|endoftext|>Iß", k=300)) for _ in range(200)]
    for t, ids in zip(texts, encoder.texts([t.encode() for t in texts])):
        assert ids.tolist() == tokenizer.encode(t, add_special_tokens=False).ids
    assert encoder.texts([]) == [] and [x.tolist() for x in encoder.texts([b"", b" "])] == [[], []]
    assert encoder.plain is not None
    alone = [x.tolist() for x in encoder.texts([t.encode() for t in texts])]
    with pytest.MonkeyPatch.context() as other:  # the way of tokenizers of another kind, and few known words
        other.setattr(encoder, "plain", None)
        other.setattr(bpe, "KEPT_WORDS", 10)
        assert [x.tolist() for x in encoder.texts([t.encode() for t in texts])] == alone


@pytest.mark.parametrize("left,right", [("one two thr", "ee four five"), ("one two ", "three"), ("word", "s and more"), ("x don", "'t y"), ("a e", "\u0301 b"), ("a <|endof", "text|> b"), ("", "a b"), ("a b", "")])
def test_joins_are_repaired(encoder, left, right):
    found = bpe.join(encoder, left.encode(), right.encode())
    chunks = encoder.texts([left.encode(), right.encode()])
    assert bpe.assemble(chunks, [found]).tolist() == encoder.whole(left + right).tolist()
    with pytest.raises(ValueError):
        bpe.assemble([chunks[0], np.concatenate(([9], chunks[1])).astype(encoder.dtype)], [bpe.Join(found.left, np.array([8], encoder.dtype), found.ids)])


def test_chunks_follow_content():
    rng = random.Random(7)
    body = " ".join(rng.choices(["alpha", "béta", "gamma"], k=9000)).encode()
    cut = lambda t: bpe.borders(np.frombuffer(t, np.uint8), bpe.ends(np.frombuffer(t, np.uint8)))
    pieces = lambda t: {t[a:b] for a, b in zip([0, *cut(t)], [*cut(t), len(t)])}
    assert b"".join(body[a:b] for a, b in zip([0, *cut(body)], [*cut(body), len(body)])) == body
    assert len(pieces(body) & pieces(b"Another beginning, " + body)) >= len(pieces(body)) - 2 > 5
    assert all(p.decode() for p in pieces(body))
    assert cut(b"x" * 100_000) == []


def test_encoded_rows(spark, tmp_path):
    rng, tokenizer = random.Random(8), library()
    shared = mixed_text(rng, 1500)
    rows = [(i, mixed_text(rng, rng.choice([0, 3, 60, 900])) + (shared if i % 3 == 0 else "") + mixed_text(rng, 5)) for i in range(60)]
    rows += [(5, rows[5][1]), (None, shared), (70, None), (71, ""), (72, " " * 500_000), (73, "x" * 200_000), (74, "ab " * 300_000)]
    docs = files(spark, tmp_path, rows)
    found = bpe.encoded(docs, catalog.BPE_VOCABULARY, decoded=True)
    assert found.filter(~found["decoded"].eqNullSafe(bpe.decoded(spark, found["ids"], catalog.BPE_VOCABULARY))).count() == 0
    found = found.drop("decoded")
    got = found.select("doc_id", "ids", bpe.decoded(spark, found["ids"], catalog.BPE_VOCABULARY).alias("text")).collect()
    want = []
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        want.append(str((i, ids, tokenizer.decode(ids, skip_special_tokens=False))))
    assert sorted(str((r.doc_id, list(r.ids), r.text)) for r in got) == sorted(want)
    assert bpe.encoded(docs.limit(0), catalog.BPE_VOCABULARY).count() == 0


def test_op12_against_the_library(spark):
    tokenizer = library()
    got = {r.doc_id: r for r in catalog.op12_bpe(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for doc, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        assert (got[doc].n_tokens, got[doc].ids_sha256, got[doc].decoded_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())


def test_tokenizers_that_keep_blanks_are_refused():
    with open("/opt/tokenizers/byte_bpe_50k.json", encoding="utf-8") as file, pytest.raises(ValueError):
        bpe.Encoder(file.read())


@pytest.mark.parametrize("text", ["", "abc", "é", "aé日b😀c", "日本" * 5, "<|x|>"])
def test_index_converts_both_ways(text):
    data = text.encode()
    index = fim.indexed(np.frombuffer(data, np.uint8))
    points = np.arange(len(text) + 1)
    offsets = index.to_bytes(points)
    assert index.points == len(text) and offsets.tolist() == [len(text[:i].encode()) for i in points]
    assert index.to_points(offsets).tolist() == points.tolist()
    inside = [len(data[:i].decode(errors="ignore")) + (i not in offsets) for i in range(len(data) + 1)]
    assert index.to_points(np.arange(len(data) + 1)).tolist() == inside


def plain_fim(doc, text, seed=1):
    digest = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    text, n = text or "", len(text or "")
    if not n or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_fim_rows(spark):
    rng = random.Random(9)
    rows = [(i, "".join(rng.choices("ab é日😀<SPM>\n", k=rng.choice([1, 2, 9, 300])))) for i in range(200)]
    rows += [(3, rows[3][1]), (None, "no id é"), (None, None), (300, None), (301, ""), (302, "a<P>b"), (303, "日" * 400_000), (304, "<S"), (305, "<P" * 9)]
    found = fim.transformed(frame(spark, rows))
    got = found.select("*", fim.restored(found["output"], found["form"]).alias("back")).collect()
    want = [str((i, *plain_fim(i, t), t or "")) for i, t in rows]
    assert sorted(str((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back)) for r in got) == sorted(want)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fim.transformed(frame(spark, []).limit(0)).count() == 0
    other = {r.doc_id: r.output for r in fim.transformed(frame(spark, rows[:50]), seed=2).collect()}
    assert all(other[i] == plain_fim(i, t, 2)[-1] for i, t in rows[:50])


def test_op13_matches_sql(spark):
    rows, problem = compare(catalog.op13_fim(spark, SF), catalog.ORACLE["op13_fim"], SF)
    assert problem is None and rows == 200, problem
