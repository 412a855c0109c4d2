"""HTML text, archives, token shards and the pipeline."""

import io
import random
import zlib

import numpy as np
import pytest

from quotelake.llm import htmltext, tokens, warc

PARA = "This is an ordinary paragraph of an article with enough words to be taken as content by any measure. "


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var x='</p>';</script></head><body>{body}</body></html>"


@pytest.mark.parametrize(
    "html,want",
    [
        (None, ""),
        ("", ""),
        ("plain words only", "plain words only"),
        (page(f"<nav><ul><li><a href='/'>Home</a></li></ul></nav><article><h1>Title</h1><p>{PARA}<p>Short.</p><p>{PARA * 2}</article><footer>&copy; me</footer>"), f"Title\n{PARA.strip()}\nShort.\n{(PARA * 2).strip()}"),
        (page(f"<div class='cookie-notice'>{PARA}</div><main><p>a &amp; b&nbsp;c &lt;d&gt; {PARA}</p></main><section id='comments'><p>{PARA * 3}</p></section>"), f"a & b c <d> {PARA.strip()}"),
        (page(f"<div id='menu'><a href='/a'>one</a></div><div class='content'><p>{PARA}</p><p>{PARA}</p><p>Yes.</p></div><aside>{PARA}</aside><form><label>Name</label></form>"), f"{PARA.strip()}\n{PARA.strip()}\nYes."),
        (page(f"<article><p>{PARA}</p><div class='ad'>Buy {PARA}</div><p>line one<br>line two {PARA}</p></article>"), f"{PARA.strip()}\nline one line two {PARA.strip()}"),
        (f"<article><p>{PARA}</p><p>cut off &am", f"{PARA.strip()}\ncut off &am"),
    ],
)
def test_main_text(html, want):
    assert htmltext.main_text(html) == want


ARTICLE = f"<h1>Head</h1><p>{PARA}</p><p>{PARA * 2}</p><p>Short.</p>"
TEXT = f"Head\n{PARA.strip()}\n{(PARA * 2).strip()}\nShort."
TEASER = f"<article><h2>Other</h2><p>{PARA[:60]}</p></article>"


@pytest.mark.parametrize(
    "body",
    [
        f"<div class='layout no-sidebar'>{ARTICLE}</div>",
        f"<div class='post with-header'>{ARTICLE}</div>",
        f"<div id='page' class='has-comments'>{ARTICLE}</div><p>foot</p>",
        f"<article class='post share-enabled'>{ARTICLE}</article><p>{PARA}</p>",
        f"<div class='sidebar'>{ARTICLE}</div>",  # a name does not outweigh the headline
        f"<div class='headline'><h1>Head</h1></div><div class='body'><p>{PARA}</p><p>{PARA * 2}</p><p>Short.</p></div>",
        f"<article><div class='post-header'><h1>Head</h1></div><p>{PARA}</p><p>{PARA * 2}</p><p>Short.</p></article>",
        f"<article>{ARTICLE}<div class='user-feedback'><p>{PARA * 3}</p></div></article>",
        f"<article>{ARTICLE}<section class='comment-list'><article class='comment'><p>{PARA * 3}</p></article></section></article>",
        f"<main>{ARTICLE}{TEASER * 2}</main>",
        f"<main><article>{ARTICLE}</article>{TEASER * 2}</main>",
        f"<article>{ARTICLE}</article>{TEASER * 3}",
        f"<div class='sidebar-left'><p>{PARA * 2}</p></div><div class='x'>{ARTICLE}</div><ul><li><a href='/1'>one two three</a></li><li><a href='/2'>more</a></li></ul>",
        f"<section class='comments'><article class='comment'><p>{PARA * 4}</p></article></section><div>{ARTICLE}</div>",
        f"<div class='x'>{ARTICLE}</div><div class='y'>" + "".join(f"<div><b>{i}</b> <i>unit</i></div>" for i in range(12)) + "</div>",
    ],
)
def test_articles_of_raw_pages(body):
    html = page(f"<header><a href='/'>Site</a></header><nav><ul><li><a href='/'>Home</a></li></ul></nav>{body}<footer>foot line of the page</footer>")
    assert htmltext.main_text(html) == TEXT


def test_the_clusters_decide(monkeypatch):
    body = f"<div class='x'>{ARTICLE}</div><div class='y'>" + "".join(f"<div><b>{i}</b> <i>unit</i></div>" for i in range(40)) + "</div>"
    assert htmltext.main_text(page(body)) == TEXT
    monkeypatch.setattr(htmltext, "content_lines", lambda ratios: np.ones(len(ratios), bool))
    assert htmltext.main_text(page(body)) != TEXT


def test_clusters_against_plain_arithmetic():
    rng = random.Random(4)
    for _ in range(50):
        ratios = [rng.choice([0, 1, 3, 40, 200]) * rng.random() for _ in range(rng.randrange(1, 60))]
        weights = [2.718281828459045 ** (-(d * d) / 2) for d in range(-3, 4)]
        at = lambda i: ratios[i] if 0 <= i < len(ratios) else 0.0
        smooth = [sum(w * at(i + d) for d, w in zip(range(-3, 4), weights)) / sum(weights) for i in range(len(ratios))]
        mean = sum(smooth) / len(smooth)
        cut = mean
        for _ in range(20):
            high, low = [x for x in smooth if x > cut], [x for x in smooth if x <= cut]
            if not high or not low:
                break
            cut = (sum(high) / len(high) + sum(low) / len(low)) / 2
        spread = (sum((x - mean) ** 2 for x in smooth) / len(smooth)) ** 0.5
        near = [abs(x - min(cut, spread)) < 1e-9 for x in smooth]
        got = htmltext.content_lines(np.array(ratios))
        assert all(n or g == (x >= min(cut, spread)) for g, x, n in zip(got.tolist(), smooth, near))


def test_pages_keep_their_rows(spark):
    rows = [(1, "u", page(f"<article><p>é{PARA}</p></article>"), "x"), (1, "u", None, "x"), (None, None, "", "x"), (2, "u", "<p>" * 5000 + PARA * 2000, "x")]
    got = htmltext.extracted(spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")).collect()
    assert len(got) == 4 and all(r.n_chars == len(r.text) for r in got)
    assert htmltext.extracted(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_archives_round_trip(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, f"http://x/{i}", rng.choice(["same é", "", None, "x" * 200_000, f"own {i}", "a\r\n\r\nb"]), "z") for i in range(80)]
    rows += [(79, "http://again", rows[79][2], "z"), (None, "http://none", "same é", "z"), (None, None, "alone", "z")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, _key string")
    files = warc.write_archives(pages, str(tmp_path / "a"))
    got = warc.read_archives(files).collect()
    largest = {}
    for i, _, h, _ in rows:
        largest[h or ""] = max((x for x in (largest.get(h or ""), i) if x is not None), default=None)
    want = []
    for i, url, h, _ in rows:
        data, first = (h or "").encode(), largest[h or ""]
        refers = first if first is not None and i != first else None
        want.append((i, url or "", len(data), warc.digest(data), "revisit" if refers is not None else "response", refers))
    assert sorted(((r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == sorted(want, key=str)
    assert all(warc.digest(bytes(r.payload)) == r.payload_digest for r in got if r.record_type == "response")
    alone = warc.read_archives(warc.write_archives(pages, str(tmp_path / "b"), min_bytes=1000)).collect()
    assert all(r.payload_bytes >= 1000 for r in alone if r.record_type == "revisit")
    empty = warc.write_archives(pages.limit(0), str(tmp_path / "c"))
    assert warc.read_archives(empty).count() == 0


def test_damage_is_noticed():
    data = warc.member(1, "u", b"payload" * 50, None) + warc.member(2, "u", b"second", None)
    assert [f["warc-record-id"] for f, _ in warc.records(io.BytesIO(data).read)] == ["<urn:page:1>", "<urn:page:2>"]
    for at in (len(data) - 3, 100):
        with pytest.raises(warc.Corrupt):
            list(warc.records(io.BytesIO(data[:at]).read))
    raw = zlib.decompress(warc.member(1, "u", b"payload", None), 31).replace(b"payload", b"pay1oad")
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    with pytest.raises(warc.Corrupt):
        list(warc.records(io.BytesIO(squeeze.compress(raw) + squeeze.flush()).read))


@pytest.mark.parametrize("size", [1, 2, 3, 17, 1000, 4097])
def test_permutation(size):
    got = tokens.permute(np.arange(size), size, 7)
    assert sorted(got.tolist()) == list(range(size))
    assert size < 100 or got.tolist() != tokens.permute(np.arange(size), size, 8).tolist()


def test_shards_round_trip(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choices(["alpha", "béta", "<|endoftext|>", "x" * 40], k=rng.choice([0, 3, 50, 900]))), "s") for i in range(70)]
    rows += [(5, rows[5][1], "s"), (None, "no id at all", "s"), (300, None, "s")]
    spark.createDataFrame(rows, "doc_id bigint, text string, shard string").repartition(3).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    folder = str(tmp_path / "shards")
    index = sorted(tokens.write_shards(docs, folder, length=64, shards=5).collect(), key=lambda r: r.slot)
    assert [r.slot for r in index] == list(range(len(index)))
    encode = tokens.encoding(tokens.load_ranks(tokens.VOCABULARY)).encode_ordinary
    total = sum(len(encode(t)) + 1 for _, t, _ in rows if t)
    assert sum(r.n_tokens for r in index) == total
    back = tokens.read_shards(spark, folder, length=64).collect()
    read = {r.slot: r.tokens for r in back}
    assert {r.slot: r.n_tokens for r in back} == {r.slot: r.n_tokens for r in index}
    for r in index:
        assert len(read[r.slot]) == 64 and set(read[r.slot][r.n_tokens :]) <= {50256}
        assert zlib.crc32(np.array(read[r.slot], "<u2").tobytes()) == r.crc32
    some = {r.slot: r.tokens for r in tokens.read_shards(spark, folder, length=64, first_slot=7, count=9).collect()}
    assert some == {s: read[s] for s in range(7, 16)}
    # in scan order the sequences of a partition are its texts, one after another
    texts = sorted([50256 if x is None else x for t in (encode(t) + [None] for _, t, _ in rows if t) for x in t])
    assert sorted(x for r in index for x in read[r.slot][: r.n_tokens]) == texts
    seen = {d for r in index for d in r.doc_ids}
    assert seen == {i for i, t, _ in rows if t}
    again = tokens.write_shards(docs, str(tmp_path / "again"), length=64, shards=5).collect()
    assert sorted(map(tuple, [(r.slot, r.crc32) for r in again])) == [(r.slot, r.crc32) for r in index]
    assert tokens.write_shards(docs.limit(0), str(tmp_path / "none"), length=64).count() == 0
    path = next((tmp_path / "shards").glob("shard-*.bin"))
    path.write_bytes(path.read_bytes()[:-2] + b"\x01\x01")
    with pytest.raises(Exception, match="damaged"):
        tokens.read_shards(spark, folder, length=64).collect()


def test_sequences_have_the_slots_of_the_permutation(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(["alpha", "béta", "gamma"], k=rng.choice([3, 40, 200])))) for i in range(90)]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    parts = [[r.text for r in part] for part in docs.rdd.glom().collect()]
    encode = tokens.encoding(tokens.load_ranks(tokens.VOCABULARY)).encode_ordinary
    placed = []
    for p, some in enumerate(parts):
        stream = [x for t in some for x in [*encode(t), 50256]]
        sequences = [stream[i : i + 32] for i in range(0, len(stream), 32)]
        places = tokens.permute(np.arange(len(sequences), dtype=np.uint64) + np.uint64(p * tokens.PER_PARTITION), len(parts) * tokens.PER_PARTITION, 5)
        placed += zip(places.tolist(), sequences)
    tokens.write_shards(docs, str(tmp_path / "shards"), length=32, key=5, shards=4).collect()
    got = sorted(tokens.read_shards(spark, str(tmp_path / "shards"), length=32).collect(), key=lambda r: r.slot)
    assert [r.tokens[: r.n_tokens] for r in got] == [s for _, s in sorted(placed)]


def test_long_blanks_have_the_ids_of_an_uncut_text(monkeypatch):
    codec = tokens.encoding(tokens.load_ranks(tokens.VOCABULARY))
    monkeypatch.setattr(tokens, "_RUN", tokens.re.compile(tokens._RUN.pattern.replace("10000", "5")))
    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choice(["a", "Bé", "1", "'s", "!", "\u0301", " " * rng.randrange(12), "\n" * rng.randrange(9), "\t\u00a0\u3000" * 3]) for _ in range(12))
        assert tokens.encode(codec, text) == codec.encode_ordinary(text), repr(text)


def test_a_text_of_blanks_is_written(spark, tmp_path):
    rows = [(1, "a" + " " * 5_000_000 + "b"), (2, "\n" * 2_000_000), (3, "plain")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "docs"))
    index = tokens.write_shards(spark.read.parquet(str(tmp_path / "docs")), str(tmp_path / "shards"))
    assert {d for r in index.collect() for d in r.doc_ids} == {1, 2, 3}


def test_stages_keep_columns_of_any_name(spark, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    names = "_id _hash _print _found _pass _pass_ _source _whole _last _text _row _t _r t r fp node root component_id fingerprint text_hash item_id key s n_words score".split()
    rows = [(i, f"w{i} and some more plain words of text {i % 7} " * 3, "en", "ab"[i % 2]) for i in range(30)]
    rows += [(None, None, None, None), (31, "", "en", "a"), (5, rows[5][1], "en", "b")]
    docs = spark.createDataFrame([(*r, *names) for r in rows], "doc_id bigint, text string, lang string, source string, " + ", ".join(f"{n} string" for n in names))
    spark.createDataFrame(docs.collect(), docs.schema).write.parquet(str(tmp_path / "docs"))
    last = corpus_pipeline.STAGES[-1][1](spark, spark.read.parquet(str(tmp_path / "docs")), "/root/testdata/sf0.001")
    assert {d for r in last.collect() for d in r.doc_ids} == {r[0] for r in rows if r[1]}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, "/root/testdata/sf0.001")
        assert got.schema.names == docs.schema.names, name
        found = got.collect()
        assert found and all(list(r)[4:] == names for r in found), name


def test_pipeline_stages(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    bench = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf).collect(), docs.schema)
        assert docs.columns == columns, name
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        assert now <= before
        before = now
    assert not any(b in r.text for r in docs.collect() for b in bench)
    assert docs.select("text").distinct().count() == len(before)
    rows = corpus_pipeline.run(spark, sf)
    assert {d for r in rows.collect() for d in r.doc_ids} == before
