"""The operators over the documents, pages, labels and benchmark tables, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.catalog import table
from quotelake.llm import bpe, decontam, fim, hostrules, htmltext, langid, mixing, periodic, quality, simhash, substrings, tokens, warc


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), k=4, max_bits=4)


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return langid.identified(docs).select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "_found.lang_pred", "_found.score")


MIX_REPETITION = 1.5


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Draw as many tokens as there are, with no source passed more than one and a half times."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    budget = docs.agg(F.sum(mixing.n_words(F.col("text")))).first()[0] or 0
    drawn = mixing.mixed(docs, mixing.Mix(repetition=MIX_REPETITION, budget=int(budget)))
    return drawn.select("doc_id", "source", mixing.n_words(F.col("text")).alias("n_words"), F.col("_pass").alias("pass"))


def op4_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hostrules.host_verdicts(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "cosine", "lcs_share")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extracted(table(spark, sf_dir, "pages"))


def op8_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.write_shards(table(spark, sf_dir, "documents"), tokens.shard_folder(spark))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc.write_archives(table(spark, sf_dir, "pages"), warc.archive_folder(spark))
    return warc.read_archives(files, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeat_digests(table(spark, sf_dir, "documents"), k=13)


def _times_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a tenth of the texts made periodic from a word on, as their ids say."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    h = F.coalesce(F.crc32(F.col("doc_id").cast("string")), F.lit(1))
    words = F.when(h % 10 == 0, F.regexp_extract_all(F.col("text"), F.lit(mixing.WORD), F.lit(0)))
    g = F.floor(h / 10)
    n, a, p = F.col("n"), F.col("a"), F.col("p")
    cut = docs.select("doc_id", "text", words.alias("w"), g.alias("g")).withColumn("n", F.size("w"))
    cut = cut.withColumn("a", F.when(n > 0, F.col("g") % n)).withColumn("p", 1 + F.floor((n - a) / (3 + F.col("g") % 8)))
    part = F.slice("w", (a + 1).cast("int"), p.cast("int"))
    again = F.flatten(F.array_repeat(part, F.ceil((n - a) / p).cast("int")))
    made = F.array_join(F.slice(F.concat(F.slice("w", F.lit(1), a.cast("int")), again), F.lit(1), n), " ")
    return cut.select("doc_id", F.when(n > 0, made).otherwise(F.col("text")).alias("text"))


def op11_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(_times_over(spark, sf_dir))
    # runs are sorted by start, then period, so the first of equal exponents stays
    better = lambda a, b: a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"])
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    best = F.reduce("runs", none, lambda a, b: F.when(better(a, b), b).otherwise(a))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256"
    )


BPE_VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.encoded(table(spark, sf_dir, "documents"), BPE_VOCABULARY, decoded=True)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return found.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fim.transformed(table(spark, sf_dir, "documents"))
    back = fim.restored(F.col("output"), F.col("form"))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_language": op2_language,
    "op3_mixing": op3_mixing,
    "op4_host_rules": op4_host_rules,
    "op5_quality": op5_quality,
    "op6_decontamination": op6_decontamination,
    "op7_html_text": op7_html_text,
    "op8_token_shards": op8_token_shards,
    "op9_warc": op9_warc,
    "op10_substrings": op10_substrings,
    "op11_periodic": op11_periodic,
    "op12_bpe": op12_bpe,
    "op13_fim": op13_fim,
}

# words of every text with their positions
_WORDS = r"""words AS (
  SELECT doc_id, source, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
)"""

ORACLE = {
    "op3_mixing": f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_words FROM documents
),
src AS (SELECT source, sum(n_words)::BIGINT AS t FROM d GROUP BY source),
budget AS (SELECT sum(t)::DOUBLE AS b, max(t)::DOUBLE AS top FROM src),
bisect(i, low, high) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT i + 1, CASE WHEN over THEN mid ELSE low END, CASE WHEN over THEN high ELSE mid END
  FROM (
    SELECT i, low, high, (low + high) / 2 AS mid,
      (SELECT max(b * pow(t / top, (low + high) / 2) / t) / sum(pow(t / top, (low + high) / 2)) FROM src, budget WHERE t > 0) > {MIX_REPETITION} AS over
    FROM bisect WHERE i < 40
  )
),
flat AS (SELECT max(b / t) / count(*) > {MIX_REPETITION} AS over FROM src, budget WHERE t > 0),
ex AS (SELECT CASE WHEN (SELECT over FROM flat) THEN round((SELECT high FROM bisect WHERE i = 40), 6) ELSE 0.0 END AS a),
z AS (SELECT sum(pow(t / top, a)) AS z FROM src, budget, ex WHERE t > 0),
plan AS (
  SELECT source, t, CASE WHEN t > 0 THEN floor(b * (pow(t / top, a) / z) / t * t + 1e-6)::BIGINT ELSE 0 END AS drawn FROM src, budget, ex, z
),
parts AS (SELECT source, CASE WHEN t > 0 THEN drawn // t ELSE 0 END AS whole, CASE WHEN t > 0 THEN drawn % t ELSE 0 END AS rest FROM plan),
keyed AS (
  SELECT d.*, whole, rest, md5('1|' || whole || '|' || coalesce(doc_id::VARCHAR, '') || '|' || coalesce(d.source, '')) AS k
  FROM d JOIN parts ON d.source IS NOT DISTINCT FROM parts.source
),
ahead AS (
  SELECT *, coalesce(sum(n_words) OVER (PARTITION BY source ORDER BY k RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0)
    - sum(n_words) OVER (PARTITION BY source, k) AS before FROM keyed
),
times AS (SELECT doc_id, source, n_words, whole + (before < rest)::INT AS n FROM ahead)
SELECT doc_id, source, n_words, unnest(range(0, n::BIGINT))::BIGINT AS pass FROM times
""",
    "op9_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT h, max(page_id) AS first FROM p GROUP BY h),
s AS (SELECT page_id, h, sha1(h) AS x, first FROM p JOIN g USING (h)),
b AS (
  SELECT *, list_transform(range(0, 8), lambda i: list_reduce(list_transform(range(1, 6), lambda j:
    (instr('0123456789abcdef', substr(x, (i * 5 + j)::BIGINT, 1)) - 1)::BIGINT), lambda a, c: a * 16 + c)) AS v FROM s
)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes,
  array_to_string(list_transform(v, lambda q: array_to_string(list_transform([32768, 1024, 32, 1], lambda m:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((q // m) % 32 + 1)::BIGINT, 1)), '')), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM b
""",
    "op4_host_rules": f"""
WITH {_WORDS},
wins AS (
  SELECT doc_id, i, array_to_string(w[i:i+4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM words)
),
twice AS (SELECT doc_id, g FROM wins GROUP BY ALL HAVING count(*) > 1),
spots AS (
  SELECT doc_id, count(DISTINCT i + j) AS n FROM wins JOIN twice USING (doc_id, g), range(0, 5) AS r(j) GROUP BY doc_id
),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT l) AS n
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents)
  WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id
),
m AS (
  SELECT doc_id, source, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(array_to_string(w, ''), '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(lines.n, 0)::BIGINT AS n_dup_lines, coalesce(spots.n, 0)::BIGINT AS n_repeat_words
  FROM words LEFT JOIN lines USING (doc_id) LEFT JOIN spots USING (doc_id)
),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
hosts AS (SELECT source, count(*) AS n, sum(base_failed::INT) AS f FROM b WHERE source IS NOT NULL GROUP BY source),
sums AS (
  SELECT sum(n)::DOUBLE AS t, sum(f) / sum(n) AS mean, sum(f * f / n::DOUBLE) AS squares, sum(n::DOUBLE * n) AS sizes, count(*) AS c FROM hosts
),
excess AS (
  SELECT mean, CASE WHEN mean > 0 AND mean < 1 THEN (squares - t * mean * mean) / (mean * (1 - mean)) - (c - 1) ELSE 0 END AS within,
    t - c - sizes / t + 1 AS room FROM sums
),
prior AS (
  SELECT mean, CASE WHEN room > 1e-9 AND within / room > 1e-12 THEN greatest(room / within - 1, 0) END AS s FROM excess
),
rates AS (SELECT source, CASE WHEN s IS NULL THEN mean ELSE (f + mean * s) / (n + s) END AS rate FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(rate <= 0.5, true) AS kept
FROM b LEFT JOIN rates USING (source)
""",
    "op10_substrings": f"""
WITH {_WORDS},
wins AS (
  SELECT doc_id, i, array_to_string(w[i:i+12], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM words)
),
first AS (SELECT g, min(doc_id) AS d FROM wins GROUP BY g),
gone AS (
  SELECT DISTINCT wins.doc_id, i + j AS p FROM wins JOIN first USING (g), range(0, 13) AS r(j) WHERE first.d < wins.doc_id
),
gone_list AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, len(coalesce(ps, []))::BIGINT AS n_removed,
  sha256(array_to_string(list_filter(w, lambda x, i: NOT list_contains(coalesce(ps, []), i)), ' ')) AS kept_sha256
FROM words LEFT JOIN gone_list USING (doc_id)
""",
    "op13_fim": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS s FROM documents),
h AS (
  SELECT doc_id, text, length(text)::BIGINT AS n, list_transform(range(0, 4), lambda i: ('0x' || substr(s, (1 + 8 * i)::BIGINT, 8))::BIGINT) AS h FROM d
),
c AS (
  SELECT doc_id, text, n, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
      WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM h
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text
    WHEN 'psm' THEN '<P>' || substr(text, 1, a) || '<S>' || substr(text, b + 1) || '<M>' || substr(text, a + 1, b - a)
    ELSE '<S>' || substr(text, b + 1) || '<P>' || substr(text, 1, a) || '<M>' || substr(text, a + 1, b - a) END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM c
""",
}
