"""Language identification of texts that may mix languages.

Each language is a distribution over hashed byte trigrams of lower-cased letters.  A text is
explained as a mixture of languages: expectation-maximisation finds the proportions, and a
language joins the set only if it raises the likelihood by more than a penalty.  What the
languages explain worse than trigrams drawn at random is left to none of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.llm.arrow import sliced, values
from quotelake.llm.scratch import unused

BINS = 1 << 16
MAX_LANGUAGES = 256  # bounds the model at 64 MB of single-precision numbers
BACKOFF = 0.02  # weight of the common distribution in each language's
ROUNDS = 12
PENALTY = 8.0  # per language beyond the first, times the logarithm of the trigrams
PRIOR = 5.0  # trigrams' worth of doubt in a score
UNDETERMINED = "und"
_LETTERS = bytes(c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))
_LETTER = regex.compile(r"\p{L}")


def trigrams(text: str) -> np.ndarray:
    """The hashed trigrams of a text's letters, with one space on each side of a run."""
    runs = text.lower().encode().translate(_LETTERS).split()
    b = np.frombuffer(b" " + b" ".join(runs) + b" ", np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, np.int64)
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


@dataclass
class Model:
    languages: list[str]
    likelihood: np.ndarray  # bins x languages

    def mixture(self, text: str | None) -> dict[str, float]:
        """The proportions of the languages that a text is written in; none without a letter.

        They add up to less than one by the share of the text that is in no learned language.
        """
        if not text or not self.languages or not _LETTER.search(text):
            return {}
        bins, n = np.unique(trigrams(text), return_counts=True)
        if not len(bins):
            return {}
        p, total = self.likelihood[bins], n.sum()
        alone = n @ np.log(p)
        best = int(np.argmax(alone))
        share, _ = _fit(p, n)
        ranked = [best, *(i for i in np.argsort(-share, kind="stable").tolist() if i != best)]
        chosen, reached = [best], alone[best]
        for m in range(2, len(ranked) + 1):
            _, level = _fit(p[:, ranked[:m]], n)
            if level - reached <= PENALTY * np.log(total):
                break
            chosen, reached = ranked[:m], level
        weight, _ = _fit(np.column_stack((p[:, chosen], np.full(len(p), 1 / BINS))), n)  # the last one: no language
        return {self.languages[i]: float(w) for i, w in zip(chosen, weight)}

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """The language with the largest proportion; that proportion, less in short texts; the proportion of no learned language.

        A text of which most is in no learned language has the best of them all the same,
        with a low score.
        """
        found = self.mixture(text)
        if not found:
            return UNDETERMINED, 0.0, 1.0
        language = max(found, key=lambda k: (found[k], k))
        n = len(trigrams(text))
        score = (found[language] * n + PRIOR / (len(self.languages) + 1)) / (n + PRIOR)
        return language, min(1.0, score), max(0.0, 1 - sum(found.values()))


def _fit(p: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, float]:
    """Proportions that maximise the likelihood of trigrams seen ``n`` times, and its logarithm."""
    weight = np.full(p.shape[1], 1 / p.shape[1])
    total = n.sum()
    for _ in range(ROUNDS):
        weight = weight * ((n / (p @ weight)) @ p) / total
    return weight, float(n @ np.log(p @ weight))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in sliced(batches):
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = counts.setdefault(lang, np.zeros(BINS, np.int64))
            bins, n = np.unique(trigrams(text), return_counts=True)
            own[bins] += n
    for lang, own in counts.items():
        bins = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(bins), pa.string()), pa.array(bins.astype(np.int32)), pa.array(own[bins])], ["lang", "bin", "n"])


def train(texts: DataFrame) -> Model:
    """Fit on all rows of ``texts`` (lang, text) without a null.

    More than 256 languages are an error, found before anything is counted.  Counting is a
    grouped sum; the driver receives at most 2**16 sums per language.
    """
    rows = texts.select("lang", "text").dropna()
    names = sorted(r[0] for r in rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    sums = rows.mapInArrow(_count, "lang string, bin int, n bigint").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    table = sums.toArrow()
    lang, bins, n = table["lang"].combine_chunks().dictionary_encode(), table["bin"].to_numpy(), table["n"].to_numpy()
    place = lang.indices.to_numpy()
    common = (np.bincount(bins, n, BINS) + 1) / (n.sum() + BINS)
    likelihood = np.empty((BINS, len(names)), np.float32)
    found = {x: i for i, x in enumerate(lang.dictionary.to_pylist())}
    for i, name in enumerate(names):  # one language at a time in double precision
        own = place == found.get(name, -1)
        counts = np.bincount(bins[own], n[own], BINS)
        likelihood[:, i] = (1 - BACKOFF) * counts / max(counts.sum(), 1) + BACKOFF * common
    return Model(names, likelihood)


def identify(spark: SparkSession, model: Model, text: Column) -> Column:
    """A struct (lang_pred, score, unknown) for each text."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("lang_pred string, score double, unknown double")
    def predict(texts: pa.Array) -> pa.Array:
        found = [shared.value.predict(t) for t in values(texts)]
        columns = [pa.array([r[i] for r in found], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.float64()))]
        return pa.StructArray.from_arrays(columns, ["lang_pred", "score", "unknown"])

    return predict(text)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training; a document without id is."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def identified(docs: DataFrame, name: str = "_found") -> DataFrame:
    """``docs`` with a struct ``name`` (lang_pred, score, unknown), learned from its rows that are not held out.

    ``unknown`` is the proportion of the text that is in no learned language.  Null texts and
    texts without a letter are ``und`` with score 0, as is everything if no row has a language.
    Ties go to the first name.  Repeated rows count as often as they occur.
    """
    model = train(docs.filter(~held_out(F.col("doc_id"))))
    return docs.withColumn(name, identify(docs.sparkSession, model, F.col("text")))


def keep_identified(docs: DataFrame, min_score: float = 0.3) -> DataFrame:
    """The rows whose text has a language that makes up at least ``min_score`` of it, and no less than no language does."""
    name = unused(docs, "_found")
    lang, score, unknown = (F.col(name)[c] for c in ("lang_pred", "score", "unknown"))
    return identified(docs, name).filter((lang != UNDETERMINED) & (score >= min_score) & (score >= unknown)).drop(name)
