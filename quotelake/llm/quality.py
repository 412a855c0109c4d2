"""A quality score: logistic regression on hashed word n-grams, trained by FTRL.

Words and runs of marks are features, alone and in pairs.  Training shards follow the
regularised leader side by side from one state, which is averaged after each round.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.llm.arrow import sliced, values
from quotelake.llm.langid import held_out
from quotelake.llm.scratch import materialised
from quotelake.llm.words import mix

BITS = 18
SHARDS = 8
ROUNDS = 4
ALPHA, BETA, L1, L2 = 1.5, 1.0, 0.01, 0.001
_TOKEN = re.compile(rb"[a-z0-9\x80-\xff]+|[^\sa-z0-9\x80-\xff]+")
_SAME = np.uint64(0x5851F42D4C957F2D)  # stands for the pair of a word with itself
_MASK = np.uint64((1 << BITS) - 1)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Bins and values, of length one in all; bin 0 is the constant."""
    tokens = _TOKEN.findall(text.lower().encode()) if text else []
    h = mix(np.fromiter(map(zlib.crc32, tokens), np.uint64, len(tokens)))
    pairs = np.where(h[1:] == h[:-1], _SAME, mix(h[:-1] * np.uint64(3) + h[1:]))
    bins, n = np.unique(np.concatenate((h, pairs)) & _MASK, return_counts=True)
    value = n / np.sqrt(np.maximum((n * n).sum(), 1))
    return np.concatenate(([0], bins.astype(np.int64))), np.concatenate(([1.0], value))


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def _sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -35, 35))))


def _follow(batches: Iterator[pa.RecordBatch], state: Broadcast) -> Iterator[pa.RecordBatch]:
    """One shard's pass: the touched coordinates of its state."""
    z, n = state.value[0].copy(), state.value[1].copy()
    seen = np.zeros(len(z), bool)
    for batch in sliced(batches):
        for label, bins, value in zip(*(batch.column(i).to_pylist() for i in range(3))):
            i, x = np.array(bins), np.array(value)
            w = _weights(z[i], n[i])
            g = (_sigmoid(w @ x) - label) * x
            step = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA
            np.add.at(z, i, g - step * w)
            np.add.at(n, i, g * g)
            seen[i] = True
    at = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(z[at]), pa.array(n[at])], ["bin", "z", "n"])


def train(texts: DataFrame) -> np.ndarray:
    """Weights by bin, from ``texts`` (label 0 or 1, text, order); without rows all are zero.

    The rows must be a bounded sample: they are dealt to a fixed number of shards.  The
    driver holds one state of 2**18 pairs.
    """
    spark = texts.sparkSession

    @F.arrow_udf("bins array<int>, value array<double>")
    def encode(texts: pa.Array) -> pa.Array:
        rows = [features(t) for t in values(texts)]
        columns = [pa.array([r[0] for r in rows], pa.list_(pa.int32())), pa.array([r[1] for r in rows], pa.list_(pa.float64()))]
        return pa.StructArray.from_arrays(columns, ["bins", "value"])

    rows = texts.select("label", "order", encode("text").alias("x")).select("label", "x.bins", "x.value", "order")
    rows = materialised(rows, "features")
    state = np.zeros((2, 1 << BITS))
    for _ in range(ROUNDS):
        shared = spark.sparkContext.broadcast(state)
        passes = (
            rows.repartitionById(SHARDS, F.pmod("order", F.lit(SHARDS)).cast("int"))
            .sortWithinPartitions("order")
            .select("label", "bins", "value")
            .mapInArrow(lambda b: _follow(b, shared), "bin int, z double, n double")
        )
        mean = passes.groupBy("bin").agg(F.avg("z").alias("z"), F.avg("n").alias("n")).toArrow()
        state = state.copy()
        state[:, mean["bin"].to_numpy()] = mean["z"].to_numpy(), mean["n"].to_numpy()
        shared.unpersist()
    return _weights(*state)


def score(spark: SparkSession, weights: np.ndarray, text: Column) -> Column:
    """The probability of label 1 for each text; an empty one has the constant alone."""
    shared = spark.sparkContext.broadcast(weights)

    @F.arrow_udf("double")
    def of(texts: pa.Array) -> pa.Array:
        w = shared.value
        return pa.array([_sigmoid(w[i] @ x) for i, x in map(features, values(texts))], pa.float64())

    return of(text)


def training_rows(docs: DataFrame, labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """(label, text, order): about ``max_rows`` labelled documents that are not held out, chosen by a hash of the id."""
    known = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("label")).filter(
        F.col("_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("_id"))
    )
    share = min(1.0, max_rows / max(1, known.count()))
    order = F.xxhash64("_id", F.lit(7))
    chosen = known.withColumn("order", order).filter(F.pmod("order", F.lit(1_000_003)) < share * 1_000_003)
    # at most about max_rows small rows, so they go to every task rather than all texts to them
    return docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("label", "text", "order")


def scored(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = 0.3, max_rows: int = 16_000) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs`` (doc_id, text).

    Learns from about ``max_rows`` labelled rows of ``labels`` (doc_id, ``label``) at most.
    Null and empty texts get the constant's score; without labels every score is 0.5.
    Labels other than 0 and 1 are not used; a repeated label counts again.  Other columns
    are ignored, repeated rows come back as often as they occur.
    """
    weights = train(training_rows(docs, labels, label, max_rows))
    found = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(docs.sparkSession, weights, F.col("text")).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
