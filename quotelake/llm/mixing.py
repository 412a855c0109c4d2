"""Mixing sources by temperature.

Token shares are raised to an exponent between 0 (all sources alike) and 1 (as they are),
the largest that reaches a target entropy, or the smallest that keeps repetition within a limit.  The weights are
realised in whole passes over a source and one partial pass: documents are dealt to
blocks by a keyed hash, whole blocks are taken in order until the budget is met, and the
last block is cut inside.  So neither a source nor its blocks are sorted as a whole.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quotelake.llm.scratch import materialised, unused
from quotelake.session import local_rows

MAX_SOURCES = 200_000  # the driver holds one number for each
STEPS = 40
BLOCK_DOCS = 4096
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def weights(tokens: list[int], exponent: float) -> list[float]:
    """Normalised weights: token counts to the power of the exponent; a source without tokens has none."""
    top = max(tokens, default=0)
    raised = [(t / top) ** exponent if t else 0.0 for t in tokens]
    return [r / sum(raised) for r in raised] if top else raised


def entropy(w: list[float]) -> float:
    return -sum(x * math.log(x) for x in w if x > 0)


@dataclass
class Mix:
    """A target: ``entropy`` in nats, or ``repetition``, the most passes over any source.

    ``budget`` is the number of tokens to draw; None is the least with which every source is
    passed at least once.
    """

    entropy: float | None = None
    repetition: float | None = None
    budget: int | None = None

    def passes(self, tokens: list[int], exponent: float) -> list[float]:
        """How often each source is passed."""
        w = weights(tokens, exponent)
        rate = [x / t if t else 0.0 for x, t in zip(w, tokens)]
        budget = self.budget if self.budget is not None else 1 / min((r for r in rate if r), default=1.0)
        return [budget * r for r in rate]

    def exponent(self, tokens: list[int]) -> float:
        """Bisect: entropy falls, and repetition falls, as the exponent grows.  Rounded to a millionth."""
        if self.entropy is not None:
            too_low = lambda a: entropy(weights(tokens, a)) > self.entropy
        elif self.repetition is not None:
            too_low = lambda a: max(self.passes(tokens, a), default=0.0) > self.repetition
        else:
            return 1.0
        low, high = 0.0, 1.0
        if not too_low(low):
            return 0.0
        for _ in range(STEPS):
            middle = (low + high) / 2
            low, high = (middle, high) if too_low(middle) else (low, middle)
        return round(high, 6)


def _key(seed: int, part: Column) -> Column:
    """The place of a document in a pass of its source: 32 hexadecimal digits."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), part, F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("source", F.lit(""))))


def _cut_blocks(keyed: DataFrame, plan: DataFrame) -> DataFrame:
    """Per source the last block of which something is in the partial pass, and the tokens before it.

    Found digit by digit: sums of every prefix are made at once, and each of them is only set
    against the 15 others that differ in its last digit.  So no task holds a source's blocks.
    """
    blocks = keyed.groupBy("s", "block").agg(F.sum("n_words").alias("n"))
    prefixes = blocks.select("s", "n", "block", F.explode(F.expr("sequence(1, length(block))")).alias("level"))
    prefixes = prefixes.select("s", "level", F.expr("substr(block, 1, level - 1)").alias("parent"), F.expr("substr(block, 1, level)").alias("prefix"), "n")
    sums = prefixes.groupBy("s", "level", "parent", "prefix").agg(F.sum("n").alias("n"))
    ahead = F.sum("n").over(Window.partitionBy("s", "parent").orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1))
    sums = materialised(sums.select(F.col("s").alias("t"), "level", "parent", "prefix", F.coalesce(ahead, F.lit(0)).alias("ahead")), "mix-sums")
    deepest = plan.agg(F.max("digits")).first()[0] or 0
    found = plan.filter("rest > 0").select("s", "rest", "digits", F.lit("").alias("block"), F.lit(0).cast("bigint").alias("before"))
    for level in range(1, deepest + 1):
        step = sums.filter(F.col("level") == level)
        # a source of fewer digits meets nothing and stays as it is
        met = found.join(step, F.col("s").eqNullSafe(F.col("t")) & (F.col("block") == F.col("parent")), "left")
        met = met.select("s", "rest", "digits", F.coalesce("prefix", "block").alias("block"), (F.col("before") + F.coalesce("ahead", F.lit(0))).alias("before"))
        met = met.filter("before < rest").groupBy("s", "rest", "digits")
        found = met.agg(F.max("block").alias("last"), F.max_by("before", "block").alias("before")).withColumnRenamed("last", "block")
    return found.select("s", "block", "before")


def _plan(docs: DataFrame, mix: Mix, seed: int) -> DataFrame:
    """Per source: passes, tokens of the partial pass, and the key up to which documents are in it."""
    spark = docs.sparkSession
    measured = materialised(docs.select("doc_id", "source", n_words(F.col("text")).alias("n_words")), "sizes")
    sources = measured.groupBy("source").agg(F.sum("n_words").alias("tokens"), F.count("*").alias("docs")).limit(MAX_SOURCES + 1).collect()
    if len(sources) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    sources = sorted(sources, key=lambda r: (r["source"] is not None, r["source"]))
    tokens = [r["tokens"] for r in sources]
    rounds = mix.passes(tokens, mix.exponent(tokens))
    rows = []
    for r, share in zip(sources, rounds):
        drawn = math.floor(share * r["tokens"] + 1e-6)
        whole = drawn // r["tokens"] if r["tokens"] else 0
        digits = max(1, math.ceil(math.log(max(1, r["docs"] / BLOCK_DOCS), 16)))
        rows.append((r["source"], whole, drawn - whole * r["tokens"], digits))
    schema = T.StructType([T.StructField("s", T.StringType()), T.StructField("whole", T.LongType()), T.StructField("rest", T.LongType()), T.StructField("digits", T.IntegerType())])
    plan = local_rows(spark, rows, schema)
    keyed = measured.join(plan, F.col("source").eqNullSafe(F.col("s"))).withColumn("key", _key(seed, F.col("whole").cast("string")))
    keyed = keyed.withColumn("block", F.expr("substr(key, 1, digits)")).select("s", "key", "block", "rest", "n_words")
    cut = _cut_blocks(keyed, plan)
    cut = cut.withColumnsRenamed({"s": "t", "block": "last_block"})
    inside = keyed.join(cut, F.col("s").eqNullSafe(F.col("t")) & (F.col("block") == F.col("last_block"))).select("s", "key", "rest", "before", "n_words")
    inside = inside.groupBy("s", "key", "rest", "before").agg(F.sum("n_words").alias("n"))
    ahead = F.sum("n").over(Window.partitionBy("s").orderBy("key").rowsBetween(Window.unboundedPreceding, -1))
    last = inside.withColumn("ahead", F.col("before") + F.coalesce(ahead, F.lit(0))).filter("ahead < rest").groupBy("s").agg(F.max("key").alias("last"))
    return plan.join(last.withColumnRenamed("s", "t"), F.col("s").eqNullSafe(F.col("t")), "left").select("s", "whole", "last")


def mixed(docs: DataFrame, mix: Mix, seed: int = 1, name: str = "_pass") -> DataFrame:
    """``docs`` (doc_id, source, text and any others), each row once per pass that takes it, with its pass from 0 in the column ``name``.

    A partial pass takes documents in key order until those before have its tokens; documents
    of equal key (repeated rows) go together.  Null is a source of its own.  A source without
    words has no tokens to draw and no rows.  Null texts have no words.  The result does not
    depend on partitions or block sizes.
    """
    # one small row per source, at most MAX_SOURCES
    source, whole, last = (unused(docs, n) for n in ("_source", "_whole", "_last"))
    plan = F.broadcast(materialised(_plan(docs, mix, seed), "mix").withColumnsRenamed({"s": source, "whole": whole, "last": last}))
    rows = docs.join(plan, F.col("source").eqNullSafe(F.col(source)))
    more = F.coalesce(_key(seed, F.col(whole).cast("string")) <= F.col(last), F.lit(False)).cast("bigint")
    times = F.col(whole) + more
    return rows.filter(times > 0).withColumn(name, F.explode(F.sequence(F.lit(0).cast("bigint"), times - 1))).drop(source, whole, last)
