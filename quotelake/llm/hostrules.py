"""Quality rules on documents, with verdicts on their hosts.

Each text is measured once.  The rule failures of a host are pooled and their rate is
drawn towards the corpus by a beta prior that is fitted to the hosts themselves, so the fewer
documents a host has, the less their failures count against it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.llm.arrow import values
from quotelake.llm.scratch import materialised
from quotelake.llm.words import covered, equal_groups, pack, spans, windows

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
_BLANK = " \t\n\v\f\r"


def measures(text: str | None) -> tuple[int, int, int, int, int]:
    """(words, code points in words, symbols, repeated lines, words in repeated windows)."""
    packed = pack(text)
    if not packed:
        return 0, 0, 0, 0, 0
    starts, ends = spans(packed)
    n = len(starts)
    symbols = len(packed) - len(packed.translate(None, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(_BLANK)]
    repeated = 0
    if n > WINDOW:
        h = windows(packed, starts, ends, WINDOW)
        if len(np.unique(h)) < len(h):
            first, last = starts[: len(h)], ends[WINDOW - 1 :]
            order, group = equal_groups(packed, first, last, h)
            again = order[np.bincount(group)[group] > 1]
            repeated = int(covered(again, WINDOW, n).sum())
    return n, len(packed.decode()) - (n - 1), symbols, len(lines) - len(set(lines)), repeated


def measured(text: Column) -> Column:
    """The measures of each text as a struct."""

    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    @F.arrow_udf(", ".join(f"{n} bigint" for n in names))
    def of(texts: pa.Array) -> pa.Array:
        rows = np.array([measures(t) for t in values(texts)], np.int64).reshape(-1, len(names))
        return pa.StructArray.from_arrays([pa.array(c) for c in rows.T], names)

    return of(text)


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


def host_rates(rows: DataFrame) -> DataFrame:
    """(host, n, failed, rate) with shrunk failure rates, of ``rows`` (host, failed boolean).

    The prior is the beta distribution that the hosts' true rates seem to come from: its mean is that
    of all rows, and its spread is what the hosts' rates have in excess of the chance that small
    numbers of documents bring with them (beta-binomial moments).  If there is no excess, every rate
    is the mean.  Rows without host belong to no host.  Only five sums reach the driver.
    """
    hosts = materialised(
        rows.filter("host is not null").groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("failed").cast("bigint")).alias("failed")),
        "hosts",
    )
    n, failed = F.col("n").cast("double"), F.col("failed")
    total, bad, squares, sizes, count = hosts.agg(F.sum("n"), F.sum("failed"), F.sum(failed * failed / n), F.sum(n * n), F.count("*")).first()
    if not total:
        return hosts.withColumn("rate", F.lit(0.0))
    mean = bad / total
    chance = mean * (1 - mean)
    room = total - count - sizes / total + 1  # what the excess is measured in: nothing if each host has one document
    within = (squares - total * mean * mean) / chance - (count - 1) if chance > 0 else 0.0
    alike = within / room if room > 1e-9 else 0.0  # how alike documents of a host are, 0 to 1
    if alike <= 1e-12:
        return hosts.withColumn("rate", F.lit(float(mean)))
    strength = max(1 / alike - 1, 0.0)
    return hosts.withColumn("rate", (F.col("failed") + F.lit(mean * strength)) / (F.col("n") + F.lit(strength)))


def host_verdicts(docs: DataFrame, host: str = "source", max_rate: float = 0.5) -> DataFrame:
    """Measures and verdict for every row of ``docs`` (doc_id, text and the ``host`` column).

    A row is kept if it passes the base rules and its host's shrunk failure rate is at most
    ``max_rate``.  A null or empty text has no words and fails.  A row without host is
    judged by its own rules alone.  Repeated rows count, and come back, as often as they
    occur.  Other columns are ignored.
    """
    m = docs.select("doc_id", F.col(host).alias("host"), measured(F.col("text")).alias("m")).select("doc_id", "host", "m.*")
    rows = materialised(m.withColumn("base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words"))), "measures")
    # the verdicts are read from a table of their own, so that Spark can size and split the join
    hosts = materialised(host_rates(rows.select("host", F.col("base_failed").alias("failed"))).select("host", (F.col("rate") <= max_rate).alias("good")), "verdicts")
    return rows.join(hosts, "host", "left").withColumn("kept", ~F.col("base_failed") & F.coalesce("good", F.lit(True)))
