"""Request metrics over a request log: call counts and a cumulative latency histogram."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: upper bounds in seconds; the last bucket is +Inf --------------------
DEFAULT_BUCKETS = (
    0.005,
    0.01,
    0.025,
    0.05,
    0.075,
    0.1,
    0.25,
    0.5,
    0.75,
    1.0,
    2.5,
    5.0,
    7.5,
    10.0,
)
# --- end of fixed values ---------------------------------------------------------------


def request_counter(log: DataFrame, endpoint: str = "endpoint", method: str = "method") -> DataFrame:
    return log.groupBy(endpoint, method).agg(F.count("*").alias("requests"))


def latency_histogram(
    log: DataFrame, seconds: str = "duration_seconds", buckets: tuple[float, ...] = DEFAULT_BUCKETS
) -> DataFrame:
    """Rows ``(le, bucket_count, total_count, total_seconds)``, one per bucket.

    A single pass counts all buckets; the one-row result is then turned into rows.
    """
    counts = [F.count_if(F.col(seconds) <= b).alias(f"_b{i}") for i, b in enumerate(buckets)]
    totals = log.agg(
        *counts,
        F.count(seconds).alias("total_count"),
        F.coalesce(F.sum(seconds), F.lit(0.0)).alias("total_seconds"),
    )
    rows = [F.struct(F.lit(str(b)).alias("le"), F.col(f"_b{i}").alias("n")) for i, b in enumerate(buckets)]
    rows.append(F.struct(F.lit("+Inf").alias("le"), F.col("total_count").alias("n")))
    return totals.select(F.explode(F.array(*rows)).alias("b"), "total_count", "total_seconds").select(
        F.col("b.le").alias("le"), F.col("b.n").alias("bucket_count"), "total_count", "total_seconds"
    )
