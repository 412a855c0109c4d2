"""The read side: quote pages, recent runs, health and source statistics."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.operators.paging import Key, offset_page, order_sketch, page_after
from quotelake.schemas import NEVER_RUN, QUOTE_COLUMNS, RUN_COLUMNS
from quotelake.session import local_rows
from quotelake.specs import SOURCES

# --- fixed values: argument bounds and defaults -----------------------------------------
PAGE_SIZE, MAX_PAGE_SIZE = 20, 100
RUN_LIMIT, MAX_RUN_LIMIT = 10, 100
# --- end of fixed values ----------------------------------------------------------------


# latest first; source and key make the order total, so pages never overlap
PAGE_ORDER = (Key("updated_at", descending=True), Key("source"), Key("coin_id"))


def check_bounds(**arguments: tuple[int, int, int | None]) -> None:
    """Each argument as ``(value, least, most)``; a violation is a ``ValueError``."""
    for name, (value, least, most) in arguments.items():
        if isinstance(value, bool) or not isinstance(value, int):
            raise ValueError(f"{name} must be an integer")
        if value < least or (most is not None and value > most):
            limit = f"at least {least}" if most is None else f"between {least} and {most}"
            raise ValueError(f"{name} must be {limit}")


def quote_filter(quotes: DataFrame, source: str | None = None, symbol: str | None = None) -> DataFrame:
    """Exact source and case-blind symbol; an empty argument filters nothing."""
    if source:
        quotes = quotes.filter(F.col("source") == source)
    if symbol:
        quotes = quotes.filter(F.col("symbol") == symbol.upper())
    return quotes


def quote_page(
    quotes: DataFrame,
    page: int = 1,
    page_size: int = PAGE_SIZE,
    source: str | None = None,
    symbol: str | None = None,
    sketch: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """One page, latest update first, and the one-row total before paging.

    ``sketch``, a stored :func:`page_sketch`, saves a deep page a pass, unless a symbol is asked for.
    """
    check_bounds(page=(page, 1, None), page_size=(page_size, 1, MAX_PAGE_SIZE))
    matching = quote_filter(quotes, source, symbol)
    if sketch is not None:
        sketch = None if symbol else quote_filter(sketch, source)
    rows = offset_page(_shown(matching), PAGE_ORDER, (page - 1) * page_size, page_size, sketch)
    return rows, matching.agg(F.count("*").alias("total"))


def page_sketch(quotes: DataFrame) -> DataFrame:
    """Per source a quantile sketch of the page order, to be stored beside the quotes."""
    return order_sketch(quotes, PAGE_ORDER, "source")


def quote_page_after(
    quotes: DataFrame,
    last: Mapping[str, Any],
    page_size: int = PAGE_SIZE,
    source: str | None = None,
    symbol: str | None = None,
) -> DataFrame:
    """The page that follows the row ``last`` (its updated_at, source and coin_id at least).

    It costs the same at any depth, and rows that arrive meanwhile shift no page.
    """
    check_bounds(page_size=(page_size, 1, MAX_PAGE_SIZE))
    return page_after(_shown(quote_filter(quotes, source, symbol)), PAGE_ORDER, last, page_size)


def _shown(quotes: DataFrame) -> DataFrame:
    return quotes.select(*[c for c in QUOTE_COLUMNS if c in quotes.columns])


def recent_runs(runs: DataFrame, limit: int = RUN_LIMIT, source: str | None = None) -> DataFrame:
    check_bounds(limit=(limit, 1, MAX_RUN_LIMIT))
    if source:
        runs = runs.filter(F.col("source_name") == source)
    return runs.orderBy(F.desc_nulls_first("started_at"), F.asc("run_id")).limit(limit).select(*RUN_COLUMNS)


def _listed(df: DataFrame, sources: list[str]) -> DataFrame:
    schema = T.StructType([T.StructField("source", T.StringType())])
    return local_rows(df.sparkSession, [(s,) for s in sources], schema)


def health(checkpoints: DataFrame, sources: list[str] | None = None) -> DataFrame:
    """Last status, time and count per listed source; a source never run says so."""
    sources = list(SOURCES) if sources is None else sources
    # one row per listed source at most, so the right side is small by construction
    known = checkpoints.filter(F.col("source_name").isin(*sources)).select(
        F.col("source_name").alias("source"),
        "last_run_status",
        F.col("last_processed_timestamp").alias("last_run_time"),
        "records_processed",
    )
    never = F.col("_known").isNull()
    return (
        _listed(checkpoints, sources)
        .join(F.broadcast(known.withColumn("_known", F.lit(True))), "source", "left")
        .select(
            "source",
            F.when(never, NEVER_RUN).otherwise(F.col("last_run_status")).alias("last_run_status"),
            "last_run_time",
            F.when(never, 0).otherwise(F.col("records_processed")).alias("records_processed"),
        )
    )


def health_map(rollup: DataFrame) -> DataFrame:
    """The health rows as one map: source to (status, ISO time, count)."""
    entry = F.struct(
        "last_run_status",
        F.date_format("last_run_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("last_run_time"),
        "records_processed",
    )
    return rollup.agg(F.map_from_entries(F.collect_list(F.struct("source", entry))).alias("etl_status"))


def run_statistics(runs: DataFrame) -> DataFrame:
    """Per source: run count, success rate, last success with its duration, last failure.

    All buffers have a fixed width, so this is one hash aggregate with map-side partials:
    each task sends one row per source whatever the share of the largest source.
    """
    won, lost = F.col("status") == "success", F.col("status") == "failed"
    return runs.groupBy("source_name").agg(
        F.count("*").alias("total_runs"),
        F.count_if(won).alias("_won"),
        F.max(F.when(won, F.col("completed_at"))).alias("last_success"),
        F.max(F.when(lost, F.col("completed_at"))).alias("last_failure"),
        F.max_by("duration_seconds", F.when(won, F.col("completed_at"))).alias("last_run_duration_seconds"),
    )


def source_stats(runs: DataFrame, checkpoints: DataFrame, sources: list[str] | None = None) -> DataFrame:
    """One row per listed source, also for one without runs or checkpoint."""
    sources = list(SOURCES) if sources is None else sources
    # both right sides hold at most one row per listed source
    counted = run_statistics(runs.filter(F.col("source_name").isin(*sources)))
    loaded = checkpoints.filter(F.col("source_name").isin(*sources)).select("source_name", "records_processed")
    total = F.coalesce("total_runs", F.lit(0))
    rate = F.when(total > 0, F.bround(F.col("_won") / total * 100, 2)).otherwise(F.lit(0.0))
    return (
        _listed(runs, sources)
        .withColumnRenamed("source", "source_name")
        .join(F.broadcast(loaded), "source_name", "left")
        .join(F.broadcast(counted), "source_name", "left")
        .select(
            F.col("source_name").alias("source"),
            F.coalesce("records_processed", F.lit(0)).alias("records_processed"),
            "last_success",
            "last_failure",
            "last_run_duration_seconds",
            total.alias("total_runs"),
            rate.alias("success_rate"),
        )
    )
