"""The load job: scan, validate, land, upsert, checkpoint, one source after the other or side by side."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from quotelake.operators import drift as drifts
from quotelake.operators.unify import unify
from quotelake.operators.upsert import UpsertPolicy
from quotelake.operators.validate import validate
from quotelake.plans import control
from quotelake.session import sibling
from quotelake.sources.csv_files import scan_csv
from quotelake.sources.json_files import scan_json
from quotelake.sources.listing import active_only, enrich, flatten_quotes, market_top_records, per_file, variant_field
from quotelake.specs import SOURCES, SourceSpec
from quotelake.tables import Lake

# --- fixed values: attempts per load and the waits between them, in seconds --------------
ATTEMPTS = 3
WAIT_LEAST, WAIT_MOST = 2, 10
# --- end of fixed values -----------------------------------------------------------------


@dataclass(frozen=True)
class RunResult:
    source: str
    run_id: str
    status: str
    processed: int = 0
    failed: int = 0
    error: str | None = None


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


def unified_policy(spec: SourceSpec) -> UpsertPolicy:
    return UpsertPolicy(
        keys=("coin_id", "source"),
        update=spec.update_columns,
        created="created_at",
        touched=("source_updated_at", "updated_at"),
    )


def scan_source(
    spark: SparkSession, spec: SourceSpec, path: str, listing_path: str | None = None
) -> DataFrame:
    """Records of a landed source; ``listing_path`` selects detail records, as in :func:`source_records`."""
    if spec.layout == "csv":
        return scan_csv(spark, path, spec.multi_line)
    return source_records(scan_json(spark, path, spec.layout), spec, listing_path)


def source_records(records: DataFrame, spec: SourceSpec, listing_path: str | None = None) -> DataFrame:
    """Scanned JSON records, or a micro-batch of them, as a source's rows.

    ``listing_path`` is the entity list that selects detail records: active ones, with a
    ``spec.limit`` the first so many of each listing file.  It is read as it is now.  Without it
    every detail record counts.
    """
    if not spec.nested_quotes:
        return market_top_records(records, n=spec.limit) if spec.limit else records
    if listing_path:
        listing = active_only(scan_json(records.sparkSession, listing_path, "json_array").filter(~F.col("malformed")))
        if spec.limit:
            listing = per_file(listing, spec.limit, F.asc("ord"))
        # a key listed twice is looked up once here; the upsert would fold it anyway
        key = F.nullif(F.to_json(variant_field("record", "id")), F.lit("null")).alias("_key")
        records = enrich(listing.select(key).distinct(), records.select("*", key), "_key").drop("_key")
    return flatten_quotes(records)


def load_batch(
    lake: Lake,
    spec: SourceSpec,
    records: DataFrame,
    batch_id: str,
    now: datetime,
    drift: str | None = None,
) -> tuple[int, int]:
    """Validate, land and upsert one batch; returns the accepted and rejected counts.

    Safe to repeat with the same ``batch_id``: the landed folder and the
    drift rows are replaced and the upsert leaves the same rows.  ``drift`` is ``"rows"`` for one drift row per
    record and field, ``"summary"`` for one per field, or None.
    """
    landed = lake.land(validate(records, spec), spec.name, batch_id, now)
    counts = {r["status"]: r["count"] for r in landed.groupBy("status").count().collect()}
    processed, failed = counts.get("ok", 0), counts.get("rejected", 0)
    if processed:
        good = landed.filter(F.col("status") == "ok")
        batch = with_identity(unify(good, spec, F.lit(now), keep=("ord",)))
        lake.unified.upsert(batch, unified_policy(spec), ("ord",), now)
    if drift and spec.expected_types:
        lake.drift.replace(drift_rows(landed, spec, now, drift).select(*lake.drift.schema.names), batch_id)
    return processed, failed


def with_identity(unified: DataFrame) -> DataFrame:
    """A row id that follows from the key, so that repeats and retries agree on it."""
    return unified.withColumn("id", F.xxhash64("coin_id", "source"))


def drift_rows(landed: DataFrame, spec: SourceSpec, now: datetime, form: str) -> DataFrame:
    if form not in ("rows", "summary"):
        raise ValueError("drift is 'rows' or 'summary'")
    found = drifts.detect(landed, spec.expected_types, spec.name, F.lit(now), record="payload")
    if form == "rows":
        return found.withColumn("occurrences", F.lit(1).cast("bigint"))
    return drifts.summarize(found).withColumns({"detected_at": F.lit(now), "resolved": F.lit(False)})


def with_retry(action: Callable, attempts: int, wait: Callable[[float], None] = time.sleep):
    """Run ``action`` up to ``attempts`` times, waiting longer after each failure."""
    for attempt in range(1, attempts + 1):
        try:
            return action()
        except Exception:
            if attempt == attempts:
                raise
            wait(max(WAIT_LEAST, min(WAIT_MOST, 2 ** (attempt - 1))))


def run_source(
    lake: Lake,
    spec: SourceSpec,
    records: Callable[[], DataFrame],
    drift: str | None = None,
    attempts: int = ATTEMPTS,
    wait: Callable[[float], None] = time.sleep,
    clock: Callable[[], datetime] = utc_now,
    run_id: str | None = None,
) -> RunResult:
    """Load one source and record the run and its checkpoint; a failure is re-raised.

    ``run_id`` names the batch too: give one to make a repeated delivery a no-op.
    """
    if run_id and (done := control.succeeded(lake, run_id)):
        return RunResult(spec.name, run_id, "success", *done)
    # a batch that is delivered again keeps the time, and so the ingest date, of its first delivery
    started = (control.started_at(lake, run_id) if run_id else None) or clock()
    run_id = run_id or str(uuid.uuid4())
    control.start_run(lake, run_id, spec.name, started)
    try:
        # One batch id for all attempts, so a retry replaces what the last one left.
        processed, failed = with_retry(
            lambda: load_batch(lake, spec, records(), run_id, started, drift), attempts, wait
        )
        done = clock()
        fetched = processed + failed
        last_id = str(fetched) if fetched else ""
        control.update_checkpoint(lake, spec.name, last_id, done, "success", processed)
        control.complete_run(lake, run_id, spec.name, "success", started, done, processed, failed)
    except Exception as error:
        done = clock()
        message = str(error)
        control.update_checkpoint(lake, spec.name, "", done, "failure", 0, message)
        control.complete_run(lake, run_id, spec.name, "failed", started, done, 0, 0, message)
        raise
    return RunResult(spec.name, run_id, "success", processed, failed)


def run_all(
    lake: Lake,
    inputs: dict[str, str | tuple[str, str | None]],
    specs: dict[str, SourceSpec] = SOURCES,
    at_once: int = 1,
    **options,
) -> list[RunResult]:
    """Load every source in ``inputs``, results in registry order; a failing one stops no other.

    ``inputs`` maps a source to its path, or to ``(path, listing_path)``.  Up to ``at_once``
    sources are loaded side by side, each in a session and a scheduler pool of its own, so that
    a small source does not wait for the tasks of a large one (with ``spark.scheduler.mode`` FAIR).
    """
    if at_once < 1:
        raise ValueError("at_once is at least 1")
    lake.create_tables()
    chosen = [spec for name, spec in specs.items() if name in inputs]

    def load(spec: SourceSpec, own: Lake) -> RunResult:
        given = inputs[spec.name]
        path, listing = (given, None) if isinstance(given, str) else given
        try:
            return run_source(own, spec, lambda: scan_source(own.spark, spec, path, listing), **options)
        except Exception as error:
            return RunResult(spec.name, "", "failed", error=str(error))

    if at_once == 1:
        return [load(spec, lake) for spec in chosen]

    lake.unified.read()  # the catalog knows the table before any source needs it

    @inheritable_thread_target(lake.spark)
    def load_beside(spec: SourceSpec) -> RunResult:
        lake.spark.sparkContext.setLocalProperty("spark.scheduler.pool", spec.name)
        return load(spec, lake.beside(sibling(lake.spark)))

    with ThreadPoolExecutor(at_once) as threads:
        results = list(threads.map(load_beside, chosen))
    lake.unified.refresh()
    return results
