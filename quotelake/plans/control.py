"""Run log, checkpoints and incremental reads.

Both tables are append-only event logs.  Their state is the same fold the upsert uses:
columns set once from a key's first event, the rest from its last.
"""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.operators.drift import life_cycle
from quotelake.operators.upsert import UpsertPolicy, fold_batch
from quotelake.tables import Lake

# --- fixed value ------------------------------------------------------------------------
RUN_METADATA = {"started_by": "etl_scheduler"}
# --- end of fixed value -----------------------------------------------------------------

RUN_STATE = (
    "status",
    "records_processed",
    "records_failed",
    "duration_seconds",
    "error_message",
    "completed_at",
)
RUN_POLICY = UpsertPolicy(keys=("run_id",), update=RUN_STATE)

CHECKPOINT_POLICY = UpsertPolicy(
    keys=("source_name",),
    update=(
        "last_processed_id",
        "last_processed_timestamp",
        "records_processed",
        "last_run_status",
        "last_error",
        "updated_at",
    ),
)


def fold_runs(events: DataFrame, order: tuple[str, ...] | None = None) -> DataFrame:
    """Latest state per run; start time, source and metadata from its first event."""
    if order is None:
        events = events.withColumn("_done", F.col("completed_at").isNotNull()).withColumn(
            "_at", F.coalesce("completed_at", "started_at")
        )
        order = ("_done", "_at")
    return fold_batch(events, RUN_POLICY, order)


def fold_checkpoints(events: DataFrame, order: tuple[str, ...] = ("updated_at",)) -> DataFrame:
    """One checkpoint per source: everything but the creation time from its last event."""
    return fold_batch(events, CHECKPOINT_POLICY, order)


def runs(lake: Lake) -> DataFrame:
    return fold_runs(lake.runs.read()).select(*lake.runs.schema.names)


def checkpoints(lake: Lake) -> DataFrame:
    return fold_checkpoints(lake.checkpoints.read()).select(*lake.checkpoints.schema.names)


def get_checkpoint(lake: Lake, source: str):
    """The checkpoint row of a source, or None; at most one row reaches the driver."""
    # the filter comes first, so only this source's events are folded
    events = lake.checkpoints.read().filter(F.col("source_name") == source)
    return fold_checkpoints(events).select(*lake.checkpoints.schema.names).first()


def update_checkpoint(
    lake: Lake,
    source: str,
    last_id: str,
    at: datetime,
    status: str,
    records_processed: int,
    error: str | None = None,
) -> None:
    lake.checkpoints.append_rows([(source, last_id, at, records_processed, status, error, at, at)])


def start_run(lake: Lake, run_id: str, source: str, at: datetime) -> None:
    lake.runs.append_rows(
        [(run_id, source, "started", 0, 0, None, None, json.dumps(RUN_METADATA), at, None)]
    )


def succeeded(lake: Lake, run_id: str) -> tuple[int, int] | None:
    """The accepted and rejected counts of a run that ended well, or None."""
    ended = lake.runs.read().filter((F.col("run_id") == run_id) & (F.col("status") == "success"))
    row = ended.select("records_processed", "records_failed").first()
    return tuple(row) if row else None


def started_at(lake: Lake, run_id: str) -> datetime | None:
    """When a run was first started."""
    first = lake.runs.read().filter(F.col("run_id") == run_id).agg(F.min("started_at")).first()[0]
    return first and first.astimezone(timezone.utc)


def complete_run(
    lake: Lake,
    run_id: str,
    source: str,
    status: str,
    started_at: datetime,
    completed_at: datetime,
    processed: int,
    failed: int,
    error: str | None = None,
) -> None:
    seconds = (completed_at - started_at).total_seconds()
    metadata = json.dumps(RUN_METADATA)
    lake.runs.append_rows(
        [(run_id, source, status, processed, failed, seconds, error, metadata, started_at, completed_at)]
    )


def drift_state(lake: Lake) -> DataFrame:
    """The life cycle of every drift finding; each successful run counts as having looked for drift."""
    done = runs(lake).filter(F.col("status") == "success")
    return life_cycle(lake.drift.read(), done.select("source_name", F.col("started_at").alias("checked_at")))


def read_since(df: DataFrame, column: str, last) -> DataFrame:
    """Rows after the checkpoint time; all rows when there is none yet."""
    return df if last is None else df.filter(F.col(column) > F.lit(last))
