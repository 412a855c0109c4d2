"""Table schemas and the fixed vocabularies of the status columns."""

from __future__ import annotations

from pyspark.sql import types as T

STR, INT, LONG, DBL, TS, BOOL = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.DoubleType(),
    T.TimestampType(),
    T.BooleanType(),
)


def _schema(*fields: tuple) -> T.StructType:
    """Fields as ``(name, type)`` or ``(name, type, False)`` for a NOT NULL column."""
    return T.StructType([T.StructField(f[0], f[1], f[2] if len(f) > 2 else True) for f in fields])


# --- fixed values: statuses and drift kinds -------------------------------------
RUN_STATUSES = ("started", "success", "failed")
CHECKPOINT_STATUSES = ("success", "failure")
DRIFT_KINDS = ("new_field", "missing_field", "type_change")
NEVER_RUN = "never_run"

# --- the unified quote table ----------------------------------------------------
UNIFIED_SCHEMA = _schema(
    ("id", LONG),
    ("coin_id", STR, False),
    ("name", STR, False),
    ("symbol", STR, False),
    ("price_usd", DBL),
    ("market_cap_usd", DBL),
    ("volume_24h_usd", DBL),
    ("price_change_24h_percent", DBL),
    ("rank", INT),
    ("source", STR, False),
    ("source_updated_at", TS),
    ("created_at", TS),
    ("updated_at", TS),
)

# What one source's mapping yields, before ids and row times are added.
UNIFIED_CONTRACT = _schema(
    ("coin_id", STR, False),
    ("name", STR, False),
    ("symbol", STR, False),
    ("price_usd", DBL),
    ("market_cap_usd", DBL),
    ("volume_24h_usd", DBL),
    ("price_change_24h_percent", DBL),
    ("rank", INT),
    ("source", STR, False),
    ("source_updated_at", TS),
)

# --- raw records of a source ----------------------------------------------------

ORDER_TYPE = _schema(("file_time", TS), ("file_path", STR), ("file_block", LONG), ("row", LONG))
FIELD_TYPES = {"string": STR, "double": DBL, "int": INT}


def landed_schema(spec) -> T.StructType:
    """A validated batch of the source ``spec`` as it is stored, accepted and rejected rows alike."""
    typed = [(f.name, FIELD_TYPES[f.kind]) for f in spec.fields]
    reasons = ("reject_reasons", T.ArrayType(STR))
    return _schema(
        ("ord", ORDER_TYPE),
        ("payload", T.VariantType()),
        *typed,
        reasons,
        ("ingested_at", TS),
        ("status", STR),
        ("batch_id", STR),
        ("ingest_date", T.DateType()),
    )


# --- control tables -------------------------------------------------------------
CHECKPOINT_SCHEMA = _schema(
    ("source_name", STR, False),
    ("last_processed_id", STR),
    ("last_processed_timestamp", TS),
    ("records_processed", LONG),
    ("last_run_status", STR),
    ("last_error", STR),
    ("created_at", TS),
    ("updated_at", TS),
)

RUN_SCHEMA = _schema(
    ("run_id", STR, False),
    ("source_name", STR, False),
    ("status", STR, False),
    ("records_processed", LONG),
    ("records_failed", LONG),
    ("duration_seconds", DBL),
    ("error_message", STR),
    ("run_metadata", STR),
    ("started_at", TS),
    ("completed_at", TS),
)

DRIFT_SCHEMA = _schema(
    ("source_name", STR, False),
    ("drift_type", STR),
    ("field_name", STR),
    ("expected_type", STR),
    ("actual_type", STR),
    ("confidence_score", DBL),
    ("sample_value", STR),
    ("occurrences", LONG),
    ("detected_at", TS),
    ("resolved", BOOL),
)

# Columns of the public read projections, in order.
QUOTE_COLUMNS = (
    "id",
    "coin_id",
    "name",
    "symbol",
    "price_usd",
    "market_cap_usd",
    "volume_24h_usd",
    "price_change_24h_percent",
    "rank",
    "source",
    "updated_at",
)
RUN_COLUMNS = (
    "run_id",
    "source_name",
    "status",
    "records_processed",
    "records_failed",
    "duration_seconds",
    "started_at",
    "completed_at",
    "error_message",
)
