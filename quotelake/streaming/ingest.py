"""Incremental loads: each run takes the files that arrived since the last one.

Which files were taken is kept in Spark's streaming checkpoint.  A micro-batch may be
delivered again after a failure; its id is stored with what it published, so the second
delivery changes nothing.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from quotelake.operators.upsert import UpsertPolicy
from quotelake.plans.pipeline import run_source, source_records, utc_now
from quotelake.sources.csv_files import CORRUPT, csv_reader_options, csv_records
from quotelake.sources.json_files import json_records, open_json
from quotelake.sources.order import with_file_columns
from quotelake.specs import SourceSpec
from quotelake.tables import KeyedTable, Lake


def stream_files(
    spark: SparkSession,
    spec: SourceSpec,
    path: str,
    columns: tuple[str, ...] | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """The landing folder as a stream of JSON values or CSV rows.

    CSV needs its header names up front: ``columns``, by default those of the spec.
    """
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if spec.layout == "csv":
        names = columns or tuple(f.name for f in spec.fields)
        schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, CORRUPT)])
        options = csv_reader_options(spec.multi_line)
        return with_file_columns(reader.schema(schema).options(**options).csv(path))
    return open_json(reader, path, spec.layout)


def batch_records(batch: DataFrame, spec: SourceSpec, listing_path: str | None = None) -> DataFrame:
    if spec.layout == "csv":
        return csv_records(batch)
    return source_records(json_records(batch, spec.layout), spec, listing_path)


def batch_name(batch: DataFrame, epoch: int) -> str:
    """Unique per streaming checkpoint and micro-batch, the same on redelivery."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query}-{epoch}"


def load_new_files(
    lake: Lake,
    spec: SourceSpec,
    path: str,
    checkpoint: str,
    columns: tuple[str, ...] | None = None,
    drift: str | None = None,
    max_files: int | None = None,
    listing_path: str | None = None,
) -> StreamingQuery:
    """Load all files that are new since the last call, then stop.

    ``listing_path`` selects detail records as in a batch load; each micro-batch reads the
    listing anew.

    ``max_files`` splits a large backlog into micro-batches, oldest files first.  A spec's
    limit holds for each listing file, as in a batch load.
    """

    def apply(batch: DataFrame, epoch: int) -> None:
        run_source(lake, spec, lambda: batch_records(batch, spec, listing_path), drift, run_id=batch_name(batch, epoch))

    lake.create_tables()
    stream = stream_files(lake.spark, spec, path, columns, max_files)
    return _available_now(stream.writeStream.foreachBatch(apply), checkpoint)


def upsert_stream(
    stream: DataFrame,
    table: KeyedTable,
    policy: UpsertPolicy,
    order: tuple[str, ...],
    checkpoint: str,
    now=utc_now,
) -> StreamingQuery:
    """Upsert what is new in any stream into a keyed table, then stop."""

    def apply(batch: DataFrame, epoch: int) -> None:
        moment: datetime = now()
        name = batch_name(batch, epoch)
        landing = f"{table.root}/landing/batch_id={name}"
        batch.write.mode("overwrite").parquet(landing)
        landed = batch.sparkSession.read.schema(batch.schema).parquet(landing)
        table.upsert(landed, policy, order, moment)  # a redelivered batch leaves the same rows

    table.create()
    return _available_now(stream.writeStream.foreachBatch(apply), checkpoint)


def _available_now(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
