"""JSON scans: files holding one array of records, whole or in splits, and files with one record per line.

Spark's JSON reader parses each value once, straight into a VARIANT column, which keeps
the difference between an absent field and an explicit null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

from quotelake.sources.json_arrays import PIECE_END, SPLIT_LAYOUT, split_array_records
from quotelake.sources.order import FILE_COLUMNS, with_file_columns, with_row_order

CORRUPT = "_corrupt_record"
JSON_SCHEMA = f"record variant, {CORRUPT} string"


def json_reader_options(layout: str) -> dict[str, str]:
    """An array file is one answer page and is parsed as a whole, so land many pages, or use
    ``ndjson`` or ``json_array_split``, whose files are split among tasks."""
    return {
        "singleVariantColumn": "record",
        "columnNameOfCorruptRecord": CORRUPT,
        "mode": "PERMISSIVE",
        "multiLine": str(layout == "json_array").lower(),
    }


def open_json(reader: DataFrameReader | DataStreamReader, path: str, layout: str) -> DataFrame:
    """Files as values, lines or pieces, for a batch or a stream; :func:`json_records` makes records of them."""
    if layout == SPLIT_LAYOUT:
        return with_file_columns(reader.option("lineSep", PIECE_END).text(path))
    return with_file_columns(reader.schema(JSON_SCHEMA).options(**json_reader_options(layout)).json(path))


def read_json(spark: SparkSession, path: str, layout: str) -> DataFrame:
    return open_json(spark.read, path, layout)


def array_records(pages: DataFrame) -> DataFrame:
    """One row per array element, ``ord.row`` = its place in the array.

    A page that is not JSON, or not an array, stays as one malformed row.
    """
    is_array = F.coalesce(F.schema_of_variant("record").startswith("ARRAY"), F.lit(False))
    items = F.when(is_array, F.try_variant_get("record", "$", "array<variant>")).otherwise(F.array("record"))
    exploded = pages.select(CORRUPT, *FILE_COLUMNS, is_array.alias("_ok"), F.posexplode(items))
    ordered = with_row_order(exploded, F.col("pos"))
    return ordered.select(
        F.col("col").alias("record"),
        "ord",
        F.coalesce("col", F.col(CORRUPT).cast("variant")).alias("payload"),
        (~F.col("_ok")).alias("malformed"),
    )


def line_records(lines: DataFrame) -> DataFrame:
    """One row per non-blank line; a line that is not JSON is malformed."""
    return with_row_order(lines).select(
        "record",
        "ord",
        F.coalesce("record", F.col(CORRUPT).cast("variant")).alias("payload"),
        F.col("record").isNull().alias("malformed"),
    )


def json_records(read: DataFrame, layout: str) -> DataFrame:
    if layout == SPLIT_LAYOUT:
        return split_array_records(read)
    return array_records(read) if layout == "json_array" else line_records(read)


def scan_json(spark: SparkSession, path: str, layout: str) -> DataFrame:
    return json_records(read_json(spark, path, layout), layout)
