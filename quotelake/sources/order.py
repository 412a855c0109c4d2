"""The position of a record in its source, for "first" and "last" among duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILE_COLUMNS = ("_file_time", "_file_path", "_file_block")


def with_file_columns(df: DataFrame) -> DataFrame:
    """Keep the file a row came from; call on the reader's frame, batch or stream."""
    return df.select(
        "*",
        F.col("_metadata.file_modification_time").alias("_file_time"),
        F.col("_metadata.file_path").alias("_file_path"),
        F.col("_metadata.file_block_start").alias("_file_block"),
    )


def with_row_order(df: DataFrame, row: Column | None = None) -> DataFrame:
    """Turn the file columns into ``ord``.

    A file split is read by one task in file order, so within a split the running id
    grows with the row; the split itself is placed by file time, path and offset.
    """
    position = F.monotonically_increasing_id() if row is None else row.cast("bigint")
    return df.withColumn(
        "ord",
        F.struct(
            F.col("_file_time").alias("file_time"),
            F.col("_file_path").alias("file_path"),
            F.col("_file_block").alias("file_block"),
            position.alias("row"),
        ),
    ).drop(*FILE_COLUMNS)
