"""Intermediate tables and files in the folder that all executors share."""

from __future__ import annotations

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from quotelake.session import scratch_path


def stored(df: DataFrame, label: str) -> str:
    """Write a table to a new place in the shared folder and return its path."""
    path = scratch_path(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    return path


def materialised(df: DataFrame, label: str) -> DataFrame:
    """The same rows, read back from the shared folder, so that nothing is computed twice."""
    return df.sparkSession.read.schema(df.schema).parquet(stored(df, label))


def unused(df: DataFrame, name: str) -> str:
    """A name like ``name`` that no column has, for a helper column beside columns of any name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def drop(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table that no later step reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder, for tasks that write files of their own format."""
    for scheme in ("s3a://", "s3n://"):
        uri = uri.replace(scheme, "s3://", 1) if uri.startswith(scheme) else uri
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)
