"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


# Shuffled data per task; a few of these fit in an executor's memory side by side.
PARTITION_BYTES = 256 << 20


def build_session(
    master: str | None = None, app: str = "quotelake", shuffle_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session with the settings the operators are tuned for.

    ``master`` is left to spark-submit unless given.  ``shuffle_bytes`` is the size of the
    largest shuffle to expect: it sets how many partitions a shuffle starts with, so that
    one fits in a task's memory; AQE merges them where there is less.  ``conf`` overrides
    any default; write dots as double underscores (``spark__sql__shuffle__partitions="8"``).
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.parquet.filterPushdown", "true")
        .config("spark.sql.variant.allowDuplicateKeys", "true")  # the last one wins
        .config("spark.scheduler.mode", "FAIR")  # for sources that are loaded side by side
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_bytes:
        partitions = max(200, -(-shuffle_bytes // PARTITION_BYTES))
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: the session's ``spark.checkpoint.dir``.

    Only a local-mode session without the setting gets a temporary folder; on a
    cluster a machine-local folder would be lost with its machine, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(base)
        return base.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    base = tempfile.mkdtemp(prefix="quotelake-")
    spark.sparkContext.setCheckpointDir(base)
    return base


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path below the shared folder."""
    return f"{shared_dir(spark)}/quotelake/{label}-{uuid.uuid4().hex}"


def make_folder(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(place)


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Settings that hold for the plans made inside."""
    before = {key: spark.conf.get(key) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def sibling(spark: SparkSession) -> SparkSession:
    """A session of the same application with the same settings, which are its own from then on."""
    other = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and other.conf.isModifiable(key):
            other.conf.set(key, value)
    return other


def local_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A handful of driver-side rows as a local relation, without starting Python workers."""
    arrow = to_arrow_schema(schema)
    columns = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), schema)
