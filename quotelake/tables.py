"""Tables on plain Parquet: append-only logs and a bucketed table with one row per key.

One job writes a lake at a time.  It may load several sources side by side: each has its own
directories, and the control logs take one writer after the other.
"""

from __future__ import annotations

import hashlib
import threading
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake import schemas
from quotelake.operators.upsert import UpsertPolicy, fold_batch, merge
from quotelake.session import local_rows, make_folder, settings
from quotelake.specs import SourceSpec

UPSERT_SETTINGS = {
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # buckets are by the key alone, and rows of one key and group lie together all the same
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


INGEST_DATE = "ingest_date"


class LogTable:
    """An append-only table; the state of a key is a fold over its rows."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path, schema
        self.lock = threading.Lock()  # appends to one folder share Spark's folder for unfinished files

    def create(self) -> None:
        """Create the table if it is absent."""
        local_rows(self.spark, [], self.schema).write.mode("ignore").parquet(self.path)

    def append(self, rows: DataFrame) -> None:
        with self.lock:
            rows.write.mode("append").parquet(self.path)

    def append_rows(self, rows: list[tuple]) -> None:
        """Append a handful of driver-side control rows as one file."""
        self.append(local_rows(self.spark, rows, self.schema).coalesce(1))

    def replace(self, rows: DataFrame, batch_id: str) -> None:
        """Append the rows of a batch; the same batch again replaces them."""
        rows.write.mode("overwrite").parquet(f"{self.path}/batch-{batch_id}")

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).option("recursiveFileLookup", "true").parquet(self.path)


class KeyedTable:
    """One row per key: a Parquet table with a directory per group, bucketed and sorted by key.

    An upsert is one job.  The batch is folded to a row per key and joined with the rows of the
    groups that it touches, and Spark writes those groups anew (dynamic partition overwrite).
    The stored side is read in its buckets, so only the batch is shuffled; other groups are
    neither read nor written.  New files are staged and a group's directory is exchanged for
    them when all are written, so a failed job leaves the rows as they were; a batch applied
    again leaves the same rows.  Readers that need more than that at the moment of an
    exchange want a table format with snapshots underneath.

    The number of buckets is fixed when the table is created; by default it is the session's
    number of shuffle partitions.  Choose it so that a bucket of the largest group fits in a
    task's memory.
    """

    DEFINITION = T.StructType([T.StructField("buckets", T.IntegerType())])

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: str, group: str, lookups: tuple[str, ...] = (), buckets: int | None = None):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.key, self.group, self.buckets = key, group, buckets
        # files are sorted by key; other columns looked up by value get a Bloom filter
        self.options = {f"parquet.bloom.filter.enabled#{c}": "true" for c in lookups}
        if lookups:
            self.options["parquet.bloom.filter.adaptive.enabled"] = "true"
        # the catalog's name for this folder
        self.name = f"keyed_{hashlib.sha256(self.root.encode()).hexdigest()[:24]}"

    def create(self) -> None:
        """Create the table if it is absent."""
        buckets = self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        local_rows(self.spark, [(buckets,)], self.DEFINITION).coalesce(1).write.mode("ignore").parquet(f"{self.root}/definition")
        make_folder(self.spark, f"{self.root}/rows")

    def _table(self) -> str:
        """The table's name in the session's catalog, which learns it from the folder."""
        if not self.spark.catalog.tableExists(self.name):
            buckets = self.spark.read.schema(self.DEFINITION).parquet(f"{self.root}/definition").first()[0]
            # the group's column comes last, as in every partitioned table
            fields = sorted(self.schema, key=lambda f: f.name == self.group)
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
            options = ", ".join(f"'{k}' = '{v}'" for k, v in {"path": f"{self.root}/rows", **self.options}.items())
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}) USING parquet OPTIONS ({options}) "
                f"PARTITIONED BY (`{self.group}`) CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {buckets} BUCKETS"
            )
            self.spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")
        return self.name

    def refresh(self) -> None:
        """See what another session of this application has written."""
        self.spark.catalog.refreshTable(self._table())

    def read(self, group: str | None = None) -> DataFrame:
        """The rows, or those of one group.  A filter on the group column prunes directories."""
        rows = self.spark.read.table(self._table()).select(*self.schema.names)
        return rows if group is None else rows.filter(F.col(self.group) == group)

    def upsert(self, batch: DataFrame, policy: UpsertPolicy, order: tuple[str, ...], now: datetime) -> None:
        """Apply a batch.

        ``batch`` is read twice and must be stored data; its groups are as few as sources are.  A
        batch with a NULL key, or a NULL or empty group, is an error before anything is written.
        """
        if {*policy.keys} != {self.key, self.group}:
            raise ValueError(f"the key of the table is {self.key}, {self.group}")
        nameless = F.col(self.key).isNull() | F.coalesce(F.col(self.group).cast("string") == "", F.lit(True))
        missing, touched = batch.agg(F.count_if(nameless), F.collect_set(self.group)).first()
        if missing:
            raise ValueError(f"{missing} rows without {self.key} or {self.group}")
        if not touched:
            return
        name = self._table()
        with settings(self.spark, UPSERT_SETTINGS):
            merged = self.merged(batch, policy, order, now, touched)
            merged.write.mode("overwrite").insertInto(name)

    def merged(self, batch: DataFrame, policy: UpsertPolicy, order: tuple[str, ...], now: datetime, touched: list[str]) -> DataFrame:
        """The rows of the touched groups after a batch, in the table's column order."""
        stored = self.read().filter(F.col(self.group).isin(touched))
        rows = merge(stored, fold_batch(batch, policy, order), policy, F.lit(now))
        fields = sorted(self.schema, key=lambda f: f.name == self.group)
        return rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in fields))


class Lake:
    """The tables of one installation, below one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.unified = KeyedTable(
            spark, f"{self.root}/unified", schemas.UNIFIED_SCHEMA, "coin_id", "source", ("symbol",)
        )
        self.runs = LogTable(spark, f"{self.root}/etl_run", schemas.RUN_SCHEMA)
        self.checkpoints = LogTable(spark, f"{self.root}/etl_checkpoint", schemas.CHECKPOINT_SCHEMA)
        self.drift = LogTable(spark, f"{self.root}/schema_drift", schemas.DRIFT_SCHEMA)

    def beside(self, spark: SparkSession) -> Lake:
        """The same lake for another session of this application, to be used at the same time."""
        other = Lake(spark, self.root)
        other.unified.buckets = self.unified.buckets
        for name in ("runs", "checkpoints", "drift"):
            getattr(other, name).lock = getattr(self, name).lock
        return other

    def create_tables(self) -> None:
        for table in (self.unified, self.runs, self.checkpoints, self.drift):
            table.create()

    def raw_path(self, source: str) -> str:
        return f"{self.root}/raw/{source}"

    def land(self, validated: DataFrame, source: str, batch_id: str, now: datetime) -> DataFrame:
        """Write a validated batch once, accepted and rejected rows apart, and read it back.

        Every later step of the load reads these files, so the source is scanned once and a
        lost executor costs no second scan.  A batch id has its own folder below the day of
        ``now`` (UTC): a new batch appends, the same batch again replaces itself.
        """
        path = f"{self.raw_path(source)}/{INGEST_DATE}={now.astimezone(timezone.utc):%Y-%m-%d}/batch_id={batch_id}"
        status = F.when(F.size("reject_reasons") == 0, "ok").otherwise("rejected")
        stamped = validated.withColumn("ingested_at", F.lit(now)).withColumn("status", status)
        stamped.write.mode("overwrite").partitionBy("status").parquet(path)
        return self.spark.read.schema(stamped.schema).parquet(path)

    def raw_since(self, spec: SourceSpec, last: datetime | None) -> DataFrame:
        """The accepted rows of batches after ``last``; all of them where it is None.

        Only folders of that day and later are opened.
        """
        rows = self.raw(spec)
        if last is None:
            return rows
        day = last.astimezone(timezone.utc).date()
        return rows.filter((F.col(INGEST_DATE) >= F.lit(day)) & (F.col("ingested_at") > F.lit(last)))

    def raw(self, spec: SourceSpec) -> DataFrame:
        """All accepted rows ever loaded from a source; every run adds its own."""
        row_id = F.xxhash64("batch_id", "ord").alias("id")
        fields = [f.name for f in spec.fields]
        accepted = self._landed(spec).filter(F.col("status") == "ok")
        return accepted.select(row_id, *fields, F.col("payload").alias("raw_data"), "ingested_at", "batch_id", INGEST_DATE)

    def quarantine(self, spec: SourceSpec) -> DataFrame:
        """All rejected rows with their reasons."""
        rejected = self._landed(spec).filter(F.col("status") == "rejected")
        return rejected.select("reject_reasons", F.col("payload").alias("raw_data"), "ingested_at", "batch_id")

    def _landed(self, spec: SourceSpec) -> DataFrame:
        schema = schemas.landed_schema(spec)
        try:
            return self.spark.read.schema(schema).parquet(self.raw_path(spec.name))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
        # never loaded yet
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
        return self.spark.range(0).select(*nothing)
