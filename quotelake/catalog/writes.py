"""Upserts, keyed tables, raw appends, whole loads and incremental loads."""

from __future__ import annotations

import functools

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.catalog import table
from quotelake.operators.upsert import UpsertPolicy, fold_batch, merge, upsert, upsert_delta
from quotelake.operators.validate import REASONS
from quotelake.plans import control, reads
from quotelake.plans.pipeline import load_batch, run_all, run_source, scan_source
from quotelake.session import scratch_path
from quotelake.sources.json_files import scan_json
from quotelake.sources.listing import market_top_records
from quotelake.specs import CSV, MARKET, TICKER
from quotelake.streaming.ingest import load_new_files, upsert_stream
from quotelake.tables import KeyedTable, Lake

METRICS = ("price_usd", "market_cap_usd", "volume_24h_usd", "price_change_24h_percent", "rank")
ORDER = ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
CUTOFF = "1998-07-01"
STORED_AT = "TIMESTAMP_NTZ '2024-01-01 00:00:00'"
NOW = "TIMESTAMP_NTZ '2024-02-01 00:00:00'"
MOMENT = datetime(2024, 2, 1, tzinfo=timezone.utc)


def _policy(update: tuple[str, ...], stamped: bool = True) -> UpsertPolicy:
    if not stamped:
        return UpsertPolicy(("coin_id", "source"), update)
    return UpsertPolicy(("coin_id", "source"), update, "created_at", ("updated_at",))


def line_quotes(spark: SparkSession, sf_dir: str, nulls: bool = False) -> DataFrame:
    """Line items as a sequence of quotes for part and return flag, in ship order."""
    cap = F.when(F.col("l_discount") < 0.05, F.col("l_quantity")) if nulls else F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("coin_id"),
        F.col("l_returnflag").alias("source"),
        F.col("l_linestatus").alias("name"),
        F.col("l_suppkey").alias("symbol"),
        F.col("l_extendedprice").alias("price_usd"),
        cap.alias("market_cap_usd"),
        F.col("l_tax").alias("volume_24h_usd"),
        F.col("l_discount").alias("price_change_24h_percent"),
        F.col("l_linenumber").alias("rank"),
        *ORDER,
    )


def _stored_and_batch(quotes: DataFrame, policy: UpsertPolicy) -> tuple[DataFrame, DataFrame]:
    """The table after all rows before the cutoff, and the rows after it as one batch."""
    before = F.coalesce(F.col("l_shipdate") < F.expr(f"TIMESTAMP_NTZ '{CUTOFF} 00:00:00'"), F.lit(False))
    stored = fold_batch(quotes.filter(before), policy, ORDER)
    return stored.withColumns({c: F.expr(STORED_AT) for c in policy.stamps}), quotes.filter(~before)


def _upsert(spark: SparkSession, sf_dir: str, update: tuple[str, ...], nulls: bool = False) -> DataFrame:
    policy = _policy(update)
    stored, batch = _stored_and_batch(line_quotes(spark, sf_dir, nulls), policy)
    return upsert(stored, batch, policy, ORDER, F.expr(NOW))


def _upsert_sql(update: tuple[str, ...], nulls: bool = False) -> str:
    """One row after another in ship order: refreshed columns last, others first."""
    cap = "CASE WHEN l_discount < 0.05 THEN l_quantity END" if nulls else "l_quantity"
    columns = ("name", "symbol", *METRICS)
    values = ", ".join(f"{'z' if c in update else 'a'}.{c}" for c in columns)
    return f"""
WITH q AS (
  SELECT l_partkey AS coin_id, l_returnflag AS source, l_linestatus AS name, l_suppkey AS symbol,
         l_extendedprice AS price_usd, {cap} AS market_cap_usd, l_tax AS volume_24h_usd,
         l_discount AS price_change_24h_percent, l_linenumber AS rank,
         l_shipdate < TIMESTAMP '{CUTOFF}' AS early,
         row_number() OVER (PARTITION BY l_partkey, l_returnflag
           ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS up,
         row_number() OVER (PARTITION BY l_partkey, l_returnflag
           ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS down
  FROM lineitem)
SELECT a.coin_id, a.source, {values},
       CASE WHEN a.early THEN TIMESTAMP '2024-01-01' ELSE TIMESTAMP '2024-02-01' END AS created_at,
       CASE WHEN z.early THEN TIMESTAMP '2024-01-01' ELSE TIMESTAMP '2024-02-01' END AS updated_at
FROM q a JOIN q z ON a.coin_id = z.coin_id AND a.source = z.source AND a.up = 1 AND z.down = 1
"""


FULL, NO_RANK, PRICE_ONLY = TICKER.update_columns, MARKET.update_columns, CSV.update_columns


def upsert_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upsert(spark, sf_dir, FULL)


def upsert_no_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upsert(spark, sf_dir, NO_RANK)


def upsert_price_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upsert(spark, sf_dir, PRICE_ONLY)


def upsert_null_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upsert(spark, sf_dir, FULL, nulls=True)


def upsert_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch applied twice leaves what one application leaves."""
    policy = _policy(FULL)
    stored, batch = _stored_and_batch(line_quotes(spark, sf_dir), policy)
    folded = fold_batch(batch, policy, ORDER)
    once = merge(stored, folded, policy, F.expr(NOW))
    return merge(once, folded, policy, F.expr(NOW))


def upsert_delta_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    quotes = line_quotes(spark, sf_dir).select("coin_id", "source", "l_shipdate")
    before = F.coalesce(F.col("l_shipdate") < F.expr(f"TIMESTAMP_NTZ '{CUTOFF} 00:00:00'"), F.lit(False))
    return upsert_delta(quotes.filter(before), quotes.filter(~before), ("coin_id", "source"))


UPSERT_DELTA_COUNTS = f"""
SELECT count(*) FILTER (WHERE NOT known) AS inserted, count(*) FILTER (WHERE known) AS updated
FROM (SELECT bool_or(l_shipdate < TIMESTAMP '{CUTOFF}') AS known
      FROM lineitem GROUP BY l_partkey, l_returnflag
      HAVING bool_or(l_shipdate >= TIMESTAMP '{CUTOFF}'))
"""

TABLE_SCHEMA = T.StructType(
    [
        T.StructField("coin_id", T.LongType()),
        T.StructField("source", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("symbol", T.LongType()),
        *[T.StructField(m, T.IntegerType() if m == "rank" else T.DoubleType()) for m in METRICS],
    ]
)
SLICES = ("1997-06-01", "2000-03-01")


def _slices(quotes: DataFrame) -> list[DataFrame]:
    """Three batches by ship date; rows without one come first."""
    a, b = (F.coalesce(F.col("l_shipdate") >= F.lit(day).cast("date"), F.lit(False)) for day in SLICES)
    return [quotes.filter(~a), quotes.filter(a & ~b), quotes.filter(b)]


def keyed_table_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches applied to a keyed table, the second delivered twice."""
    target = KeyedTable(spark, scratch_path(spark, "keyed"), TABLE_SCHEMA, "coin_id", "source")
    target.create()
    first, second, third = _slices(line_quotes(spark, sf_dir))
    for batch in (first, second, second, third):
        target.upsert(batch, _policy(FULL, stamped=False), ORDER, MOMENT)
    return target.read()


KEYED_TABLE_UPSERT = f"SELECT * EXCLUDE (created_at, updated_at) FROM ({_upsert_sql(FULL)})"


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three arrivals in a landing folder, each taken up by an incremental run."""
    root = scratch_path(spark, "stream")
    quotes = line_quotes(spark, sf_dir)
    target = KeyedTable(spark, f"{root}/table", TABLE_SCHEMA, "coin_id", "source")
    for arrival in _slices(quotes):
        arrival.write.mode("append").parquet(f"{root}/landing")
        stream = spark.readStream.schema(quotes.schema).parquet(f"{root}/landing")
        upsert_stream(stream, target, _policy(FULL, stamped=False), ORDER, f"{root}/checkpoint")
    return target.read()


def stream_late_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three arrivals that are not in the order of their events: an older event changes nothing."""
    root = scratch_path(spark, "late")
    quotes = line_quotes(spark, sf_dir).withColumn("shipped", F.col("l_shipdate").cast("date"))
    schema = T.StructType([*TABLE_SCHEMA.fields, T.StructField("shipped", T.DateType())])
    target = KeyedTable(spark, f"{root}/table", schema, "coin_id", "source")
    policy = UpsertPolicy(("coin_id", "source"), (*METRICS, "shipped"), newer="shipped")
    for lot in range(3):
        quotes.filter(F.col("l_orderkey") % 3 == lot).write.mode("append").parquet(f"{root}/landing")
        stream = spark.readStream.schema(quotes.schema).parquet(f"{root}/landing")
        upsert_stream(stream, target, policy, ORDER, f"{root}/checkpoint")
    return target.read().withColumn("shipped", F.col("shipped").cast("string"))


STREAM_LATE_QUOTES = """
WITH q AS (
  SELECT l_partkey AS coin_id, l_returnflag AS source, l_linestatus AS name, l_suppkey AS symbol,
         l_extendedprice AS price_usd, l_quantity AS market_cap_usd, l_tax AS volume_24h_usd,
         l_discount AS price_change_24h_percent, l_linenumber AS rank, l_shipdate::DATE::VARCHAR AS shipped,
         row_number() OVER (PARTITION BY l_partkey, l_returnflag
           ORDER BY l_orderkey % 3, l_shipdate NULLS FIRST, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS arrival,
         row_number() OVER (PARTITION BY l_partkey, l_returnflag
           ORDER BY l_shipdate DESC NULLS LAST, l_orderkey % 3 DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS latest
  FROM lineitem)
SELECT a.coin_id, a.source, a.name, a.symbol, z.price_usd, z.market_cap_usd, z.volume_24h_usd, z.price_change_24h_percent, z.rank, z.shipped
FROM q a JOIN q z ON a.coin_id = z.coin_id AND a.source = z.source AND a.arrival = 1 AND z.latest = 1
"""


# --- whole loads ----------------------------------------------------------------------


def _land_customers(spark: SparkSession, sf_dir: str, root: str) -> tuple[str, str]:
    """Customers as detail records per line, and the list of entities as array pages."""
    customers = table(spark, sf_dir, "customer")
    return _land_details(customers, f"{root}/detail"), _land_listing(customers, f"{root}/listing", 5)


def _land_details(customers: DataFrame, path: str) -> str:
    usd = F.struct(
        F.col("c_acctbal").alias("price"),
        F.col("c_nationkey").alias("volume_24h"),
        F.col("c_custkey").alias("market_cap"),
        F.lit("n/a").alias("percent_change_24h"),
    )
    # nations 20 and up send a rank that is no integer: rejected records
    rank = F.when(F.col("c_nationkey") >= 20, F.lit("first")).otherwise(F.col("c_nationkey").cast("string"))
    detail = F.struct(
        F.concat(F.lit("c"), "c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.lower("c_mktsegment").alias("symbol"),
        rank.alias("rank"),
        F.struct(usd.alias("USD")).alias("quotes"),
    )
    customers.select(F.to_json(detail)).write.mode("append").text(path)
    return path


def _land_listing(customers: DataFrame, path: str, least: int) -> str:
    """Nations from ``least`` on are active."""
    entity = F.struct(
        F.concat(F.lit("c"), "c_custkey").alias("id"), (F.col("c_nationkey") >= least).alias("is_active")
    )
    pages = customers.groupBy(F.floor(F.col("c_custkey") / 500).alias("page"))
    pages.agg(F.to_json(F.collect_list(entity)).alias("value")).write.mode("append").partitionBy("page").text(path)
    return path


def _land_suppliers(spark: SparkSession, sf_dir: str, root: str) -> str:
    record = F.struct(
        F.concat(F.lit("s"), "s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.lower("s_name").alias("symbol"),
        F.col("s_acctbal").alias("current_price"),
        F.col("s_suppkey").alias("market_cap"),
        F.col("s_nationkey").alias("total_volume"),
    )
    (
        table(spark, sf_dir, "supplier")
        .groupBy(F.floor(F.col("s_suppkey") / 500).alias("page"))
        .agg(F.to_json(F.collect_list(record)).alias("value"))
        .write.partitionBy("page")
        .text(f"{root}/market")
    )
    return f"{root}/market"


def _part_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("p"), "p_partkey").alias("coin_id"),
        F.col("p_name").alias("name"),
        F.when(F.col("p_size") > 45, "NA").otherwise(F.col("p_brand")).alias("symbol"),
        F.col("p_retailprice").alias("price"),
        F.col("p_size").alias("market_cap"),
        F.lit("unknown").alias("volume"),
    )


def _land_parts(spark: SparkSession, sf_dir: str, root: str) -> str:
    _part_rows(spark, sf_dir).write.csv(f"{root}/parts", header=True)
    return f"{root}/parts"


def _loaded(spark: SparkSession, sf_dir: str, loads: int = 1, at_once: int = 1) -> Lake:
    root = scratch_path(spark, "lake")
    inputs = {
        TICKER.name: _land_customers(spark, sf_dir, root),
        MARKET.name: _land_suppliers(spark, sf_dir, root),
        CSV.name: _land_parts(spark, sf_dir, root),
    }
    lake = Lake(spark, f"{root}/lake")
    for _ in range(loads):
        for result in run_all(lake, inputs, attempts=1, at_once=at_once):
            if result.error:
                raise RuntimeError(f"{result.source}: {result.error}")
    return lake


def load_all_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List, detail, market pages and CSV rows, landed and loaded into the unified table."""
    unified = _loaded(spark, sf_dir).unified.read()
    return unified.drop("id", "source_updated_at", "created_at", "updated_at")


LOAD_ALL_SOURCES = """
SELECT concat('c', c_custkey) AS coin_id, c_name AS name, c_mktsegment AS symbol, c_acctbal AS price_usd,
       CAST(c_custkey AS DOUBLE) AS market_cap_usd, CAST(c_nationkey AS DOUBLE) AS volume_24h_usd,
       CAST(NULL AS DOUBLE) AS price_change_24h_percent, CAST(c_nationkey AS INTEGER) AS rank,
       'coinpaprika' AS source
FROM customer WHERE c_nationkey >= 5 AND c_nationkey < 20
UNION ALL
SELECT concat('s', s_suppkey), s_name, upper(s_name), s_acctbal, CAST(s_suppkey AS DOUBLE),
       CAST(s_nationkey AS DOUBLE), NULL, NULL, 'coingecko'
FROM supplier
UNION ALL
SELECT concat('p', p_partkey), p_name, upper(p_brand), p_retailprice, CAST(p_size AS DOUBLE), NULL, NULL, NULL, 'csv'
FROM part WHERE p_size <= 45
"""


def load_side_by_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of all sources at once: rows of the raw histories, the unified table and its defaults."""
    lake = _loaded(spark, sf_dir, loads=2, at_once=3)
    raw = functools.reduce(
        DataFrame.unionByName,
        (lake.raw(spec).agg(F.lit(spec.name).alias("source"), F.count("*").alias("raw_rows"), F.countDistinct("id").alias("raw_ids")) for spec in (TICKER, MARKET, CSV)),
    )
    stamped = F.col("id").isNotNull() & (F.col("created_at") < F.col("updated_at"))
    unified = lake.unified.read().groupBy("source").agg(
        F.count("*").alias("unified_rows"), F.count_if(stamped).alias("stamped_rows"), F.sum("price_usd").cast("decimal(20,2)").cast("double").alias("price_sum")
    )
    return raw.join(unified, "source").join(control.runs(lake).groupBy(F.col("source_name").alias("source")).agg(F.count_if(F.col("status") == "success").alias("runs")), "source")


LOAD_SIDE_BY_SIDE = """
WITH u AS (
  SELECT 'coinpaprika' AS source, c_acctbal AS price FROM customer WHERE c_nationkey >= 5 AND c_nationkey < 20
  UNION ALL SELECT 'coingecko', s_acctbal FROM supplier
  UNION ALL SELECT 'csv', p_retailprice FROM part WHERE p_size <= 45)
SELECT source, 2 * count(*) AS raw_rows, 2 * count(*) AS raw_ids, count(*) AS unified_rows, count(*) AS stamped_rows,
  CAST(CAST(sum(price) AS DECIMAL(20,2)) AS DOUBLE) AS price_sum, 2::BIGINT AS runs
FROM u GROUP BY source
"""


def load_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of all sources as the statistics report shows them."""
    lake = _loaded(spark, sf_dir, loads=2)
    stats = reads.source_stats(control.runs(lake), control.checkpoints(lake))
    health = reads.health(control.checkpoints(lake)).select("source", "last_run_status")
    return stats.join(health, "source").select(
        "source",
        "records_processed",
        "total_runs",
        "success_rate",
        "last_run_status",
        F.col("last_success").isNotNull().alias("has_success"),
        F.col("last_failure").isNotNull().alias("has_failure"),
    )


LOAD_STATISTICS = """
SELECT source, CAST(n AS BIGINT) AS records_processed, CAST(2 AS BIGINT) AS total_runs, CAST(100 AS DOUBLE) AS success_rate,
       'success' AS last_run_status, TRUE AS has_success, FALSE AS has_failure
FROM (SELECT 'coinpaprika' AS source, count(*) AS n FROM customer WHERE c_nationkey >= 5 AND c_nationkey < 20
      UNION ALL SELECT 'coingecko', count(*) FROM supplier
      UNION ALL SELECT 'csv', count(*) FROM part WHERE p_size <= 45)
"""


def checkpoint_after_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checkpoints after a load, a failed load and an empty one: the id is the fetched count, or empty."""
    root = scratch_path(spark, "checkpoints")
    parts, none = _land_parts(spark, sf_dir, root), f"{root}/none"
    spark.range(0).select(F.lit("").alias("value")).write.text(none)
    lake = Lake(spark, f"{root}/lake")
    for inputs in ({CSV.name: parts, TICKER.name: f"{root}/missing"}, {MARKET.name: none}):
        run_all(lake, inputs, attempts=1)
    columns = ("source_name", "last_processed_id", "last_run_status", "records_processed")
    return control.checkpoints(lake).select(*columns, F.col("last_error").isNotNull().alias("has_error"))


CHECKPOINT_AFTER_LOAD = """
SELECT 'csv' AS source_name, CAST(count(*) AS VARCHAR) AS last_processed_id, 'success' AS last_run_status,
       count(*) FILTER (WHERE p_size <= 45) AS records_processed, FALSE AS has_error FROM part
UNION ALL SELECT 'coinpaprika', '', 'failure', 0, TRUE
UNION ALL SELECT 'coingecko', '', 'success', 0, FALSE
"""


def raw_append_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts loaded twice: raw rows double, rejects are kept apart, unified rows do not."""
    root = scratch_path(spark, "raw")
    path = _land_parts(spark, sf_dir, root)
    lake = Lake(spark, f"{root}/lake")
    lake.create_tables()
    for batch_id in ("first", "second"):
        load_batch(lake, CSV, scan_source(spark, CSV, path), batch_id, MOMENT)
    raw = lake.raw(CSV).groupBy("symbol").agg(F.count("*").alias("rows"))
    bad = (
        lake.quarantine(CSV)
        .groupBy(F.array_join(REASONS, ",").alias("symbol"))
        .agg(F.count("*").alias("rows"))
    )
    unified = lake.unified.read().agg(F.lit("unified").alias("symbol"), F.count("*").alias("rows"))
    return raw.unionByName(bad).unionByName(unified)


RAW_APPEND_COUNTS = """
SELECT p_brand AS symbol, 2 * count(*) AS rows FROM part WHERE p_size <= 45 GROUP BY p_brand
UNION ALL SELECT 'symbol_invalid', 2 * count(*) FROM part WHERE p_size > 45
UNION ALL SELECT 'unified', count(*) FROM part WHERE p_size <= 45
"""


def load_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four polls of the same entities, loaded at once with the shipped spec: the last price counts."""
    root = scratch_path(spark, "polls")
    for poll in range(4):
        record = F.struct(
            F.concat(F.lit("s"), "s_suppkey").alias("id"),
            F.col("s_name").alias("name"),
            F.col("s_name").alias("symbol"),
            (F.col("s_suppkey") + poll).alias("current_price"),
        )
        pages = table(spark, sf_dir, "supplier").groupBy(F.floor(F.col("s_suppkey") / 500).alias("page"))
        pages.agg(F.to_json(F.collect_list(record)).alias("value")).write.mode("append").partitionBy("page").text(f"{root}/market")
    lake = Lake(spark, f"{root}/lake")
    (result,) = run_all(lake, {MARKET.name: f"{root}/market"}, attempts=1)
    return lake.unified.read().select("coin_id", "price_usd", F.lit(result.processed).cast("bigint").alias("processed"))


LOAD_POLLS = """
SELECT concat('s', s_suppkey) AS coin_id, CAST(s_suppkey + 3 AS DOUBLE) AS price_usd, (SELECT 4 * count(*) FROM supplier) AS processed
FROM supplier
"""


def top_n_per_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three largest of each landed listing, one listing file per nation and range of keys."""
    path = scratch_path(spark, "listings")
    record = F.struct(F.concat(F.lit("s"), "s_suppkey").alias("id"), F.col("s_acctbal").alias("market_cap"))
    lists = table(spark, sf_dir, "supplier").groupBy("s_nationkey", F.floor(F.col("s_suppkey") / 5000).alias("range"))
    lists.agg(F.to_json(F.collect_list(record)).alias("value")).write.partitionBy("s_nationkey", "range").text(path)
    top = market_top_records(scan_json(spark, path, "json_array"), n=3)
    return top.select(F.expr("variant_get(record, '$.id', 'string')").alias("id"))


TOP_N_PER_LISTING = """
SELECT concat('s', s_suppkey) AS id FROM supplier
QUALIFY row_number() OVER (PARTITION BY s_nationkey, s_suppkey // 5000 ORDER BY s_acctbal DESC, '"s' || s_suppkey || '"') <= 3
"""


def drift_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drift of one batch delivered twice, stored row by row and summed up by field."""
    path = scratch_path(spark, "drifting")
    part = table(spark, sf_dir, "part")
    record = F.struct(
        F.concat(F.lit("p"), "p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("symbol"),
        F.when(F.col("p_size") > 25, F.col("p_size")).alias("rank"),
        F.create_map().cast("map<string,string>").alias("quotes"),
    )
    part.select(F.to_json(record)).write.text(path)
    found = []
    for form in ("rows", "summary"):
        lake = Lake(spark, f"{path}-{form}")
        lake.create_tables()
        for _ in range(2):
            load_batch(lake, TICKER, scan_source(spark, TICKER, path), "one", MOMENT, form)
        sums = lake.drift.read().groupBy("drift_type", "field_name")
        found.append(sums.agg(F.sum("occurrences").alias("occurrences")).withColumn("form", F.lit(form)))
    return found[0].unionByName(found[1])


DRIFT_LOG = """
SELECT 'missing_field' AS drift_type, 'rank' AS field_name, count(*)::BIGINT AS occurrences, form
FROM part, (VALUES ('rows'), ('summary')) AS f(form) WHERE p_size <= 25 GROUP BY form
"""


def keyed_table_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups with characters that a file system reserves are found again."""
    target = KeyedTable(spark, scratch_path(spark, "groups"), TABLE_SCHEMA, "coin_id", "source")
    target.create()
    names = F.array(*(F.lit(n) for n in ("a/b", "x=y", "a:b", "50%")))
    quotes = line_quotes(spark, sf_dir).withColumn("source", F.element_at(names, (F.col("coin_id") % 4 + 1).cast("int")))
    target.upsert(quotes, _policy(FULL, stamped=False), ORDER, MOMENT)
    return target.read().select("coin_id", "source")


KEYED_TABLE_GROUPS = """
SELECT DISTINCT l_partkey AS coin_id, ['a/b', 'x=y', 'a:b', '50%'][(l_partkey % 4 + 1)::INT] AS source FROM lineitem
"""


def raw_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw history of the market source after two loads, with a field that no spec knows."""
    root = scratch_path(spark, "raw")
    record = F.struct(
        F.concat(F.lit("s"), "s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.lower("s_name").alias("symbol"),
        F.col("s_nationkey").alias("unknown"),
    )
    pages = table(spark, sf_dir, "supplier").groupBy(F.floor(F.col("s_suppkey") / 500).alias("page"))
    pages.agg(F.to_json(F.collect_list(record)).alias("value")).write.partitionBy("page").text(f"{root}/market")
    lake = Lake(spark, f"{root}/lake")
    for _ in range(2):
        run_all(lake, {MARKET.name: f"{root}/market"}, attempts=1)
    unknown = F.expr("variant_get(raw_data, '$.unknown', 'bigint')").alias("unknown")
    return lake.raw(MARKET).select("coin_id", "symbol", unknown)


RAW_MARKET = """
SELECT concat('s', s_suppkey) AS coin_id, lower(s_name) AS symbol, s_nationkey::BIGINT AS unknown
FROM supplier, (VALUES (1), (2)) AS loads(n)
"""


def raw_ticker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw history of the ticker source after two loads, with the times that a load fills in."""
    root = scratch_path(spark, "raw_ticker")
    usd = F.struct(F.col("c_acctbal").cast("string").alias("price"), F.lit("n/a").alias("volume_24h"))
    record = F.struct(
        F.concat(F.lit("c"), "c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.lower("c_mktsegment").alias("symbol"),
        F.struct(usd.alias("USD")).alias("quotes"),
    )
    table(spark, sf_dir, "customer").select(F.to_json(record)).write.text(f"{root}/ticker")
    lake = Lake(spark, f"{root}/lake")
    for _ in range(2):
        run_all(lake, {TICKER.name: f"{root}/ticker"}, attempts=1)
    quoted = F.expr("variant_get(raw_data, '$.quotes.USD.price', 'string')").alias("quoted")
    history = lake.raw(TICKER).select("coin_id", "symbol", quoted, F.col("ingested_at").isNotNull().alias("stamped"))
    now = lake.unified.read(TICKER.name)
    filled = [F.col(c).isNotNull() for c in ("id", "created_at", "updated_at", "source_updated_at")]
    kept = now.select("coin_id", "price_usd", functools.reduce(lambda a, b: a & b, filled).alias("filled"))
    return history.join(kept, "coin_id")


RAW_TICKER = """
SELECT concat('c', c_custkey) AS coin_id, lower(c_mktsegment) AS symbol,
       CAST(CAST(c_acctbal AS DECIMAL(18, 2)) AS DOUBLE)::VARCHAR AS quoted, TRUE AS stamped,
       CAST(c_acctbal AS DOUBLE) AS price_usd, TRUE AS filled
FROM customer, (VALUES (1), (2)) AS loads(n)
"""


def stream_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files arriving in two lots, loaded incrementally; the run log counts each."""
    root = scratch_path(spark, "arrivals")
    lake = Lake(spark, f"{root}/lake")
    rows = _part_rows(spark, sf_dir)
    cheap = F.col("price") < 1000
    for lot in (rows.filter(cheap), rows.filter(~cheap)):
        lot.write.mode("append").csv(f"{root}/landing", header=True)
        load_new_files(lake, CSV, f"{root}/landing", f"{root}/checkpoint")
    # a run without new files adds nothing
    load_new_files(lake, CSV, f"{root}/landing", f"{root}/checkpoint")
    done = control.runs(lake).agg(
        F.sum("records_processed").alias("processed"), F.sum("records_failed").alias("failed")
    )
    kept = lake.unified.read().agg(
        F.count("*").alias("quotes"), F.countDistinct("coin_id").alias("coins"), F.max("price_usd").alias("top")
    )
    return done.crossJoin(kept)  # one row beside one row


STREAM_LOAD = """
SELECT CAST(count(*) FILTER (WHERE p_size <= 45) AS BIGINT) AS processed,
       CAST(count(*) FILTER (WHERE p_size > 45) AS BIGINT) AS failed,
       count(*) FILTER (WHERE p_size <= 45) AS quotes, count(DISTINCT p_partkey) FILTER (WHERE p_size <= 45) AS coins,
       max(p_retailprice) FILTER (WHERE p_size <= 45) AS top
FROM part
"""

def stream_listed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Details arriving in two lots, each against the listing of its time; a run without new files adds nothing."""
    root = scratch_path(spark, "listed")
    lake = Lake(spark, f"{root}/lake")
    customers = table(spark, sf_dir, "customer")
    even = F.col("c_custkey") % 2 == 0
    for lot, least in ((customers.filter(even), 10), (customers.filter(~even), 5), (None, 0)):
        listing = _land_listing(customers, f"{root}/listing", least)
        if lot is not None:
            _land_details(lot, f"{root}/detail")
        load_new_files(lake, TICKER, f"{root}/detail", f"{root}/checkpoint", listing_path=listing)
    counts = control.runs(lake).agg(F.sum("records_processed").alias("processed"), F.sum("records_failed").alias("failed"))
    rows = lake.unified.read().select("coin_id", "name", "symbol", "price_usd", "market_cap_usd", "volume_24h_usd", "rank", "source")
    return rows.crossJoin(F.broadcast(counts))  # one row beside every row


STREAM_LISTED_LOAD = """
WITH listed AS (
  SELECT * FROM customer WHERE c_nationkey >= CASE WHEN c_custkey % 2 = 0 THEN 10 ELSE 5 END
)
SELECT concat('c', c_custkey) AS coin_id, c_name AS name, c_mktsegment AS symbol, c_acctbal AS price_usd,
       CAST(c_custkey AS DOUBLE) AS market_cap_usd, CAST(c_nationkey AS DOUBLE) AS volume_24h_usd,
       CAST(c_nationkey AS INTEGER) AS rank, 'coinpaprika' AS source,
       (SELECT count(*) FROM listed WHERE c_nationkey < 20)::BIGINT AS processed,
       (SELECT count(*) FROM listed WHERE c_nationkey >= 20)::BIGINT AS failed
FROM listed WHERE c_nationkey < 20
"""


def raw_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows of the first source from three days, read from the second load on, that load excluded."""
    root = scratch_path(spark, "since")
    customers = table(spark, sf_dir, "customer")
    lake = Lake(spark, f"{root}/lake")
    lake.create_tables()
    days = [datetime(2024, 2, day, hour, tzinfo=timezone.utc) for day, hour in ((1, 23), (2, 0), (2, 1), (3, 5))]
    for n, moment in enumerate(days):
        path = _land_details(customers.filter(F.col("c_custkey") % 4 == n), f"{root}/detail-{n}")
        for _ in range(2):  # each batch is delivered twice
            load_batch(lake, TICKER, scan_source(spark, TICKER, path), f"lot-{n}", moment)
    rows = lake.raw_since(TICKER, days[1])
    name = F.expr("variant_get(raw_data, '$.name', 'string')")
    return rows.select("coin_id", "symbol", "rank", "price_usd", name.alias("name"), F.col("ingest_date").cast("string").alias("day"), "batch_id")


RAW_SINCE = """
SELECT concat('c', c_custkey) AS coin_id, lower(c_mktsegment) AS symbol, c_nationkey::INTEGER AS rank, c_acctbal AS price_usd, c_name AS name,
       CASE c_custkey % 4 WHEN 2 THEN '2024-02-02' ELSE '2024-02-03' END AS day, concat('lot-', c_custkey % 4) AS batch_id
FROM customer WHERE c_custkey % 4 >= 2 AND c_nationkey < 20
"""


def drift_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads: a missing field that comes back, an unknown one that stays, and one that turns up last."""
    root = scratch_path(spark, "cycle")
    part = table(spark, sf_dir, "part")
    lake = Lake(spark, f"{root}/lake")
    lake.create_tables()
    small = F.col("p_size") <= 25
    for n in range(3):
        fields = [
            F.concat(F.lit("p"), "p_partkey").alias("id"),
            F.col("p_name").alias("name"),
            F.col("p_brand").alias("symbol"),
            (F.when(~small, F.col("p_size")) if n == 0 else F.col("p_size")).alias("rank"),
            F.create_map().cast("map<string,string>").alias("quotes"),
        ]
        fields += [F.when(small, "x").alias("extra")] if n < 2 else [F.lit(True).alias("late")]
        part.select(F.to_json(F.struct(*fields))).write.text(f"{root}/{n}")
        moment = datetime(2024, 2, 1 + n, tzinfo=timezone.utc)
        run_source(lake, TICKER, lambda n=n: scan_source(spark, TICKER, f"{root}/{n}"), "summary", clock=lambda moment=moment: moment, run_id=f"run-{n}")
    day = lambda c: F.to_date(c).cast("string").alias(c)
    state = control.drift_state(lake)
    return state.select("drift_type", "field_name", "actual_type", "occurrences", *map(day, ("first_seen", "last_seen", "resolved_at")), "resolved")


DRIFT_STATE = """
WITH n AS (SELECT count(*)::BIGINT AS a, count(*) FILTER (WHERE p_size <= 25)::BIGINT AS s FROM part)
SELECT 'missing_field' AS drift_type, 'rank' AS field_name, NULL AS actual_type, s AS occurrences, '2024-02-01' AS first_seen,
       '2024-02-01' AS last_seen, '2024-02-02' AS resolved_at, TRUE AS resolved FROM n
UNION ALL SELECT 'new_field', 'extra', 'str', 2 * s, '2024-02-01', '2024-02-02', '2024-02-03', TRUE FROM n
UNION ALL SELECT 'new_field', 'late', 'bool', a, '2024-02-03', '2024-02-03', NULL, FALSE FROM n
"""

QUERIES = {
    "upsert_full": upsert_full,
    "upsert_no_rank": upsert_no_rank,
    "upsert_price_only": upsert_price_only,
    "upsert_null_overwrite": upsert_null_overwrite,
    "upsert_idempotent": upsert_idempotent,
    "upsert_delta": upsert_delta_counts,
    "keyed_table_upsert": keyed_table_upsert,
    "stream_upsert": stream_upsert,
    "load_all_sources": load_all_sources,
    "load_side_by_side": load_side_by_side,
    "load_statistics": load_statistics,
    "checkpoint_after_load": checkpoint_after_load,
    "raw_append_counts": raw_append_counts,
    "stream_load": stream_load,
    "load_polls": load_polls,
    "top_n_per_listing": top_n_per_listing,
    "drift_log": drift_log,
    "keyed_table_groups": keyed_table_groups,
    "raw_market": raw_market,
    "raw_ticker": raw_ticker,
    "drift_state": drift_state,
    "raw_since": raw_since,
    "stream_listed_load": stream_listed_load,
    "stream_late_quotes": stream_late_quotes,
}

ORACLE = {
    "upsert_full": _upsert_sql(FULL),
    "upsert_no_rank": _upsert_sql(NO_RANK),
    "upsert_price_only": _upsert_sql(PRICE_ONLY),
    "upsert_null_overwrite": _upsert_sql(FULL, nulls=True),
    "upsert_idempotent": _upsert_sql(FULL),
    "upsert_delta": UPSERT_DELTA_COUNTS,
    "keyed_table_upsert": KEYED_TABLE_UPSERT,
    "stream_upsert": KEYED_TABLE_UPSERT,
    "load_all_sources": LOAD_ALL_SOURCES,
    "load_side_by_side": LOAD_SIDE_BY_SIDE,
    "load_statistics": LOAD_STATISTICS,
    "checkpoint_after_load": CHECKPOINT_AFTER_LOAD,
    "raw_append_counts": RAW_APPEND_COUNTS,
    "stream_load": STREAM_LOAD,
    "load_polls": LOAD_POLLS,
    "top_n_per_listing": TOP_N_PER_LISTING,
    "drift_log": DRIFT_LOG,
    "keyed_table_groups": KEYED_TABLE_GROUPS,
    "raw_market": RAW_MARKET,
    "raw_ticker": RAW_TICKER,
    "drift_state": DRIFT_STATE,
    "raw_since": RAW_SINCE,
    "stream_listed_load": STREAM_LISTED_LOAD,
    "stream_late_quotes": STREAM_LATE_QUOTES,
}
