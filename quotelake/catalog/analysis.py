"""Control state, drift, quote pages, run reports and request metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.catalog import table
from quotelake.catalog.records import unified_tables
from quotelake.operators import drift, metrics
from quotelake.operators.paging import number_rows
from quotelake.plans import control, reads
from quotelake.session import scratch_path
from quotelake.streaming.running_metrics import latest, publish_complete

DETECTED_AT = "TIMESTAMP_NTZ '2024-01-31 06:00:00'"


# --- control state ----------------------------------------------------------------------


def checkpoint_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as checkpoint updates, one source per priority."""
    won = F.col("o_orderstatus") == "F"
    events = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("source_name"),
        F.col("o_orderkey").cast("string").alias("last_processed_id"),
        F.col("o_orderdate").alias("last_processed_timestamp"),
        F.col("o_custkey").cast("int").alias("records_processed"),
        F.when(won, "success").otherwise("failure").alias("last_run_status"),
        F.when(~won, F.concat(F.lit("status "), "o_orderstatus")).alias("last_error"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderdate").alias("updated_at"),
        "o_orderkey",
    )
    return control.fold_checkpoints(events, ("updated_at", "o_orderkey"))


CHECKPOINT_UPSERT = """
WITH e AS (
  SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) AS down
  FROM orders)
SELECT o_orderpriority AS source_name, CAST(o_orderkey AS VARCHAR) AS last_processed_id,
       o_orderdate AS last_processed_timestamp, CAST(o_custkey AS INTEGER) AS records_processed,
       CASE WHEN o_orderstatus = 'F' THEN 'success' ELSE 'failure' END AS last_run_status,
       CASE WHEN o_orderstatus <> 'F' THEN concat('status ', o_orderstatus) END AS last_error,
       (SELECT min(o_orderdate) FROM orders f WHERE f.o_orderpriority = e.o_orderpriority) AS created_at,
       o_orderdate AS updated_at
FROM e WHERE down = 1
"""

# The number in the event's properties, 0 to 99, stands for one of four sources.
SOURCE = "concat('s', CAST(floor(CAST(get_json_object(props, '$.k') AS INT) / 25) AS STRING))"
_SOURCE_SQL = "concat('s', CAST(json_extract_string(props, '$.k') AS INTEGER) // 25)"
STATUS = "CASE event_type WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'failed' ELSE 'started' END"
DONE = "CASE WHEN event_type IN ('purchase', 'error') THEN ts END"


def _run_events(spark: SparkSession, sf_dir: str, run_id: str = "event_id") -> DataFrame:
    """Events as runs: purchases succeeded, errors failed, the rest only started."""
    return table(spark, sf_dir, "events").select(
        F.col(run_id).cast("string").alias("run_id"),
        F.expr(SOURCE).alias("source_name"),
        F.expr(STATUS).alias("status"),
        F.col("user_id").cast("int").alias("records_processed"),
        F.length("props").alias("records_failed"),
        F.expr("CASE WHEN event_type IN ('purchase', 'error') THEN value END").alias("duration_seconds"),
        F.expr("CASE WHEN event_type = 'error' THEN props END").alias("error_message"),
        F.col("props").alias("run_metadata"),
        F.col("ts").alias("started_at"),
        F.expr(DONE).alias("completed_at"),
    )


def run_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events of a user as the events of one run, in time order."""
    events = _run_events(spark, sf_dir, "user_id").withColumn("at", F.col("started_at"))
    return control.fold_runs(events, ("at",))


RUN_FOLD = f"""
WITH e AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS up,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS down
  FROM events)
SELECT CAST(z.user_id AS VARCHAR) AS run_id, concat('s', CAST(json_extract_string(a.props, '$.k') AS INTEGER) // 25) AS source_name,
       CASE z.event_type WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'failed' ELSE 'started' END AS status,
       CAST(z.user_id AS INTEGER) AS records_processed, CAST(length(z.props) AS INTEGER) AS records_failed,
       CASE WHEN z.event_type IN ('purchase', 'error') THEN z.value END AS duration_seconds,
       CASE WHEN z.event_type = 'error' THEN z.props END AS error_message,
       a.props AS run_metadata, a.ts AS started_at,
       CASE WHEN z.event_type IN ('purchase', 'error') THEN z.ts END AS completed_at
FROM e z JOIN e a ON z.user_id = a.user_id AND z.down = 1 AND a.up = 1
"""


def incremental_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events after the checkpoint time."""
    last = F.expr("TIMESTAMP_NTZ '2024-01-15 12:00:00'")
    return control.read_since(table(spark, sf_dir, "events"), "ts", last).select("event_id", "ts", "value")


INCREMENTAL_READ = "SELECT event_id, ts, value FROM events WHERE ts > TIMESTAMP '2024-01-15 12:00:00'"


# --- drift ------------------------------------------------------------------------------


def _event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON; the type decides which fields a record has and of what type."""
    kind = F.col("event_type")
    record = F.struct(
        F.col("event_id").alias("id"),
        F.when(kind != "signup", F.col("value")).alias("price"),
        F.when(kind == "click", F.col("user_id").cast("string")).alias("symbol"),
        F.when(kind == "view", F.struct("user_id")).alias("owner"),
        F.when(kind == "error", F.array("user_id", "event_id")).alias("trail"),
        F.when(kind == "purchase", F.lit(True)).alias("paid"),
    )
    return table(spark, sf_dir, "events").select("event_id", F.parse_json(F.to_json(record)).alias("record"))


EXPECTED = {"id": "str", "price": "float", "symbol": "str"}


def _event_drift(spark: SparkSession, sf_dir: str, kind: str | None = None) -> DataFrame:
    found = drift.detect(
        _event_records(spark, sf_dir), EXPECTED, "events", F.expr(DETECTED_AT), keep=("event_id",)
    )
    return found.filter(F.col("drift_type") == kind) if kind else found


def drift_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_drift(spark, sf_dir, "missing_field")


def drift_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_drift(spark, sf_dir, "new_field")


def drift_type_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_drift(spark, sf_dir, "type_change")


_TAIL = "TIMESTAMP '2024-01-31 06:00:00' AS detected_at, FALSE AS resolved"
DRIFT_MISSING = f"""
SELECT event_id, 'events' AS source_name, 'missing_field' AS drift_type, 'price' AS field_name,
       'float' AS expected_type, CAST(NULL AS VARCHAR) AS actual_type, CAST(1 AS DOUBLE) AS confidence_score,
       CAST(NULL AS VARCHAR) AS sample_value, {_TAIL}
FROM events WHERE event_type = 'signup'
UNION ALL
SELECT event_id, 'events', 'missing_field', 'symbol', 'str', NULL, 1, NULL, {_TAIL}
FROM events WHERE event_type <> 'click'
"""
DRIFT_NEW = f"""
SELECT event_id, 'events' AS source_name, 'new_field' AS drift_type,
       CASE event_type WHEN 'view' THEN 'owner' WHEN 'error' THEN 'trail' ELSE 'paid' END AS field_name,
       CAST(NULL AS VARCHAR) AS expected_type,
       CASE event_type WHEN 'view' THEN 'dict' WHEN 'error' THEN 'list' ELSE 'bool' END AS actual_type,
       CAST(0.8 AS DOUBLE) AS confidence_score,
       CASE event_type WHEN 'view' THEN concat('{{"user_id":', user_id, '}}')
            WHEN 'error' THEN concat('[', user_id, ',', event_id, ']') ELSE 'True' END AS sample_value, {_TAIL}
FROM events WHERE event_type IN ('view', 'error', 'purchase')
"""
DRIFT_TYPE_CHANGE = f"""
SELECT event_id, 'events' AS source_name, 'type_change' AS drift_type, 'id' AS field_name,
       'str' AS expected_type, 'int' AS actual_type, CAST(0.9 AS DOUBLE) AS confidence_score,
       CAST(event_id AS VARCHAR) AS sample_value, {_TAIL}
FROM events
"""


def drift_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.summarize(_event_drift(spark, sf_dir))


DRIFT_SUMMARY = f"""
SELECT source_name, drift_type, field_name, expected_type, actual_type, count(*) AS occurrences,
       max(confidence_score) AS confidence_score, min(sample_value) AS sample_value
FROM ({DRIFT_MISSING} UNION ALL {DRIFT_NEW} UNION ALL {DRIFT_TYPE_CHANGE})
GROUP BY ALL
"""


def drift_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New fields of whole documents; the sample is the first 200 characters by definition."""
    records = table(spark, sf_dir, "documents").select(
        "doc_id", F.parse_json(F.to_json(F.struct("doc_id", "text", "lang", "source"))).alias("record")
    )
    found = drift.detect(
        records, {"doc_id": "int", "lang": "str"}, "documents", F.expr(DETECTED_AT), keep=("doc_id",)
    )
    return found.select("doc_id", "drift_type", "field_name", "actual_type", "sample_value")


DRIFT_DOCUMENTS = """
SELECT doc_id, 'new_field' AS drift_type, 'text' AS field_name, 'str' AS actual_type,
       substring(text, 1, 200) AS sample_value FROM documents
UNION ALL SELECT doc_id, 'new_field', 'source', 'str', source FROM documents
"""


# --- quote pages ------------------------------------------------------------------------


def _order_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderkey").cast("string").alias("coin_id"),
        F.concat(F.lit("Order "), "o_orderkey").alias("name"),
        F.col("o_orderstatus").alias("symbol"),
        F.col("o_totalprice").alias("price_usd"),
        F.col("o_custkey").cast("double").alias("market_cap_usd"),
        F.lit(None).cast("double").alias("volume_24h_usd"),
        F.lit(None).cast("double").alias("price_change_24h_percent"),
        F.col("o_custkey").cast("int").alias("rank"),
        F.col("o_orderpriority").alias("source"),
        F.col("o_orderdate").alias("updated_at"),
    )


_ORDER_QUOTES = """
SELECT o_orderkey AS id, CAST(o_orderkey AS VARCHAR) AS coin_id, concat('Order ', o_orderkey) AS name,
       o_orderstatus AS symbol, o_totalprice AS price_usd, CAST(o_custkey AS DOUBLE) AS market_cap_usd,
       CAST(NULL AS DOUBLE) AS volume_24h_usd, CAST(NULL AS DOUBLE) AS price_change_24h_percent,
       CAST(o_custkey AS INTEGER) AS rank, o_orderpriority AS source, o_orderdate AS updated_at
FROM orders
"""
_PAGE = "ORDER BY updated_at DESC NULLS FIRST, source, coin_id LIMIT {n} OFFSET {k}"


def quote_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.quote_page(_order_quotes(spark, sf_dir), page=3, page_size=100)[0]


def quote_page_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page beyond the depth of a top-k."""
    return reads.quote_page(_order_quotes(spark, sf_dir), page=40, page_size=100)[0]


def quote_page_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deep page of one source, found with the sketches that were stored beside the quotes."""
    quotes, path = _order_quotes(spark, sf_dir), scratch_path(spark, "sketch")
    reads.page_sketch(quotes).write.parquet(path)
    return reads.quote_page(quotes, page=25, page_size=100, source="1-URGENT", sketch=spark.read.parquet(path))[0]


def quote_page_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page after the last row of the fifth."""
    quotes = _order_quotes(spark, sf_dir)
    last = reads.quote_page(quotes, page=5, page_size=100)[0].collect()[-1]
    return reads.quote_page_after(quotes, last.asDict(), page_size=100)


def quote_page_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.quote_page(_order_quotes(spark, sf_dir), page=2, source="1-URGENT")[0]


def quote_page_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.quote_page(_order_quotes(spark, sf_dir), page_size=50, symbol="f")[0]


def quote_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.quote_page(_order_quotes(spark, sf_dir), source="1-URGENT", symbol="o")[1]


def quote_page_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page of every quote at 20 a page: the numbering behind pages of any depth."""
    quotes = _order_quotes(spark, sf_dir).select("coin_id", "source", "updated_at")
    numbered = number_rows(quotes, reads.PAGE_ORDER)
    page = (F.floor(F.col("position") / 20) + 1).alias("page")
    return numbered.select("coin_id", "source", "updated_at", "position", page)


QUOTE_PAGE_NUMBERS = """
SELECT coin_id, source, updated_at, position, position // 20 + 1 AS page
FROM (SELECT CAST(o_orderkey AS VARCHAR) AS coin_id, o_orderpriority AS source, o_orderdate AS updated_at,
             row_number() OVER (ORDER BY o_orderdate DESC, o_orderpriority, CAST(o_orderkey AS VARCHAR)) - 1 AS position
      FROM orders)
"""


def unified_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship read: all tables unified, filtered and paged."""
    quotes = unified_tables(spark, sf_dir).withColumn("updated_at", F.col("source_updated_at"))
    rows, _ = reads.quote_page(quotes, page=2, page_size=100, symbol="machinery")
    return rows.drop("updated_at")


UNIFIED_PAGE = """
SELECT CAST(c_custkey AS VARCHAR) AS coin_id, c_name AS name, c_mktsegment AS symbol, c_acctbal AS price_usd,
       CAST(c_custkey AS DOUBLE) AS market_cap_usd, CAST(c_nationkey AS DOUBLE) AS volume_24h_usd,
       CAST(NULL AS DOUBLE) AS price_change_24h_percent, CAST(c_nationkey AS INTEGER) AS rank,
       'coinpaprika' AS source
FROM customer WHERE c_mktsegment = 'MACHINERY' ORDER BY CAST(c_custkey AS VARCHAR) LIMIT 100 OFFSET 100
"""


# --- run reports ------------------------------------------------------------------------

LISTED = ["s0", "s1", "s2", "s3", "idle"]
_LISTED_SQL = "(VALUES ('s0'), ('s1'), ('s2'), ('s3'), ('idle')) AS listed(source)"


def recent_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.recent_runs(_run_events(spark, sf_dir), limit=100, source="s1")


RECENT_RUNS = f"""
SELECT CAST(event_id AS VARCHAR) AS run_id, {_SOURCE_SQL} AS source_name, {STATUS} AS status,
       CAST(user_id AS INTEGER) AS records_processed, CAST(length(props) AS INTEGER) AS records_failed,
       CASE WHEN event_type IN ('purchase', 'error') THEN value END AS duration_seconds,
       ts AS started_at, {DONE} AS completed_at, CASE WHEN event_type = 'error' THEN props END AS error_message
FROM events WHERE {_SOURCE_SQL} = 's1' ORDER BY ts DESC LIMIT 100
"""


def _event_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        F.expr(SOURCE).alias("source_name"),
        F.col("event_id").cast("string").alias("last_processed_id"),
        F.col("ts").alias("last_processed_timestamp"),
        F.col("user_id").cast("int").alias("records_processed"),
        F.when(F.col("event_type") == "error", "failure").otherwise("success").alias("last_run_status"),
        F.lit(None).cast("string").alias("last_error"),
        F.col("ts").alias("created_at"),
        F.col("ts").alias("updated_at"),
    )
    return control.fold_checkpoints(events)


def source_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.source_stats(_run_events(spark, sf_dir), _event_checkpoints(spark, sf_dir), LISTED)


SOURCE_STATS = f"""
WITH e AS (SELECT *, {_SOURCE_SQL} AS source, {STATUS} AS status FROM events),
runs AS (
  SELECT source, count(*) AS n, count(*) FILTER (WHERE status = 'success') AS won,
         max(ts) FILTER (WHERE status = 'success') AS last_success,
         max(ts) FILTER (WHERE status = 'failed') AS last_failure,
         arg_max(value, ts) FILTER (WHERE status = 'success') AS seconds,
         arg_max(user_id, ts) AS processed
  FROM e GROUP BY source)
SELECT source, CAST(coalesce(processed, 0) AS INTEGER) AS records_processed, last_success, last_failure,
       seconds AS last_run_duration_seconds, coalesce(n, 0) AS total_runs,
       coalesce(CAST(round_even(won / n * 100, 2) AS DOUBLE), 0) AS success_rate
FROM {_LISTED_SQL} LEFT JOIN runs USING (source)
"""


def health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.health(_event_checkpoints(spark, sf_dir), LISTED)


HEALTH = f"""
WITH last AS (
  SELECT {_SOURCE_SQL} AS source, arg_max(event_type, ts) AS kind, max(ts) AS seen_at,
         arg_max(user_id, ts) AS processed
  FROM events GROUP BY 1)
SELECT source,
       CASE WHEN kind IS NULL THEN 'never_run' WHEN kind = 'error' THEN 'failure' ELSE 'success' END AS last_run_status,
       seen_at AS last_run_time, CAST(coalesce(processed, 0) AS INTEGER) AS records_processed
FROM {_LISTED_SQL} LEFT JOIN last USING (source)
"""


# --- request metrics --------------------------------------------------------------------


def _requests(events: DataFrame) -> DataFrame:
    return events.select(
        F.concat(F.lit("/"), "event_type").alias("endpoint"),
        F.when(F.col("value") < 50, "GET").otherwise("POST").alias("method"),
        (F.col("value") / 100).alias("duration_seconds"),
    )


def request_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.request_counter(_requests(table(spark, sf_dir, "events")))


REQUEST_COUNTER = """
SELECT concat('/', event_type) AS endpoint, CASE WHEN value < 50 THEN 'GET' ELSE 'POST' END AS method,
       count(*) AS requests
FROM events GROUP BY ALL
"""


def latency_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    histogram = metrics.latency_histogram(_requests(table(spark, sf_dir, "events")))
    # durations have four decimals, so rounding there undoes the order of addition
    return histogram.withColumn("total_seconds", F.round("total_seconds", 4))


_BOUNDS = ", ".join(f"('{b}', {b})" for b in metrics.DEFAULT_BUCKETS)
LATENCY_HISTOGRAM = f"""
SELECT le, (SELECT count(*) FROM events WHERE value / 100 <= bound) AS bucket_count,
       (SELECT count(*) FROM events) AS total_count,
       (SELECT round(sum(value / 100), 4) FROM events) AS total_seconds
FROM (VALUES {_BOUNDS}, ('+Inf', CAST('inf' AS DOUBLE))) AS buckets(le, bound)
"""


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "metrics")
    counts = metrics.request_counter(_requests(_event_stream(spark, sf_dir)))
    publish_complete(counts, f"{root}/counts", f"{root}/checkpoint")
    return latest(spark, f"{root}/counts")


def stream_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "histogram")
    histogram = metrics.latency_histogram(_requests(_event_stream(spark, sf_dir)))
    publish_complete(histogram, f"{root}/buckets", f"{root}/checkpoint")
    return latest(spark, f"{root}/buckets").withColumn("total_seconds", F.round("total_seconds", 4))


QUERIES = {
    "checkpoint_upsert": checkpoint_upsert,
    "run_fold": run_fold,
    "incremental_read": incremental_read,
    "drift_missing": drift_missing,
    "drift_new": drift_new,
    "drift_type_change": drift_type_change,
    "drift_summary": drift_summary,
    "drift_documents": drift_documents,
    "quote_page": quote_page,
    "quote_page_deep": quote_page_deep,
    "quote_page_sketched": quote_page_sketched,
    "quote_page_after": quote_page_after,
    "quote_page_source": quote_page_source,
    "quote_page_symbol": quote_page_symbol,
    "quote_total": quote_total,
    "quote_page_numbers": quote_page_numbers,
    "unified_page": unified_page,
    "recent_runs": recent_runs,
    "source_stats": source_stats,
    "health": health,
    "request_counter": request_counter,
    "latency_histogram": latency_histogram,
    "stream_metrics": stream_metrics,
    "stream_histogram": stream_histogram,
}

ORACLE = {
    "checkpoint_upsert": CHECKPOINT_UPSERT,
    "run_fold": RUN_FOLD,
    "incremental_read": INCREMENTAL_READ,
    "drift_missing": DRIFT_MISSING,
    "drift_new": DRIFT_NEW,
    "drift_type_change": DRIFT_TYPE_CHANGE,
    "drift_summary": DRIFT_SUMMARY,
    "drift_documents": DRIFT_DOCUMENTS,
    "quote_page": _ORDER_QUOTES + _PAGE.format(n=100, k=200),
    "quote_page_deep": _ORDER_QUOTES + _PAGE.format(n=100, k=3900),
    "quote_page_sketched": _ORDER_QUOTES + "WHERE o_orderpriority = '1-URGENT' " + _PAGE.format(n=100, k=2400),
    "quote_page_after": _ORDER_QUOTES + _PAGE.format(n=100, k=500),
    "quote_page_source": _ORDER_QUOTES + "WHERE o_orderpriority = '1-URGENT' " + _PAGE.format(n=20, k=20),
    "quote_page_symbol": _ORDER_QUOTES + "WHERE o_orderstatus = 'F' " + _PAGE.format(n=50, k=0),
    "quote_total": "SELECT count(*) AS total FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'O'",
    "quote_page_numbers": QUOTE_PAGE_NUMBERS,
    "unified_page": UNIFIED_PAGE,
    "recent_runs": RECENT_RUNS,
    "source_stats": SOURCE_STATS,
    "health": HEALTH,
    "request_counter": REQUEST_COUNTER,
    "latency_histogram": LATENCY_HISTOGRAM,
    "stream_metrics": REQUEST_COUNTER,
    "stream_histogram": LATENCY_HISTOGRAM,
}
