"""Scans, coercion, validation and unification."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.catalog import table
from quotelake.functions import coerce
from quotelake.operators.unify import meets_contract, unify, union_all
from quotelake.operators.validate import REASONS, accepted, record_counts, validate
from quotelake.session import scratch_path
from quotelake.sources import listing
from quotelake.sources.csv_files import scan_csv
from quotelake.sources.json_arrays import split_session
from quotelake.sources.json_files import scan_json
from quotelake.specs import CSV, MARKET, TICKER

LOADED_AT = "TIMESTAMP_NTZ '2024-01-31 06:00:00'"


def _text(column: str):
    return F.col(column).cast("string")


def unified_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, suppliers and parts, each through its own source spec."""
    at = F.expr(LOADED_AT)
    customers = table(spark, sf_dir, "customer").select(
        _text("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.lower("c_mktsegment").alias("symbol"),
        _text("c_nationkey").alias("rank"),
        _text("c_acctbal").alias("price_usd"),
        _text("c_nationkey").alias("volume_24h_usd"),
        _text("c_custkey").alias("market_cap_usd"),
        F.lit("").alias("percent_change_24h"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        _text("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.lower("s_name").alias("symbol"),
        _text("s_acctbal").alias("current_price"),
        _text("s_suppkey").alias("market_cap"),
        _text("s_nationkey").alias("total_volume"),
        F.lit("n/a").alias("price_change_24h"),
        _text("s_nationkey").alias("price_change_percentage_24h"),
    )
    parts = table(spark, sf_dir, "part").select(
        _text("p_partkey").alias("coin_id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("symbol"),
        _text("p_retailprice").alias("price"),
        _text("p_size").alias("market_cap"),
        F.lit(None).cast("string").alias("volume"),
    )
    frames = [(customers, TICKER), (suppliers, MARKET), (parts, CSV)]
    return meets_contract(union_all([unify(accepted(validate(df, s)), s, at) for df, s in frames]))


def unify_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    unified = unified_tables(spark, sf_dir)
    return unified.withColumn("source_updated_at", F.col("source_updated_at").cast("timestamp_ntz"))


UNIFY_SOURCES = """
SELECT CAST(c_custkey AS VARCHAR) AS coin_id, c_name AS name, upper(c_mktsegment) AS symbol,
       c_acctbal AS price_usd, CAST(c_custkey AS DOUBLE) AS market_cap_usd,
       CAST(c_nationkey AS DOUBLE) AS volume_24h_usd, CAST(NULL AS DOUBLE) AS price_change_24h_percent,
       CAST(c_nationkey AS INTEGER) AS rank, 'coinpaprika' AS source,
       TIMESTAMP '2024-01-31 06:00:00' AS source_updated_at
FROM customer
UNION ALL
SELECT CAST(s_suppkey AS VARCHAR), s_name, upper(s_name), s_acctbal, CAST(s_suppkey AS DOUBLE),
       CAST(s_nationkey AS DOUBLE), CAST(s_nationkey AS DOUBLE), CAST(NULL AS INTEGER), 'coingecko',
       TIMESTAMP '2024-01-31 06:00:00'
FROM supplier
UNION ALL
SELECT CAST(p_partkey AS VARCHAR), p_name, upper(p_brand), p_retailprice, CAST(p_size AS DOUBLE),
       CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS INTEGER), 'csv',
       TIMESTAMP '2024-01-31 06:00:00'
FROM part
"""

# The line number decides how a price is spelt, the same way in both engines.
DIRTY_PRICE = """
CASE l_linenumber
  WHEN 1 THEN CAST(l_extendedprice AS STRING)
  WHEN 2 THEN concat('  ', CAST(l_extendedprice AS STRING), ' ')
  WHEN 3 THEN concat(CAST(l_suppkey AS STRING), '_000')
  WHEN 4 THEN concat(CAST(l_extendedprice AS STRING), 'd')
  WHEN 5 THEN CASE l_returnflag WHEN 'A' THEN '' WHEN 'N' THEN 'abc' ELSE '0x1p3' END
  WHEN 6 THEN concat('1,', CAST(l_suppkey AS STRING))
  ELSE concat('-', CAST(l_suppkey AS STRING), 'e-1')
END
"""


def lenient_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.expr(DIRTY_PRICE).alias("text"))
    return dirty.select("l_orderkey", "l_linenumber", coerce.text_to_double(F.col("text")).alias("price"))


LENIENT_DOUBLE = r"""
WITH dirty AS (SELECT l_orderkey, l_linenumber, trim(%s) AS t FROM lineitem)
SELECT l_orderkey, l_linenumber,
       CASE WHEN regexp_full_match(t, '[+-]?([0-9]+(_[0-9]+)*(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?')
            THEN TRY_CAST(replace(t, '_', '') AS DOUBLE) END AS price
FROM dirty
""" % DIRTY_PRICE.replace("STRING", "VARCHAR")

DIRTY_RANK = """
CASE l_linenumber
  WHEN 1 THEN CAST(l_suppkey AS STRING)
  WHEN 2 THEN concat(CAST(l_suppkey AS STRING), '.0')
  WHEN 3 THEN concat(CAST(l_suppkey AS STRING), '.5')
  WHEN 4 THEN concat('x', CAST(l_suppkey AS STRING))
  WHEN 5 THEN ''
  WHEN 6 THEN concat(' +', CAST(l_suppkey AS STRING), ' ')
  ELSE concat('9', CAST(l_partkey + 100000000000 AS STRING))
END
"""


def lax_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.expr(DIRTY_RANK).alias("text"))
    read = dirty.withColumn("number", coerce.text_to_whole(F.col("text")))
    ranked = read.select("l_orderkey", "l_linenumber", coerce.integral(F.col("number")).alias("rank"))
    return ranked.withColumn("rejected", F.col("rank").isNull())


LAX_INT = r"""
WITH dirty AS (SELECT l_orderkey, l_linenumber, trim(%s) AS t FROM lineitem),
read AS (
  SELECT *, CASE WHEN regexp_full_match(t, '[+-]?[0-9]+(\.0+)?') THEN TRY_CAST(t AS DOUBLE) END AS d
  FROM dirty)
SELECT l_orderkey, l_linenumber,
       CASE WHEN d BETWEEN -2147483648 AND 2147483647 THEN CAST(d AS INTEGER) END AS rank,
       NOT coalesce(d BETWEEN -2147483648 AND 2147483647, FALSE) AS rejected
FROM read
""" % DIRTY_RANK.replace("STRING", "VARCHAR")


def _json_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as JSON records; the size decides which identifier fields a record has."""
    key = F.col("p_partkey").cast("string")
    form = F.floor(F.col("p_size") / 10)
    # to_json leaves NULL struct fields out, so an explicit null is written as text
    identity = (
        F.when(form == 0, F.concat(F.lit('"id":"'), key, F.lit('",')))
        .when(form == 1, F.concat(F.lit('"coin_id":"'), key, F.lit('",')))
        .when(form == 2, F.concat(F.lit('"id":null,"coin_id":"'), key, F.lit('",')))
        .when(form == 3, F.concat(F.lit('"id":'), key, F.lit(",")))
        .when(form == 4, F.concat(F.lit('"id":"a'), key, F.lit('","coin_id":"b'), key, F.lit('",')))
        .otherwise(F.lit(""))
    )
    rest = F.to_json(
        F.struct(
            F.col("p_name").alias("name"),
            F.lower("p_brand").alias("symbol"),
            F.col("p_retailprice").alias("current_price"),
            F.col("p_size").alias("market_cap"),
        )
    )
    text = F.concat(F.lit("{"), identity, F.substring(rest, 2, 2000000))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("ord"), F.parse_json(text).alias("record"))


def required_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = validate(_json_parts(spark, sf_dir), MARKET)
    return checked.select(
        F.col("ord").alias("p_partkey"),
        "coin_id",
        "name",
        "symbol",
        "current_price",
        "total_volume",
        F.array_join(REASONS, ",").alias("reasons"),
    )


REQUIRED_ALIAS = """
SELECT p_partkey, id AS coin_id, p_name AS name, lower(p_brand) AS symbol, p_retailprice AS current_price,
       CAST(NULL AS DOUBLE) AS total_volume, CASE WHEN id IS NULL THEN 'coin_id_invalid' ELSE '' END AS reasons
FROM (SELECT *, CASE p_size // 10 WHEN 0 THEN CAST(p_partkey AS VARCHAR) WHEN 1 THEN CAST(p_partkey AS VARCHAR)
                     WHEN 4 THEN concat('a', CAST(p_partkey AS VARCHAR)) END AS id FROM part)
"""


def _dirty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as text records for the first source; some ranks and symbols are bad."""
    validated = validate(
        table(spark, sf_dir, "lineitem").select(
            F.struct("l_orderkey", "l_linenumber").alias("ord"),
            _text("l_partkey").alias("id"),
            F.col("l_returnflag").alias("name"),
            F.expr(
                "CASE l_returnflag WHEN 'A' THEN NULL WHEN 'N' THEN repeat(l_linestatus, l_linenumber * 10)"
                " ELSE l_linestatus END"
            ).alias("symbol"),
            F.expr(DIRTY_RANK).alias("rank"),
            F.expr(DIRTY_PRICE).alias("price_usd"),
        ),
        TICKER,
    )
    return validated


def reject_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dirty_lines(spark, sf_dir).select(
        "ord.l_orderkey", "ord.l_linenumber", "coin_id", "rank", F.array_join(REASONS, ",").alias("reasons")
    )


_REJECTS = """
WITH dirty AS (SELECT *, trim(%s) AS t FROM lineitem),
read AS (
  SELECT *, CASE WHEN regexp_full_match(t, '[+-]?[0-9]+(\\.0+)?') THEN TRY_CAST(t AS DOUBLE) END AS d FROM dirty),
checked AS (
  SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS coin_id,
         CASE WHEN d BETWEEN -2147483648 AND 2147483647 THEN CAST(d AS INTEGER) END AS rank,
         concat_ws(',',
           CASE WHEN l_returnflag = 'A' THEN 'symbol_invalid' END,
           CASE WHEN l_returnflag = 'N' AND l_linenumber * 10 > 50 THEN 'symbol_too_long' END,
           CASE WHEN NOT coalesce(d BETWEEN -2147483648 AND 2147483647, FALSE) THEN 'rank_invalid' END) AS reasons
  FROM read)
""" % DIRTY_RANK.replace("STRING", "VARCHAR")

REJECT_SPLIT = _REJECTS + "SELECT l_orderkey, l_linenumber, coin_id, rank, reasons FROM checked"


def reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return record_counts(_dirty_lines(spark, sf_dir))


REJECT_COUNTS = (
    _REJECTS
    + "SELECT count(*) FILTER (WHERE reasons = '') AS records_processed,"
    + " count(*) FILTER (WHERE reasons <> '') AS records_failed FROM checked"
)


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers written as CSV, some cells as missing tokens, some quoted, and read back."""
    path = scratch_path(spark, "csv")
    (
        table(spark, sf_dir, "customer")
        .select(
            "c_custkey",
            F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"')).alias("c_name"),
            F.expr(
                "CASE WHEN c_nationkey < 5 THEN 'NA' WHEN c_nationkey < 10 THEN 'null'"
                " WHEN c_nationkey < 15 THEN '' ELSE c_mktsegment END"
            ).alias("c_mktsegment"),
            "c_acctbal",
        )
        .write.csv(path, header=True, escape='"')
    )
    return scan_csv(spark, path).select(
        F.col("c_custkey").cast("bigint").alias("c_custkey"),
        "c_name",
        "c_mktsegment",
        coerce.text_to_double(F.col("c_acctbal")).alias("c_acctbal"),
        "malformed",
    )


CSV_ROUNDTRIP = """
SELECT c_custkey, concat(c_name, ', "', c_mktsegment, '"') AS c_name,
       CASE WHEN c_nationkey < 15 THEN NULL ELSE c_mktsegment END AS c_mktsegment, c_acctbal, FALSE AS malformed
FROM customer
"""


def json_lines_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written one JSON record per line and read back with their whole text."""
    path = scratch_path(spark, "ndjson")
    documents = table(spark, sf_dir, "documents")
    documents.select(F.to_json(F.struct("doc_id", "text", "lang", "n_chars"))).write.text(path)
    records = scan_json(spark, path, "ndjson")
    field = listing.variant_field
    return records.select(
        F.try_variant_get(field("record", "doc_id"), "$", "bigint").alias("doc_id"),
        coerce.json_to_string(field("record", "lang")).alias("lang"),
        F.md5(coerce.json_to_string(field("record", "text")).cast("binary")).alias("text_md5"),
        F.try_variant_get(field("record", "n_chars"), "$", "bigint").alias("n_chars"),
        "malformed",
    )


JSON_LINES_SCAN = "SELECT doc_id, lang, md5(text) AS text_md5, n_chars, FALSE AS malformed FROM documents"

PAGE_ROWS = 500


def json_array_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers written as pages of at most 500 records, one JSON array per file."""
    path = scratch_path(spark, "pages")
    page = F.floor(F.col("c_custkey") / PAGE_ROWS)
    (
        table(spark, sf_dir, "customer")
        .groupBy(page.alias("page"))  # a page is bounded by its key range
        .agg(F.to_json(F.sort_array(F.collect_list(F.struct("c_custkey", "c_name")))).alias("value"))
        .write.partitionBy("page")
        .text(path)
    )
    field = listing.variant_field
    return scan_json(spark, path, "json_array").select(
        F.col("ord.row").alias("pos"),
        F.try_variant_get(field("record", "c_custkey"), "$", "bigint").alias("c_custkey"),
        coerce.json_to_string(field("record", "c_name")).alias("c_name"),
        "malformed",
    )


JSON_ARRAY_SCAN = """
SELECT row_number() OVER (PARTITION BY c_custkey // 500 ORDER BY c_custkey) - 1 AS pos,
       c_custkey, c_name, FALSE AS malformed
FROM customer
"""


SPLIT_BYTES = 64 << 10


def json_array_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as array files of at most 500 records, read in splits far smaller than a file.

    Texts carry brackets, quotes and escapes; nested values carry commas between braces.
    """
    path = scratch_path(spark, "split_pages")
    page = F.floor(F.col("doc_id") / PAGE_ROWS)
    odd = F.concat(F.lit('}],[{"\\'), "lang", F.lit('\\"},{'))
    nested = F.struct(odd.alias("},{"), F.array("n_chars").alias("]"))
    (
        table(spark, sf_dir, "documents")
        .groupBy(page.alias("page"))  # a page is bounded by its key range
        .agg(F.to_json(F.sort_array(F.collect_list(F.struct("doc_id", "text", nested.alias("more"))))).alias("value"))
        .write.partitionBy("page")
        .text(path)
    )
    reader = split_session(spark, SPLIT_BYTES)
    field = listing.variant_field
    return scan_json(reader, path, "json_array_split").select(
        F.try_variant_get(field("record", "doc_id"), "$", "bigint").alias("doc_id"),
        F.md5(coerce.json_to_string(field("record", "text")).cast("binary")).alias("text_md5"),
        F.try_variant_get("record", "$.more['},{']", "string").alias("odd"),
        F.try_variant_get("record", "$.more[']'][0]", "bigint").alias("n_chars"),
        "malformed",
    )


JSON_ARRAY_SPLIT = """
SELECT doc_id, md5(text) AS text_md5, '}],[{"\\' || lang || '\\"},{' AS odd, n_chars, FALSE AS malformed
FROM documents
"""


def active_first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as listed entities: the nation decides whether the flag is there and true."""
    flag = F.expr(
        "CASE WHEN c_nationkey < 6 THEN ',\"is_active\":false' WHEN c_nationkey < 12 THEN ',\"is_active\":null'"
        " WHEN c_nationkey < 18 THEN ',\"is_active\":true' ELSE '' END"
    )
    text = F.concat(F.lit('{"id":"'), F.col("c_custkey").cast("string"), F.lit('"'), flag, F.lit("}"))
    listed = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("ord"), F.parse_json(text).alias("record")
    )
    top = listing.first_n(listing.active_only(listed))
    return top.select(coerce.json_to_string(listing.variant_field("record", "id")).alias("id"))


ACTIVE_FIRST_N = """
SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer WHERE c_nationkey >= 12 ORDER BY c_custkey LIMIT 50
"""


def list_detail_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order entries as the list, customers as the detail; keys without detail drop out."""
    listed = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    detail = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return listing.enrich(listed, detail, "c_custkey").select("o_orderkey", "c_custkey", "c_name", "c_acctbal")


LIST_DETAIL_JOIN = """
SELECT o_orderkey, c_custkey, c_name, c_acctbal FROM orders JOIN customer ON o_custkey = c_custkey
"""


def nested_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as nested detail records; the size decides which levels a record has."""
    form = F.floor((F.col("p_size") - 1) / 10)
    usd = F.struct(
        F.when(form != 1, F.col("p_retailprice")).alias("price"),
        F.col("p_size").alias("volume_24h"),
        F.col("p_partkey").alias("market_cap"),
        F.lit("bad").alias("percent_change_24h"),
    )
    quotes = F.when(form != 2, F.struct(F.when(form != 3, usd).alias("USD")))
    text = F.to_json(
        F.struct(
            F.col("p_partkey").cast("string").alias("id"),
            F.col("p_name").alias("name"),
            F.col("p_brand").alias("symbol"),
            F.col("p_size").alias("rank"),
            quotes.alias("quotes"),
        )
    )
    # form 4: an explicit null where an object belongs, which drops the record
    text = F.when(form == 4, F.regexp_replace(text, r'"quotes":.*$', '"quotes":null}')).otherwise(text)
    records = table(spark, sf_dir, "part").select(F.parse_json(text).alias("record"))
    return accepted(validate(listing.flatten_quotes(records), TICKER))


NESTED_FLATTEN = """
SELECT CAST(p_partkey AS VARCHAR) AS coin_id, p_name AS name, p_brand AS symbol, p_size AS rank,
       CASE WHEN p_size <= 10 THEN p_retailprice END AS price_usd,
       CASE WHEN p_size <= 20 THEN CAST(p_size AS DOUBLE) END AS volume_24h_usd,
       CASE WHEN p_size <= 20 THEN CAST(p_partkey AS DOUBLE) END AS market_cap_usd,
       CAST(NULL AS DOUBLE) AS percent_change_24h
FROM part WHERE p_size <= 40
"""


def market_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    return listing.market_top(parts, "p_retailprice", "p_partkey")


MARKET_TOPK = """
SELECT p_partkey, p_name, p_retailprice FROM part ORDER BY p_retailprice DESC NULLS LAST, p_partkey LIMIT 50
"""

def csv_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a cell too many, some with 20,000 quoted characters, judged with all columns and with one."""
    path = scratch_path(spark, "long")
    cell = F.when(F.col("c_custkey") % 100 == 0, F.repeat(F.lit('""'), 10_000)).otherwise(F.col("c_name"))
    extra = F.when(F.col("c_custkey") % 3 == 0, ",more").otherwise("")
    line = F.concat(F.col("c_custkey").cast("string"), F.lit(',"'), cell, F.lit('"'), extra)
    # written as lines, so the separator and quotes are theirs; every file begins with the header
    lines = table(spark, sf_dir, "customer").select(line.alias("id,name")).repartition(8)
    lines.write.csv(path, header=True, sep="\u0001", quote="", emptyValue="")
    whole = scan_csv(spark, path)
    one = scan_csv(spark, path).select(F.col("id").alias("other"), F.col("malformed").alias("alone"))
    return whole.join(one, F.col("id") == F.col("other")).select(F.col("id").cast("bigint").alias("id"), F.length("name").cast("bigint").alias("n"), "malformed", "alone")


CSV_MALFORMED = """
SELECT c_custkey AS id, CASE WHEN c_custkey % 100 = 0 THEN 10000 ELSE length(c_name) END::BIGINT AS n,
  c_custkey % 3 = 0 AS malformed, c_custkey % 3 = 0 AS alone
FROM customer
"""


QUERIES = {
    "unify_sources": unify_sources,
    "lenient_double": lenient_double,
    "lax_int": lax_int,
    "required_alias": required_alias,
    "reject_split": reject_split,
    "reject_counts": reject_counts,
    "csv_roundtrip": csv_roundtrip,
    "csv_malformed": csv_malformed,
    "json_lines_scan": json_lines_scan,
    "json_array_scan": json_array_scan,
    "json_array_split": json_array_split,
    "active_first_n": active_first_n,
    "list_detail_join": list_detail_join,
    "nested_flatten": nested_flatten,
    "market_topk": market_topk,
}

ORACLE = {
    "unify_sources": UNIFY_SOURCES,
    "lenient_double": LENIENT_DOUBLE,
    "lax_int": LAX_INT,
    "required_alias": REQUIRED_ALIAS,
    "reject_split": REJECT_SPLIT,
    "reject_counts": REJECT_COUNTS,
    "csv_roundtrip": CSV_ROUNDTRIP,
    "csv_malformed": CSV_MALFORMED,
    "json_lines_scan": JSON_LINES_SCAN,
    "json_array_scan": JSON_ARRAY_SCAN,
    "json_array_split": JSON_ARRAY_SPLIT,
    "active_first_n": ACTIVE_FIRST_N,
    "list_detail_join": LIST_DETAIL_JOIN,
    "nested_flatten": NESTED_FLATTEN,
    "market_topk": MARKET_TOPK,
}
