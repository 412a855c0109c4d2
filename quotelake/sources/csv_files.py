"""CSV scan: header row, text columns, missing-value tokens, whole rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.sources.order import FILE_COLUMNS, with_file_columns, with_row_order

# --- fixed values: texts read as "missing", and the sample rows --------------------
MISSING_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)
SAMPLE_COLUMNS = ("coin_id", "name", "symbol", "price", "market_cap", "volume")
SAMPLE_ROWS = (
    ("bitcoin", "Bitcoin", "BTC", 43250.50, 846000000000, 28000000000),
    ("ethereum", "Ethereum", "ETH", 2280.75, 274000000000, 15000000000),
    ("binancecoin", "Binance Coin", "BNB", 312.40, 48000000000, 1200000000),
    ("cardano", "Cardano", "ADA", 0.58, 20500000000, 450000000),
    ("solana", "Solana", "SOL", 98.25, 42000000000, 2100000000),
)
# --- end of fixed values ----------------------------------------------------------

CORRUPT = "_corrupt_record"


def csv_reader_options(multi_line: bool) -> dict[str, str]:
    return {
        "header": "true",
        "escape": '"',  # a quote inside a quoted field is doubled
        "multiLine": str(multi_line).lower(),
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        "enforceSchema": "false",  # a file whose header differs fails the read
        "columnPruning": "false",  # a pruned parse would not see that a row is too long
    }


def header_schema(spark: SparkSession, path: str) -> T.StructType:
    """All header names as text, plus the column that receives unreadable rows."""
    names = spark.read.options(header="true", inferSchema="false", escape='"').csv(path).columns
    return T.StructType([T.StructField(n, T.StringType()) for n in (*names, CORRUPT)])


def read_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Batch read as text columns plus file columns.

    Files are split among tasks.  ``multi_line`` is for feeds with line breaks inside
    quotes: each of their files is then read by one task.
    """
    return with_file_columns(
        spark.read.schema(header_schema(spark, path)).options(**csv_reader_options(multi_line)).csv(path)
    )


def csv_records(lines: DataFrame) -> DataFrame:
    """Missing tokens to NULL, ``payload`` from all columns, and ``malformed`` for rows
    with more fields than the header (rows with fewer end in NULLs and are fine)."""
    names = [c for c in lines.columns if c != CORRUPT and c not in FILE_COLUMNS]
    corrupt = F.col(CORRUPT)
    outside_quotes = F.regexp_replace(corrupt, r'"[^"]*"', "")  # a doubled quote is two quoted runs side by side
    # adds nothing, but keeps a field in the read: Spark refuses to read the corrupt record alone
    nothing = F.least(F.lit(0), F.length(F.coalesce(F.col(f"`{names[0]}`"), F.lit(""))))
    width = F.lit(len(names)) + nothing
    too_long = corrupt.isNotNull() & (F.size(F.split(outside_quotes, ",", -1)) > width)
    cleaned = [
        F.when(F.col(f"`{n}`").isin(*MISSING_TOKENS), None).otherwise(F.col(f"`{n}`")).alias(n) for n in names
    ]
    ordered = with_row_order(lines)
    fields = ordered.select(*cleaned, "ord", too_long.alias("malformed"))
    return fields.select(
        *[F.col(f"`{n}`") for n in names],
        "ord",
        F.to_variant_object(F.struct(*[F.col(f"`{n}`") for n in names])).alias("payload"),
        "malformed",
    )


def scan_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return csv_records(read_csv(spark, path, multi_line))


def create_sample_csv(spark: SparkSession, path: str) -> None:
    """Write the five sample rows, unless something is already there."""
    schema = "coin_id string, name string, symbol string, price double, market_cap bigint, volume bigint"
    (
        spark.createDataFrame(list(SAMPLE_ROWS), schema)
        .coalesce(1)
        .write.mode("ignore")
        .csv(path, header=True)
    )
