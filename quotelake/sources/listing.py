"""Operators between a scan and validation: active entities, first N, details, nesting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotelake.functions.coerce import json_kind, json_to_double, json_truthy

# --- fixed values -------------------------------------------------------------------
PAGE_LIMIT = 50
ACTIVE_FLAG = "is_active"
QUOTE_FIELDS = {  # nested name under quotes.USD -> flat name
    "price": "price_usd",
    "volume_24h": "volume_24h_usd",
    "market_cap": "market_cap_usd",
    "percent_change_24h": "percent_change_24h",
}
TICKER_FIELDS = ("id", "name", "symbol", "rank")
# --- end of fixed values ------------------------------------------------------------

def variant_field(record: Column | str, *path: str) -> Column:
    """A field as VARIANT: NULL when absent, a variant null when the JSON says null."""
    return F.try_variant_get(record, "$" + "".join(f"['{p}']" for p in path), "variant")


def active_only(df: DataFrame, record: str = "record", flag: str = ACTIVE_FLAG) -> DataFrame:
    """Keep records whose flag is absent or true; an explicit null counts as false."""
    value = variant_field(record, flag)
    return df.filter(value.isNull() | json_truthy(value))


def first_n(df: DataFrame, n: int = PAGE_LIMIT, order: str = "ord") -> DataFrame:
    return df.orderBy(order).limit(n)


def per_file(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first ``n`` records of each file in the given order, and all malformed ones.

    A listing file is one poll, so a limit holds for each.  Spark cuts every partition to
    ``n`` rows a file before it brings a file's rows together.
    """
    place = F.row_number().over(Window.partitionBy("ord.file_path").orderBy(*order))
    whole = ~F.col("malformed") if "malformed" in df.columns else F.lit(True)
    first = df.filter(whole).withColumn("_place", place).filter(F.col("_place") <= n).drop("_place")
    return first.unionByName(df.filter(~whole)) if "malformed" in df.columns else first


def enrich(listing: DataFrame, detail: DataFrame, key: str) -> DataFrame:
    """Detail rows of the listed keys; keys without a detail row drop out."""
    return detail.join(listing, key, "inner")


def market_top(
    df: DataFrame, market_cap: str = "market_cap", tie: str = "id", n: int = PAGE_LIMIT
) -> DataFrame:
    """The ``n`` largest by market cap, rows without one last."""
    return df.orderBy(F.desc_nulls_last(market_cap), F.asc(tie)).limit(n)


def market_top_records(df: DataFrame, record: str = "record", n: int = PAGE_LIMIT) -> DataFrame:
    """:func:`market_top` of each file of scanned JSON records; malformed ones stay."""
    ranked = df.withColumn("_cap", json_to_double(variant_field(record, "market_cap"))).withColumn(
        "_id", F.to_json(variant_field(record, "id"))
    )
    return per_file(ranked, n, F.desc_nulls_last("_cap"), F.asc("_id"), F.asc("ord")).drop("_cap", "_id")


def flatten_quotes(df: DataFrame, record: str = "record") -> DataFrame:
    """Lift ``quotes.USD.*`` to flat VARIANT columns beside id, name, symbol and rank.

    A missing level leaves its metrics NULL.  A level that is present but not an object
    (null included) drops the record, as a failed detail lookup does.
    """
    quotes = variant_field(record, "quotes")
    usd = variant_field(record, "quotes", "USD")

    def usable(level: Column) -> Column:
        return level.isNull() | json_kind(level).startswith("OBJECT")

    is_object = F.coalesce(json_kind(F.col(record)).startswith("OBJECT"), F.lit(False))
    # a price that is present proves all levels above it, so most records need one look
    keep = F.when(variant_field(record, "quotes", "USD", "price").isNotNull(), True).otherwise(
        is_object & usable(quotes) & usable(usd)
    )
    if "malformed" in df.columns:
        keep = F.col("malformed") | keep
    flat = [variant_field(record, f).alias(f) for f in TICKER_FIELDS]
    flat += [variant_field(record, "quotes", "USD", f).alias(t) for f, t in QUOTE_FIELDS.items()]
    carried = [c for c in df.columns if c != record and c not in (*TICKER_FIELDS, *QUOTE_FIELDS.values())]
    return df.filter(keep).select(*carried, *flat)
