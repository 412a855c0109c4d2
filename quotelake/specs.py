"""Source descriptions: a new source is new data here, not new code."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

METRICS = ("price_usd", "market_cap_usd", "volume_24h_usd", "price_change_24h_percent", "rank")


@dataclass(frozen=True)
class FieldSpec:
    """One source field: how it is coerced and which unified column it feeds.

    ``kind`` is ``string`` (required text), ``double`` (lenient) or ``int`` (lax, a bad
    value rejects the record).  ``lookup`` lists the names the field may carry; the
    first one present wins, even when its value is null.
    """

    name: str
    kind: str
    target: str | None = None
    lookup: tuple[str, ...] = ()
    max_length: int | None = None
    upper: bool = False

    @property
    def names(self) -> tuple[str, ...]:
        return self.lookup or (self.name,)


@dataclass(frozen=True)
class SourceSpec:
    """One source: its fields, file format and the columns a repeat load refreshes."""

    name: str
    fields: tuple[FieldSpec, ...]
    layout: str  # csv | json_array | json_array_split | ndjson
    update_columns: tuple[str, ...]
    nested_quotes: bool = False
    limit: int | None = None  # records taken per load: first N listed, or top N by market cap
    multi_line: bool = False  # CSV rows may span lines; files are then read unsplit
    expected_types: dict[str, str] = field(default_factory=dict, hash=False)

    def __post_init__(self) -> None:
        # The name becomes a directory name, so it must need no escaping there.
        if not re.fullmatch(r"[\w .-]{1,50}", self.name, re.ASCII):
            raise ValueError(f"source name {self.name!r}: use 1-50 letters, digits, blank, '_', '.', '-'")
        unknown = set(self.update_columns) - set(METRICS)
        if unknown:
            raise ValueError(f"not a metric column: {sorted(unknown)}")

    def mapping(self) -> dict[str, FieldSpec]:
        """Unified column name to the field that feeds it."""
        return {f.target: f for f in self.fields if f.target}


def _identity(*lookup: str) -> tuple[FieldSpec, ...]:
    return (
        FieldSpec("coin_id", "string", "coin_id", lookup or ("coin_id",), 100),
        FieldSpec("name", "string", "name", (), 255),
        FieldSpec("symbol", "string", "symbol", (), 50, upper=True),
    )


# --- fixed values: the three sources, their field names and refresh lists ---------
TICKER = SourceSpec(
    name="coinpaprika",
    layout="ndjson",
    nested_quotes=True,
    fields=_identity("id", "coin_id")
    + (
        FieldSpec("rank", "int", "rank"),
        FieldSpec("price_usd", "double", "price_usd"),
        FieldSpec("volume_24h_usd", "double", "volume_24h_usd"),
        FieldSpec("market_cap_usd", "double", "market_cap_usd"),
        FieldSpec("percent_change_24h", "double", "price_change_24h_percent"),
    ),
    update_columns=METRICS,
    expected_types={
        "id": "str",
        "name": "str",
        "symbol": "str",
        "rank": "int",
        "quotes": "dict",
    },
)

MARKET = SourceSpec(
    name="coingecko",
    layout="json_array",
    fields=_identity("id", "coin_id")
    + (
        FieldSpec("current_price", "double", "price_usd"),
        FieldSpec("market_cap", "double", "market_cap_usd"),
        FieldSpec("total_volume", "double", "volume_24h_usd"),
        FieldSpec("price_change_24h", "double"),
        FieldSpec("price_change_percentage_24h", "double", "price_change_24h_percent"),
    ),
    update_columns=("price_usd", "market_cap_usd", "volume_24h_usd", "price_change_24h_percent"),
    expected_types={
        "id": "str",
        "name": "str",
        "symbol": "str",
        "current_price": "float",
        "market_cap": "float",
        "total_volume": "float",
        "price_change_24h": "float",
        "price_change_percentage_24h": "float",
    },
)

CSV = SourceSpec(
    name="csv",
    layout="csv",
    fields=_identity("coin_id")
    + (
        FieldSpec("price", "double", "price_usd"),
        FieldSpec("market_cap", "double", "market_cap_usd"),
        FieldSpec("volume", "double", "volume_24h_usd"),
    ),
    update_columns=("price_usd", "market_cap_usd", "volume_24h_usd"),
    expected_types={
        "coin_id": "str",
        "name": "str",
        "symbol": "str",
        "price": "str",
        "market_cap": "str",
        "volume": "str",
    },
)

# In job order.
SOURCES: dict[str, SourceSpec] = {s.name: s for s in (TICKER, MARKET, CSV)}
# --- end of fixed values ----------------------------------------------------------
