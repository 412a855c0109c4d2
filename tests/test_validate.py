"""Validation, reject reasons and the unified mapping on the fixture rows."""

import json

from pyspark.sql import functions as F

from quotelake.operators.unify import meets_contract, unify
from quotelake.operators.validate import REASONS, accepted, record_counts, rejected, validate
from quotelake.schemas import UNIFIED_CONTRACT
from quotelake.specs import CSV, MARKET, TICKER


def at():
    return F.timestamp_micros(F.lit(1706680800000000))



def records(spark, values):
    rows = [(i, json.dumps(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "ord int, t string").select("ord", F.parse_json("t").alias("record"))


TICKERS = [
    {"id": "q-quartz", "name": "Quartz", "symbol": "QTZ", "rank": 1, "price_usd": 712.25,
     "volume_24h_usd": 6100000, "market_cap_usd": 93000000, "percent_change_24h": 1.25},
    {"id": "b-basalt", "name": "Basalt", "symbol": "BSL", "rank": 2, "price_usd": 18.5,
     "volume_24h_usd": 2700000, "market_cap_usd": 41000000, "percent_change_24h": -4.5},
]


def test_fixture_rows_are_accepted_and_mapped(spark):
    rows = unify(accepted(validate(records(spark, TICKERS), TICKER)), TICKER, at()).orderBy("rank").collect()
    assert [r.coin_id for r in rows] == ["q-quartz", "b-basalt"]
    first = rows[0].asDict()
    assert (first["price_usd"], first["market_cap_usd"], first["volume_24h_usd"]) == (712.25, 93e6, 6.1e6)
    assert (first["price_change_24h_percent"], first["rank"], first["source"]) == (1.25, 1, "coinpaprika")


def test_market_mapping_drops_rank_and_upper_cases(spark):
    row = {"id": "quartz", "name": "Quartz", "symbol": "qtz", "current_price": 712.25, "market_cap": 93e6,
           "total_volume": 6.1e6, "price_change_24h": 11.75, "price_change_percentage_24h": 1.25, "rank": 3}
    checked = accepted(validate(records(spark, [row]), MARKET))
    assert checked.first().symbol == "qtz" and checked.first().price_change_24h == 11.75
    got = unify(checked, MARKET, at()).first()
    assert (got.symbol, got.price_usd, got.rank, got.price_change_24h_percent) == ("QTZ", 712.25, None, 1.25)


def test_csv_mapping_leaves_percent_and_rank_empty(spark):
    df = spark.createDataFrame([("quartz", "Quartz", "qtz", "712.25", "93000000", "bad")],
                               "coin_id string, name string, symbol string, price string, market_cap string, volume string")
    got = unify(accepted(validate(df, CSV)), CSV, at()).first()
    assert (got.symbol, got.price_usd, got.volume_24h_usd, got.price_change_24h_percent, got.rank, got.source) == (
        "QTZ", 712.25, None, None, None, "csv"
    )


def test_optional_missing_and_invalid_numbers_are_null(spark):
    rows = [
        {"id": "a", "name": "A", "symbol": "A"},
        {"id": "b", "name": "B", "symbol": "B", "price_usd": "invalid", "market_cap_usd": "", "volume_24h_usd": [1]},
    ]
    got = accepted(validate(records(spark, rows), TICKER)).orderBy("ord").collect()
    assert len(got) == 2 and all(r.price_usd is None and r.market_cap_usd is None and r.rank is None for r in got)


def test_alias_presence_decides(spark):
    base = {"name": "N", "symbol": "S"}
    rows = [
        {"id": "x", "coin_id": "y", **base},
        {"coin_id": "y", **base},
        {"id": None, "coin_id": "y", **base},
        {"id": 7, "coin_id": "y", **base},
        base,
        {"id": "", **base},
    ]
    got = validate(records(spark, rows), MARKET).orderBy("ord").collect()
    assert [r.coin_id for r in got] == ["x", "y", None, None, None, ""]
    assert [r[REASONS] for r in got] == [[], [], ["coin_id_invalid"], ["coin_id_invalid"], ["coin_id_invalid"], []]


def test_reject_reasons_and_counts(spark):
    ok = {"id": "a", "name": "A", "symbol": "A"}
    rows = [
        ok,
        {**ok, "rank": "first"},
        {**ok, "rank": 5.5},
        {**ok, "rank": None},
        {**ok, "rank": ""},
        {**ok, "rank": "5.0"},
        {**ok, "rank": 3000000000},
        {**ok, "name": "n" * 256},
        {**ok, "name": "n" * 255, "symbol": "s" * 51, "id": "i" * 101},
        {**ok, "symbol": "ß" * 26},  # 52 characters in upper case
        {**ok, "name": 5, "rank": [1]},
        "not an object",
    ]
    validated = validate(records(spark, rows), TICKER)
    got = [r[REASONS] for r in validated.orderBy("ord").collect()]
    assert got == [
        [], ["rank_invalid"], ["rank_invalid"], [], ["rank_invalid"], [], ["rank_invalid"], ["name_too_long"],
        ["coin_id_too_long", "symbol_too_long"], ["symbol_too_long"], ["name_invalid", "rank_invalid"],
        ["coin_id_invalid", "name_invalid", "symbol_invalid"],
    ]
    counts = record_counts(validated).first()
    assert (counts.records_processed, counts.records_failed) == (3, 9)
    assert accepted(validated).count() + rejected(validated).count() == len(rows)


def test_malformed_records_are_rejected_once(spark):
    df = records(spark, [{"id": "a"}]).withColumn("malformed", F.lit(True))
    assert validate(df, MARKET).first()[REASONS] == ["malformed"]


def test_contract_requires_keys(spark):
    unified = unify(accepted(validate(records(spark, TICKERS), TICKER)), TICKER, at())
    broken = unified.withColumn("name", F.when(F.col("rank") == 1, F.col("name")))
    assert meets_contract(unified).count() == 2 and meets_contract(broken).count() == 1
    assert meets_contract(unified).columns == UNIFIED_CONTRACT.names


def test_a_filter_on_accepted_rows_does_not_repeat_the_parse(spark):
    rows = spark.createDataFrame([('{"id": "q", "name": "Q", "symbol": "q", "rank": 1}',)], "t string")
    checked = validate(rows.select(F.parse_json("t").alias("record")), TICKER)
    plan = accepted(checked)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse_json") == 1 or plan.count("parseJson") == 1
