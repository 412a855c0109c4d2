"""Keyed tables: upserts in buckets, replays, failures, groups of any name."""

import re
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.operators.upsert import UpsertPolicy
from quotelake.session import settings
from quotelake.tables import UPSERT_SETTINGS, KeyedTable

SCHEMA = T.StructType(
    [
        T.StructField("coin_id", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)
BATCH = "coin_id string, source string, price double, ord int"
POLICY = UpsertPolicy(("coin_id", "source"), ("price",), None, ("updated_at",))
T1, T2 = datetime(2024, 1, 1, tzinfo=timezone.utc), datetime(2024, 2, 1, tzinfo=timezone.utc)


@pytest.fixture
def table(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, "coin_id", "source")
    t.create()
    return t


def contents(table):
    return {(r.coin_id, r.source): r.price for r in table.read().collect()}


def test_upserts_accumulate(spark, table):
    assert table.read().count() == 0
    first = [(f"c{i}", s, float(i), i) for i in range(50) for s in ("x", "2024")]
    second = [(f"c{i}", "x", -1.0, i) for i in range(25, 75)]
    table.upsert(spark.createDataFrame(first, BATCH), POLICY, ("ord",), T1)
    table.upsert(spark.createDataFrame(second, BATCH), POLICY, ("ord",), T2)
    want = {(c, s): p for c, s, p, _ in first} | {(c, s): p for c, s, p, _ in second}
    assert contents(table) == want
    assert table.read().filter("source = '2024'").count() == 50


def test_replayed_batch_changes_nothing(spark, table):
    rows = spark.createDataFrame([("a", "x", 1.0, 1), ("a", "x", 2.0, 2), ("b", "x", None, 3)], BATCH)
    table.upsert(rows, POLICY, ("ord",), T1)
    before = contents(table)
    table.upsert(rows, POLICY, ("ord",), T2)
    assert contents(table) == before == {("a", "x"): 2.0, ("b", "x"): None}


def files(table):
    return {str(f): f.stat().st_mtime_ns for f in Path(table.root, "rows").rglob("*.parquet")}


def test_only_touched_groups_are_written(spark, table):
    rows = [(f"c{i}", s, float(i), i) for i in range(200) for s in ("x", "y", "z")]
    table.upsert(spark.createDataFrame(rows, BATCH), POLICY, ("ord",), T1)
    before = files(table)
    table.upsert(spark.createDataFrame([("c1", "y", 7.0, 1), ("new", "y", 8.0, 2), ("n", "w", 9.0, 3)], BATCH), POLICY, ("ord",), T2)
    after = files(table)
    same = {f for f in before if after.get(f) == before[f]}
    assert same == {f for f in before if "source=y" not in f}
    assert len(contents(table)) == 602 and contents(table)["c1", "y"] == 7.0


def test_stored_rows_are_not_shuffled(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "wide"), SCHEMA, "coin_id", "source", buckets=6)
    t.create()
    rows = [(f"c{i}", s, float(i), i) for i in range(300) for s in ("x", "y")]
    t.upsert(spark.createDataFrame(rows, BATCH), POLICY, ("ord",), T1)
    assert sum("source=x" in f for f in files(t)) == 6  # one file of each bucket
    with settings(spark, UPSERT_SETTINGS):
        plan = t.merged(spark.createDataFrame(rows[:9], BATCH), POLICY, ("ord",), T2, ["x"])._jdf.queryExecution().executedPlan().toString()
    # between the join and the scan of the table there is a sort and no exchange
    assert re.search(r"FullOuter\n\W*Sort [^\n]*\n\W*FileScan [^\n]*Bucketed: true[^\n]*PartitionFilters: \[isnotnull\(source", plan), plan


NAMED = T.StructType([*SCHEMA.fields, T.StructField("name", T.StringType()), T.StructField("created_at", T.TimestampType())])


def test_a_column_is_the_first_or_the_last_as_each_policy_says(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "named"), NAMED, "coin_id", "source")
    t.create()
    keys, stamps = ("coin_id", "source"), ("created_at", ("updated_at",))
    both, price = UpsertPolicy(keys, ("price", "name"), *stamps), UpsertPolicy(keys, ("price",), *stamps)
    steps = [(price, 1.0, "first"), (price, 2.0, "second"), (both, None, "third"), (price, 4.0, None)]
    for n, (policy, value, name) in enumerate(steps):
        batch = spark.createDataFrame([("a", "x", value, name, 1)], "coin_id string, source string, price double, name string, ord int")
        t.upsert(batch, policy, ("ord",), T1 if n == 0 else T2)
        (row,) = t.read().collect()
        assert (row.price, row.name) == (value, "third" if n >= 2 else "first")
        assert row.created_at.month == 1 and row.updated_at.month == (1 if n == 0 else 2)


def test_a_failed_batch_leaves_the_rows(spark, table):
    rows = [(f"c{i}", "x", float(i), i) for i in range(40)]
    table.upsert(spark.createDataFrame(rows, BATCH), POLICY, ("ord",), T1)
    before, kept = contents(table), files(table)
    broken = spark.createDataFrame(rows, BATCH).withColumn("price", F.expr("if(coin_id = 'c7', raise_error('broken'), 1D)"))
    with pytest.raises(Exception, match="broken"):
        table.upsert(broken, POLICY, ("ord",), T2)
    assert contents(table) == before and files(table) == kept


def test_another_session_finds_the_table(spark, table):
    rows = [(f"c{i}", s, float(i), i) for i in range(40) for s in ("x", "a b")]
    table.upsert(spark.createDataFrame(rows, BATCH), POLICY, ("ord",), T1)
    spark.sql(f"DROP TABLE {table.name}")  # as a new session, whose catalog does not know it
    again = KeyedTable(spark, table.root, SCHEMA, "coin_id", "source", buckets=99)
    again.create()
    assert contents(again) == {(c, s): p for c, s, p, _ in rows}
    again.upsert(spark.createDataFrame([("c1", "x", 5.0, 1)], BATCH), POLICY, ("ord",), T2)
    assert contents(again)["c1", "x"] == 5.0 and len(contents(again)) == 80


def test_empty_batch(spark, table):
    table.upsert(spark.createDataFrame([], BATCH), POLICY, ("ord",), T1)
    assert table.read().count() == 0


def test_source_filter_prunes_directories(spark, table):
    rows = [(f"c{i}", s, 1.0, i) for i in range(40) for s in ("x", "y")]
    table.upsert(spark.createDataFrame(rows, BATCH), POLICY, ("ord",), T1)
    plan = table.read().filter("source = 'x'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source" in plan


def test_reading_one_group(spark, table):
    rows = [(f"c{i}", s, 1.0, i) for i in range(40) for s in ("x", "y")]
    table.upsert(spark.createDataFrame(rows, BATCH), POLICY, ("ord",), T1)
    only = table.read("x")
    assert only.count() == 40 and "PartitionFilters: [isnotnull(source" in only._jdf.queryExecution().executedPlan().toString()
    assert table.read("none").count() == 0


def test_lookup_columns_get_a_bloom_filter(spark, tmp_path):
    sizes = []
    for name, lookups in (("plain", ()), ("indexed", ("coin_id",))):
        t = KeyedTable(spark, str(tmp_path / name), SCHEMA, "coin_id", "source", lookups)
        t.create()
        rows = [(f"c{i}", "x", 1.0, i) for i in range(1000)]
        t.upsert(spark.createDataFrame(rows, BATCH), POLICY, ("ord",), T1)
        assert t.read().filter("coin_id = 'c77'").count() == 1
        assert t.read().filter("coin_id = 'c77x'").count() == 0
        sizes.append(sum(f.stat().st_size for f in Path(t.root, "rows").rglob("*.parquet")))
    assert sizes[0] < sizes[1] < sizes[0] + 4 * 100_000  # a filter in the file of each bucket


def test_groups_of_any_characters_are_found_again(spark, table):
    groups = ["a/b", "x=y", "a:b", "50%", "p q", "[z]", "{k}"]
    rows = [(f"c{i}", g, float(i), i) for i in range(5) for g in groups]
    table.upsert(spark.createDataFrame(rows, BATCH), POLICY, ("ord",), T1)
    table.upsert(spark.createDataFrame([("c1", "a/b", 9.0, 1)], BATCH), POLICY, ("ord",), T2)
    assert contents(table) == {(c, g): p for c, g, p, _ in rows} | {("c1", "a/b"): 9.0}
    assert table.read("x=y").count() == 5


@pytest.mark.parametrize("row", [("a", None, 1.0, 1), ("a", "", 1.0, 1), (None, "x", 1.0, 1)])
def test_a_row_without_key_or_group_is_an_error(spark, table, row):
    with pytest.raises(ValueError):
        table.upsert(spark.createDataFrame([row, ("b", "x", 1.0, 2)], BATCH), POLICY, ("ord",), T1)
    assert table.read().count() == 0 and not files(table)
