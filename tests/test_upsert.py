"""The upsert against a plain one-row-after-another loop."""

import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from quotelake.operators.upsert import UpsertPolicy, fold_batch, upsert, upsert_delta

SCHEMA = "coin_id string, source string, name string, price double, rank int, created_at timestamp, updated_at timestamp"
BATCH = "coin_id string, source string, name string, price double, rank int, ord int"
OLD, NEW = datetime(2024, 1, 1, tzinfo=timezone.utc), datetime(2024, 2, 1, tzinfo=timezone.utc)


def policy(update):
    return UpsertPolicy(("coin_id", "source"), update, "created_at", ("updated_at",))


def simulate(stored, batch, update):
    table = {(r[0], r[1]): dict(zip(("name", "price", "rank", "created", "updated"), r[2:])) for r in stored}
    for coin, source, name, price, rank, _ in sorted(batch, key=lambda r: r[5]):
        row = {"name": name, "price": price, "rank": rank}
        if (coin, source) in table:
            table[coin, source].update({c: row[c] for c in update}, updated="new")
        else:
            table[coin, source] = {**row, "created": "new", "updated": "new"}
    return {k: tuple(v.values()) for k, v in table.items()}


def label(ts):
    return "new" if ts.month == 2 else "old"


def random_case(seed):
    rng = random.Random(seed)
    maybe = lambda v: None if rng.random() < 0.3 else v
    keys = [(f"c{i}", s) for i in range(12) for s in ("x", "y")]
    stored = [(*k, maybe("n"), maybe(rng.random()), maybe(rng.randint(1, 9)), "old", "old") for k in keys if rng.random() < 0.5]
    hot = keys[0]  # a third of the batch
    batch = []
    for i in range(90):
        k = hot if i % 3 == 0 else rng.choice(keys)
        batch.append((*k, maybe(f"m{i}"), maybe(rng.random()), maybe(rng.randint(1, 9)), i))
    rng.shuffle(batch)
    return stored, batch


@pytest.mark.parametrize("update", [("price", "rank"), ("price",)])
@pytest.mark.parametrize("seed", [1, 2])
def test_matches_sequential_upsert(spark, seed, update):
    stored, batch = random_case(seed)
    current = spark.createDataFrame([(*r[:5], OLD, OLD) for r in stored], SCHEMA)
    result = upsert(current, spark.createDataFrame(batch, BATCH), policy(update), ("ord",), F.lit(NEW))
    assert result.columns == current.columns
    got = {(r[0], r[1]): (r[2], r[3], r[4], label(r[5]), label(r[6])) for r in result.collect()}
    assert got == simulate(stored, batch, update)
    assert result.count() == len(got)


def test_idempotent_and_null_overwrite(spark):
    p = policy(("price", "rank"))
    empty = spark.createDataFrame([], SCHEMA)
    batch = spark.createDataFrame([("a", "x", "A", 40000.0, 1, 1), ("a", "x", "B", None, 2, 2)], BATCH)
    once = upsert(empty, batch, p, ("ord",), F.lit(OLD))
    twice = upsert(once, batch, p, ("ord",), F.lit(NEW))
    assert [r[:5] for r in once.collect()] == [("a", "x", "A", None, 2)] == [r[:5] for r in twice.collect()]
    row = twice.first()
    assert label(row.created_at) == "old" and label(row.updated_at) == "new"


def test_other_keys_do_not_depend_on_batch_order(spark):
    stored, batch = random_case(3)
    p = policy(("price", "rank"))
    empty = spark.createDataFrame([], SCHEMA)
    a = upsert(empty, spark.createDataFrame(batch, BATCH), p, ("ord",), F.lit(NEW))
    b = upsert(empty, spark.createDataFrame(batch[::-1], BATCH), p, ("ord",), F.lit(NEW))
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def test_fold_aggregates_before_the_shuffle(spark):
    batch = spark.createDataFrame([("a", "x", "A", 1.0, 1, 1)], BATCH)
    plan = fold_batch(batch, policy(("price",)), ("ord",))._jdf.queryExecution().toString()
    assert "partial_max_by" in plan and plan.index("Exchange hashpartitioning") < plan.index("partial_max_by")


def test_delta_counts(spark):
    current = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    batch = spark.createDataFrame([("b", 2), ("b", 3), ("c", 1), ("d", 1)], "k string, v int")
    assert tuple(upsert_delta(current, batch, ("k",)).first()) == (2, 1)


def test_an_older_event_changes_nothing(spark):
    rng = random.Random(11)
    schema = "coin_id string, source string, name string, price double, at int"
    maybe = lambda v: None if rng.random() < 0.2 else v
    rows = [(f"c{rng.randrange(6)}", "x", f"n{i}", float(i), maybe(rng.randrange(5)), i) for i in range(120)]
    guarded = UpsertPolicy(("coin_id", "source"), ("price", "at"), newer="at")
    table = spark.createDataFrame([], schema)
    want = {}
    for low in range(0, 120, 40):
        lot = rows[low : low + 40]
        merged = upsert(table, spark.createDataFrame(lot, schema + ", ord int"), guarded, ("ord",))
        table = spark.createDataFrame(merged.collect(), schema)
        for coin, _, name, price, at, _ in lot:
            if coin not in want:
                want[coin] = (name, price, at)
            elif (-1 if at is None else at) >= (-1 if want[coin][2] is None else want[coin][2]):
                want[coin] = (want[coin][0], price, at)
    assert {r.coin_id: (r.name, r.price, r.at) for r in table.collect()} == want
    with pytest.raises(ValueError):
        UpsertPolicy(("coin_id",), ("price",), newer="at")
