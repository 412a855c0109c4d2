"""Quote pages, run lists, health, statistics, metrics and drift on the fixture rows."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from quotelake.operators import drift, metrics, paging
from quotelake.plans import control, reads
from quotelake.schemas import CHECKPOINT_SCHEMA, QUOTE_COLUMNS, RUN_COLUMNS, RUN_SCHEMA, UNIFIED_SCHEMA

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def quotes(spark, rows):
    made = [
        (i, coin, name, sym, price, 1e6, 5e4, None, None, source, T0, T0, at)
        for i, (coin, name, sym, price, source, at) in enumerate(rows)
    ]
    return spark.createDataFrame(made, UNIFIED_SCHEMA)


@pytest.fixture(scope="module")
def fixture_quotes(spark):
    return quotes(spark, [(f"ore-{i:02}", f"Ore {i}", f"O{i}", 3.5 * i, "mine", T0) for i in range(23)])


def test_pages_cover_all_rows_once(fixture_quotes):
    pages = [reads.quote_page(fixture_quotes, p, 10) for p in (1, 2, 3, 4)]
    rows = [[r.coin_id for r in page.collect()] for page, _ in pages]
    assert [len(r) for r in rows] == [10, 10, 3, 0]
    assert len({c for page in rows for c in page}) == 23
    assert [t.first().total for _, t in pages] == [23] * 4
    assert pages[0][0].columns == list(QUOTE_COLUMNS)


def test_default_page_and_latest_first(spark):
    rows = [(f"c{i}", "n", "S", 1.0, "x", T0 + timedelta(hours=i)) for i in range(30)] + [("new", "n", "S", 1.0, "x", None)]
    page = reads.quote_page(quotes(spark, rows))[0].collect()
    assert len(page) == 20 and [r.coin_id for r in page[:3]] == ["new", "c29", "c28"]


def test_filters(spark):
    df = quotes(spark, [("quartz", "Quartz", "QTZ", 1.0, "a", T0), ("basalt", "Basalt", "BSL", 1.0, "b", T0)])
    for args, want in [({"source": "a"}, ["quartz"]), ({"symbol": "bsl"}, ["basalt"]), ({"source": "zz"}, []),
                       ({"source": "", "symbol": ""}, ["basalt", "quartz"]), ({"source": "a", "symbol": "BSL"}, [])]:
        page, total = reads.quote_page(df, **args)
        assert sorted(r.coin_id for r in page.collect()) == want and total.first().total == len(want)


@pytest.mark.parametrize("args", [{"page": 0}, {"page": -1}, {"page_size": 0}, {"page_size": 101}, {"page": "1"}, {"page": True}])
def test_page_bounds(fixture_quotes, args):
    with pytest.raises(ValueError):
        reads.quote_page(fixture_quotes, **args)


def test_deep_pages_agree_with_top_k(spark, monkeypatch):
    rows = [(f"c{i:04}", "n", "S", 1.0, "xyz"[i % 3], T0 + timedelta(hours=i % 7)) for i in range(700)]
    df = quotes(spark, rows).repartition(5)
    shallow = [[tuple(r) for r in reads.quote_page(df, p, 100)[0].collect()] for p in (1, 4, 7, 8)]
    monkeypatch.setattr(paging, "TOPK_ROWS", 0)
    deep = [[tuple(r) for r in reads.quote_page(df, p, 100)[0].collect()] for p in (1, 4, 7, 8)]
    assert shallow == deep and [len(p) for p in deep] == [100, 100, 100, 0]


def test_pages_after_a_row_agree_with_offsets(spark):
    rows = [(f"c{i:03}", "n", "S", 1.0, "xyz"[i % 3], None if i % 5 == 0 else T0 + timedelta(hours=i % 7)) for i in range(100)]
    df = quotes(spark, rows).repartition(3)
    want = [tuple(r) for p in (1, 2, 3, 4) for r in reads.quote_page(df, p, 30)[0].collect()]
    got = reads.quote_page(df, 1, 30)[0].collect()
    while len(got) < 200 and (page := reads.quote_page_after(df, got[-1].asDict(), 30).collect()):
        got += page
    assert [tuple(r) for r in got] == want and len(want) == 100


def test_deep_pages_among_rows_without_time(spark, monkeypatch):
    df = quotes(spark, [(f"c{i:03}", "n", "S", 1.0, "x", None) for i in range(300)]).repartition(4)
    monkeypatch.setattr(paging, "TOPK_ROWS", 50)
    page = reads.quote_page(df, 3, 100)[0]
    assert [r.coin_id for r in page.collect()] == [f"c{i:03}" for i in range(200, 300)]


PAGE_CASES = {
    "one time": [(f"c{i:05}", "xyz"[i % 3], T0) for i in range(900)],
    "long names alike": [("the same long beginning of all names " + "é" * (i % 4) + f"{i * 7919 % 900:04}", "x", T0) for i in range(900)],
    "names that end in zero bytes": [("a" + "\0" * (i % 5), "x", T0) for i in range(300)],
    "one time of most": [(f"c{i}", "xy"[i % 2], None if i < 200 else T0 if i < 800 else T0 + timedelta(days=i)) for i in range(900)],
    "equal rows": [("c", "x", T0)] * 500,
    "empty and short names": [("" if i % 3 == 0 else "ab"[i % 2] * (i % 11), "x", T0) for i in range(400)],
    "times before 1970": [(f"c{i}", "x", datetime(1969, 12, 31, tzinfo=timezone.utc) - timedelta(microseconds=i * 37)) for i in range(600)],
    "none": [],
}


@pytest.mark.parametrize("case", PAGE_CASES)
def test_deep_pages_in_any_order_of_rows(spark, monkeypatch, case):
    made = PAGE_CASES[case]
    df = quotes(spark, [(c, "n", "S", 1.0, s, at) for c, s, at in made]).repartition(3)
    order = sorted(made, key=lambda r: (r[2] is not None, -(r[2] - T0).total_seconds() if r[2] else 0, r[1], r[0].encode()))
    for top, place in ((0, len(made) // 2), (60, len(made) // 2), (60, max(0, len(made) - 3)), (60, len(made))):
        monkeypatch.setattr(paging, "TOPK_ROWS", top)
        got = paging.offset_page(df, reads.PAGE_ORDER, place, 20).collect()
        assert [(r.coin_id, r.source, r.updated_at and r.updated_at.timestamp()) for r in got] == [
            (c, s, at and at.timestamp()) for c, s, at in order[place : place + 20]
        ]


def test_deep_page_with_a_sketch_of_other_rows(spark, monkeypatch):
    monkeypatch.setattr(paging, "TOPK_ROWS", 30)
    rows = [(f"c{i:04}", "n", "S", 1.0, "x", T0 + timedelta(minutes=i)) for i in range(1000)]
    df = quotes(spark, rows)
    want = [f"c{i:04}" for i in range(479, 459, -1)]
    old = reads.page_sketch(quotes(spark, [(c, n, y, p, s, at - timedelta(days=9)) for c, n, y, p, s, at in rows]))
    for sketch in (reads.page_sketch(df), reads.page_sketch(df.limit(10)), old, reads.page_sketch(df.limit(0))):
        assert [r.coin_id for r in reads.quote_page(df, 27, 20, sketch=sketch)[0].collect()] == want


def test_a_deep_page_takes_three_passes(spark, monkeypatch):
    df = quotes(spark, [(f"c{i}", "n", "S", 1.0, "x", T0 + timedelta(seconds=i)) for i in range(50_000)])
    asked, real = [], type(df).first
    monkeypatch.setattr(type(df), "first", lambda self: asked.append(self) or real(self))
    rows = reads.quote_page(df, 300, 100)[0].collect()
    assert [r.coin_id for r in rows] == [f"c{i}" for i in range(49_999 - 29_900, 49_999 - 30_000, -1)]
    assert len(asked) == 3  # the sketch, its quantiles (without a job), the count; then the page


def run_rows(spark, rows):
    made = [(f"run-{i}", s, st, 100 + i, 0, sec, None, "{}", T0 + timedelta(hours=i), done) for i, (s, st, sec, done) in enumerate(rows)]
    return spark.createDataFrame(made, RUN_SCHEMA)


def at(hour):
    return T0 + timedelta(hours=hour)


def test_recent_runs(spark):
    runs = run_rows(spark, [("a", "success" if i % 2 == 0 else "failed", 1.0, at(i)) for i in range(5)])
    got = reads.recent_runs(runs, limit=3)
    assert [r.run_id for r in got.collect()] == ["run-4", "run-3", "run-2"] and got.columns == list(RUN_COLUMNS)
    assert reads.recent_runs(runs, source="zz").count() == 0 and reads.recent_runs(runs).count() == 5
    for limit in (0, 101):
        with pytest.raises(ValueError):
            reads.recent_runs(runs, limit=limit)


def checkpoints(spark, rows):
    return spark.createDataFrame([(s, "1", t, n, st, None, t, t) for s, t, n, st in rows], CHECKPOINT_SCHEMA)


def test_source_stats(spark):
    runs = run_rows(
        spark,
        [("coinpaprika", "success", 12.75, at(1)), ("csv", "success", 2.0, at(1)), ("csv", "failed", 3.0, at(2)),
         ("csv", "started", None, None), ("other", "success", 1.0, at(9)), ("coingecko", "failed", 1.0, at(5))],
    )
    cps = checkpoints(spark, [("coinpaprika", at(1), 100, "success"), ("csv", at(2), 7, "failure")])
    rows = {r.source: r for r in reads.source_stats(runs, cps).collect()}
    assert list(sorted(rows)) == ["coingecko", "coinpaprika", "csv"]
    first = rows["coinpaprika"]
    assert (first.records_processed, first.total_runs, first.success_rate) == (100, 1, 100.0)
    assert first.last_run_duration_seconds == 12.75 and first.last_failure is None
    csv = rows["csv"]
    assert (csv.total_runs, csv.success_rate, csv.last_run_duration_seconds) == (3, 33.33, 2.0)
    assert rows["coingecko"].success_rate == 0.0 and rows["coingecko"].last_run_duration_seconds is None
    empty = reads.source_stats(runs.limit(0), cps.limit(0)).collect()
    assert [(r.total_runs, r.success_rate, r.records_processed) for r in empty] == [(0, 0.0, 0)] * 3


def test_run_statistics_is_one_hash_aggregate(spark):
    plan = reads.run_statistics(run_rows(spark, [("a", "success", 1.0, at(1))]))._jdf.queryExecution().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_health(spark):
    rollup = reads.health(checkpoints(spark, [("csv", at(3), 5, "failure")]))
    rows = {r.source: r for r in rollup.collect()}
    assert (rows["csv"].last_run_status, rows["csv"].records_processed) == ("failure", 5)
    assert (rows["coingecko"].last_run_status, rows["coingecko"].last_run_time, rows["coingecko"].records_processed) == ("never_run", None, 0)
    as_map = reads.health_map(rollup).first().etl_status
    assert as_map["csv"].last_run_time == "2024-01-01T03:00:00.000000" and len(as_map) == 3


def test_fold_runs_takes_the_last_state(spark):
    events = spark.createDataFrame(
        [("r1", "a", "started", 0, 0, None, None, "{}", at(0), None), ("r1", "a", "failed", 0, 0, 2.0, "disk full", "{}", at(0), at(1)),
         ("r2", "a", "started", 0, 0, None, None, "{}", at(2), None)],
        RUN_SCHEMA,
    )
    rows = {r.run_id: r for r in control.fold_runs(events).collect()}
    assert (rows["r1"].status, rows["r1"].error_message, rows["r1"].started_at, rows["r1"].completed_at is None) == (
        "failed", "disk full", events.first().started_at, False
    )
    assert rows["r2"].status == "started"


def test_read_since(spark):
    df = spark.createDataFrame([(at(h),) for h in range(5)], "ts timestamp")
    assert control.read_since(df, "ts", None).count() == 5 and control.read_since(df, "ts", at(2)).count() == 2


def test_histogram_and_counter(spark):
    log = spark.createDataFrame(
        [("/data", "GET", 0.004), ("/data", "GET", 0.005), ("/runs", "GET", 0.3), ("/data", "POST", 99.0)],
        "endpoint string, method string, duration_seconds double",
    )
    counts = {(r.endpoint, r.method): r.requests for r in metrics.request_counter(log).collect()}
    assert counts == {("/data", "GET"): 2, ("/runs", "GET"): 1, ("/data", "POST"): 1}
    rows = metrics.latency_histogram(log).collect()
    assert [r.le for r in rows][:2] == ["0.005", "0.01"] and rows[-1].le == "+Inf" and len(rows) == 15
    assert [r.bucket_count for r in rows] == [2, 2, 2, 2, 2, 2, 2] + [3] * 7 + [4]
    empty = metrics.latency_histogram(log.limit(0)).collect()
    assert len(empty) == 15 and {r.bucket_count for r in empty} == {0} and empty[0].total_seconds == 0.0


def found(spark, expected, text):
    records = spark.createDataFrame([(text,)], "t string").select(F.parse_json("t").alias("record"))
    return sorted(
        (r.drift_type, r.field_name, r.expected_type, r.actual_type, r.confidence_score, r.sample_value)
        for r in drift.detect(records, expected, "s", F.lit(T0)).collect()
    )


def test_drift(spark):
    three = {"id": "str", "name": "str", "price": "float"}
    assert found(spark, three, '{"id":"quartz","name":"Quartz"}') == [("missing_field", "price", "float", None, 1.0, None)]
    two = {"id": "str", "name": "str"}
    assert found(spark, two, '{"id":"quartz","name":"Quartz","grade":"fine"}') == [
        ("new_field", "grade", None, "str", 0.8, "fine")
    ]
    assert found(spark, three, '{"id":"x","name":null,"price":5}') == []
    assert found(spark, three, '{"id":1,"name":"n","price":"5"}') == [
        ("type_change", "id", "str", "int", 0.9, "1"), ("type_change", "price", "float", "str", 0.9, "5")
    ]
    assert found(spark, {}, "{}") == [] and found(spark, three, "[1]") == []
    long = found(spark, {}, '{"a":"' + "x" * 500 + '"}')
    assert long[0][-1] == "x" * 200


def test_drift_summary_and_plan(spark):
    records = spark.range(10).select(F.parse_json(F.lit('{"a":1}')).alias("record"))
    detected = drift.detect(records, {"b": "str"}, "s", F.lit(T0))
    assert "Exchange" not in detected._jdf.queryExecution().executedPlan().toString()
    rows = drift.summarize(detected).collect()
    assert sorted((r.drift_type, r.field_name, r.occurrences) for r in rows) == [("missing_field", "b", 10), ("new_field", "a", 10)]
