"""Whole loads, incremental loads and their control records."""

import json
import re
from dataclasses import replace
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from quotelake.plans import control, reads
from quotelake.plans.pipeline import load_batch, run_all, run_source, scan_source, utc_now, with_retry
from quotelake.session import settings
from quotelake.specs import CSV, MARKET, SOURCES, TICKER, FieldSpec, SourceSpec
from quotelake.streaming.ingest import load_new_files
from quotelake.tables import Lake


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf8")
    return str(path)


HEADER = "coin_id,name,symbol,price,market_cap,volume\n"


@pytest.fixture
def lake(spark, tmp_path):
    made = Lake(spark, str(tmp_path / "lake"))
    made.create_tables()
    return made


def unified(lake):
    return {(r.source, r.coin_id): r for r in lake.unified.read().collect()}


def ticker(i, **more):
    usd = {"price": i + 0.5, "volume_24h": i, "market_cap": i * 10, "percent_change_24h": 1}
    return {"id": f"t{i}", "name": f"T{i}", "symbol": f"t{i}", "rank": i, "quotes": {"USD": usd}, **more}


def landed(tmp_path):
    listing = [{"id": f"t{i}", "is_active": i != 3} for i in range(80)]
    tickers = [ticker(i) for i in range(60)] + [ticker(70, rank="x")]
    market = [{"id": f"m{i}", "name": "M", "symbol": "m", "market_cap": i, "current_price": 1} for i in range(70)]
    return {
        TICKER.name: (
            write(tmp_path / "t" / "d.json", "\n".join(map(json.dumps, tickers))),
            write(tmp_path / "l" / "l.json", json.dumps(listing)),
        ),
        MARKET.name: write(tmp_path / "m" / "m.json", json.dumps(market)),
        CSV.name: write(tmp_path / "c" / "c.csv", HEADER + "a,A,aa,1,2,3\nb,,bb,1,2,3\na,A2,ax,5,,x\n"),
    }


def test_run_all_loads_limits_and_reports(spark, lake, tmp_path):
    inputs = landed(tmp_path)
    limited = {**SOURCES, TICKER.name: replace(TICKER, limit=50), MARKET.name: replace(MARKET, limit=50)}
    results = run_all(lake, inputs, limited, attempts=1)
    assert [(r.source, r.status, r.processed, r.failed) for r in results] == [
        ("coinpaprika", "success", 50, 0), ("coingecko", "success", 50, 0), ("csv", "success", 2, 1)
    ]
    rows = unified(lake)
    assert len(rows) == 101
    tickers = {c for s, c in rows if s == "coinpaprika"}
    assert tickers == {f"t{i}" for i in range(51) if i != 3}
    assert {c for s, c in rows if s == "coingecko"} == {f"m{i}" for i in range(20, 70)}
    a = rows["csv", "a"]  # first row's texts, last row's metrics, NULL included
    assert (a.name, a.symbol, a.price_usd, a.market_cap_usd, a.volume_24h_usd) == ("A", "AA", 5.0, None, None)
    assert lake.quarantine(CSV).first().reject_reasons == ["name_invalid"]
    cp = control.get_checkpoint(lake, "csv")
    assert (cp.last_processed_id, cp.records_processed, cp.last_run_status) == ("3", 2, "success")
    assert control.get_checkpoint(lake, "none") is None

    created, ids = rows["csv", "a"].created_at, rows["csv", "a"].id
    run_all(lake, inputs, limited, attempts=1)
    again = unified(lake)
    assert len(again) == 101 and again["csv", "a"].created_at == created and again["csv", "a"].id == ids
    assert again["csv", "a"].updated_at > created
    assert lake.raw(CSV).count() == 4  # raw rows are kept from every run
    stats = {r.source: r for r in reads.source_stats(control.runs(lake), control.checkpoints(lake)).collect()}
    assert (stats["csv"].total_runs, stats["csv"].success_rate, stats["csv"].records_processed) == (2, 100.0, 2)
    assert reads.source_stats(control.runs(lake), control.checkpoints(lake)).count() == 3


def test_failing_source_stops_no_other(spark, lake, tmp_path):
    inputs = {**landed(tmp_path), MARKET.name: str(tmp_path / "missing")}
    results = {r.source: r for r in run_all(lake, inputs, attempts=1)}
    assert results["coingecko"].status == "failed" and results["csv"].status == "success"
    cp = control.get_checkpoint(lake, "coingecko")
    assert (cp.last_run_status, cp.last_processed_id) == ("failure", "") and "missing" in cp.last_error
    run = control.runs(lake).filter("source_name = 'coingecko'").first()
    assert run.status == "failed" and run.error_message and run.completed_at is not None and run.duration_seconds >= 0
    health = {r.source: r.last_run_status for r in reads.health(control.checkpoints(lake)).collect()}
    assert health == {"coinpaprika": "success", "coingecko": "failure", "csv": "success"}


def test_sources_side_by_side_give_the_rows_of_sources_in_turn(spark, lake, tmp_path):
    inputs = landed(tmp_path)
    other = Lake(spark, str(tmp_path / "beside"))
    for _ in range(2):
        in_turn = run_all(lake, inputs, attempts=1, drift="summary")
        beside = run_all(other, inputs, attempts=1, drift="summary", at_once=3)
        assert [(r.source, r.status, r.processed, r.failed) for r in in_turn] == [(r.source, r.status, r.processed, r.failed) for r in beside]
    columns = [c for c in lake.unified.schema.names if not c.endswith("_at")]
    rows = [sorted(map(repr, x.unified.read().select(*columns).collect())) for x in (lake, other)]
    assert rows[0] == rows[1] and rows[0]
    for name in ("runs", "checkpoints", "drift"):
        assert getattr(lake, name).read().count() == getattr(other, name).read().count() > 0
    assert [lake.raw(s).count() for s in (TICKER, MARKET, CSV)] == [other.raw(s).count() for s in (TICKER, MARKET, CSV)]


def test_a_failing_source_stops_none_beside_it(spark, lake, tmp_path):
    inputs = {**landed(tmp_path), MARKET.name: str(tmp_path / "missing")}
    results = {r.source: r.status for r in run_all(lake, inputs, attempts=1, at_once=2)}
    assert results == {"coinpaprika": "success", "coingecko": "failed", "csv": "success"}
    assert {r.source for r in lake.unified.read().select("source").distinct().collect()} == {"coinpaprika", "csv"}
    with pytest.raises(ValueError):
        run_all(lake, inputs, at_once=0)


def test_run_source_reraises(spark, lake):
    with pytest.raises(ZeroDivisionError):
        run_source(lake, CSV, lambda: 1 / 0, attempts=1)


def test_empty_batch_succeeds_with_empty_checkpoint(spark, lake, tmp_path):
    path = write(tmp_path / "e.csv", HEADER)
    result = run_source(lake, CSV, lambda: scan_source(spark, CSV, path), attempts=1)
    assert (result.status, result.processed) == ("success", 0)
    cp = control.get_checkpoint(lake, "csv")
    assert (cp.last_processed_id, cp.records_processed, cp.last_run_status) == ("", 0, "success")
    assert lake.unified.read().count() == 0


def test_retry_waits_longer_and_gives_up(spark):
    waits, calls = [], []

    def fails():
        calls.append(1)
        raise OSError("down")

    with pytest.raises(OSError):
        with_retry(fails, 5, waits.append)
    assert len(calls) == 5 and waits == [2, 2, 4, 8]
    assert with_retry(lambda: 7, 3) == 7


def test_raw_rows_keep_type_case_and_unknown_fields(spark, lake, tmp_path):
    assert lake.raw(MARKET).count() == 0 and lake.quarantine(MARKET).count() == 0  # nothing loaded yet
    rows = [{"id": "m1", "name": "M", "symbol": "mm", "price_change_24h": "7.5", "extra": [1]}, {"id": 5}]
    path = write(tmp_path / "m.json", json.dumps(rows))
    run_source(lake, MARKET, lambda: scan_source(spark, MARKET, path), attempts=1)
    raw = lake.raw(MARKET).withColumn("raw_data", F.to_json("raw_data")).collect()
    assert len(raw) == 1 and (raw[0].symbol, raw[0].price_change_24h, raw[0].market_cap) == ("mm", 7.5, None)
    assert json.loads(raw[0].raw_data) == rows[0]
    bad = lake.quarantine(MARKET).withColumn("raw_data", F.to_json("raw_data")).first()
    assert json.loads(bad.raw_data) == {"id": 5}
    assert bad.reject_reasons == ["coin_id_invalid", "name_invalid", "symbol_invalid"]


def test_same_batch_id_is_a_no_op(spark, lake, tmp_path):
    path = landed(tmp_path)[CSV.name]
    now = utc_now()
    for _ in range(2):
        assert load_batch(lake, CSV, scan_source(spark, CSV, path), "b1", now) == (2, 1)
    assert lake.raw(CSV).count() == 2 and lake.quarantine(CSV).count() == 1


@pytest.mark.parametrize("form,rows", [("rows", 4), ("summary", 2)])
def test_drift_behind_a_flag(spark, lake, tmp_path, form, rows):
    records = [{"id": "a", "name": "A", "symbol": "a", "extra": 1, "quotes": {}}] * 2
    path = write(tmp_path / "d.json", "\n".join(map(json.dumps, records)))
    run_source(lake, TICKER, lambda: scan_source(spark, TICKER, path), drift=form, attempts=1)
    got = lake.drift.read()
    assert got.count() == rows and not got.filter("resolved").count()
    assert {(r.drift_type, r.field_name) for r in got.collect()} == {("missing_field", "rank"), ("new_field", "extra")}


def test_a_new_source_is_only_a_spec(spark, lake, tmp_path):
    spec = SourceSpec(
        "broker",
        (FieldSpec("coin_id", "string", "coin_id", ("sku",), 100), FieldSpec("name", "string", "name", ("title",), 255),
         FieldSpec("symbol", "string", "symbol", (), 50, upper=True), FieldSpec("last", "double", "price_usd")),
        "ndjson",
        ("price_usd",),
    )
    path = write(tmp_path / "b.json", '{"sku":"x","title":"X","symbol":"xx","last":"1_0.5"}')
    results = run_all(lake, {"broker": path}, {"broker": spec}, attempts=1)
    row = unified(lake)["broker", "x"]
    assert results[0].processed == 1 and (row.symbol, row.price_usd) == ("XX", 10.5)
    with pytest.raises(ValueError):
        replace(spec, name="a/b")
    with pytest.raises(ValueError):
        replace(spec, update_columns=("name",))


def test_stream_equals_batch_and_replay_adds_nothing(spark, lake, tmp_path):
    folder, checkpoint = tmp_path / "in", str(tmp_path / "cp")
    write(folder / "1.csv", HEADER + "a,A,aa,1,2,3\nb,B,bb,1,2,3\nbad,,x,1,2,3\n")
    load_new_files(lake, CSV, str(folder), checkpoint)
    write(folder / "2.csv", HEADER + "a,ignored,zz,9,,3\nc,C,cc,1,2,3\n")
    load_new_files(lake, CSV, str(folder), checkpoint)
    runs_before = control.runs(lake).count()
    load_new_files(lake, CSV, str(folder), checkpoint)
    assert control.runs(lake).count() == runs_before == 2
    rows = unified(lake)
    assert {c for _, c in rows} == {"a", "b", "c"} and rows["csv", "a"].name == "A" and rows["csv", "a"].price_usd == 9.0
    # a lost checkpoint entry delivers the last batch again: same id, no change
    before = lake.unified.read().select("coin_id", "price_usd", "updated_at").orderBy("coin_id").collect()
    last = max((p for p in (tmp_path / "cp" / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    (tmp_path / "cp" / "commits" / f".{last.name}.crc").unlink(missing_ok=True)
    last.unlink()
    load_new_files(lake, CSV, str(folder), checkpoint)
    assert lake.unified.read().select("coin_id", "price_usd", "updated_at").orderBy("coin_id").collect() == before
    assert control.runs(lake).count() == 2 and lake.raw(CSV).count() == 4


@pytest.mark.parametrize("spec", [TICKER, MARKET])
def test_json_streams(spark, lake, tmp_path, spec):
    rows = [ticker(i) for i in range(3)] if spec is TICKER else [{"id": "m", "name": "M", "symbol": "m", "market_cap": 1}]
    text = "\n".join(map(json.dumps, rows)) if spec.layout == "ndjson" else json.dumps(rows)
    write(tmp_path / "in" / "1.json", text)
    load_new_files(lake, spec, str(tmp_path / "in"), str(tmp_path / "cp"))
    assert lake.unified.read().filter(F.col("source") == spec.name).count() == len(rows)


def test_split_arrays_load_as_whole_ones(spark, lake, tmp_path):
    page = [{"id": f"m{i}", "name": 'M},{"', "symbol": "m", "market_cap": i, "extra": [{"x": i}]} for i in range(200)]
    write(tmp_path / "in" / "1.json", json.dumps(page + [{"id": "m0", "name": "last", "symbol": "m", "market_cap": 7}]))
    split = replace(MARKET, layout="json_array_split")
    other = Lake(spark, str(tmp_path / "other"))
    streamed = Lake(spark, str(tmp_path / "streamed"))
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "500"}):
        for kept, spec in ((lake, MARKET), (other, split)):
            kept.create_tables()
            run_source(kept, spec, lambda spec=spec: scan_source(spark, spec, str(tmp_path / "in")), None)
        load_new_files(streamed, split, str(tmp_path / "in"), str(tmp_path / "cp"))
    columns = ("coin_id", "name", "symbol", "market_cap_usd")
    want, *got = (sorted(map(tuple, k.unified.read().select(*columns).collect())) for k in (lake, other, streamed))
    assert len(want) == 200 and got == [want, want]
    assert want[0] == ("m0", 'M},{"', "M", 7.0)


def test_several_polls_keep_every_entity(spark, lake, tmp_path):
    for poll in range(4):
        page = [{"id": f"m{i}", "name": "M", "symbol": "m", "market_cap": i, "current_price": poll} for i in range(60)]
        write(tmp_path / "polls" / f"{poll}.json", json.dumps(page))
    (result,) = run_all(lake, {MARKET.name: str(tmp_path / "polls")}, attempts=1)
    assert (result.status, result.processed) == ("success", 240)
    assert {(c, r.price_usd) for (_, c), r in unified(lake).items()} == {(f"m{i}", 3.0) for i in range(60)}


def test_counts_beyond_32_bits(spark, lake):
    control.update_checkpoint(lake, "csv", "x", utc_now(), "success", 3_000_000_000)
    assert control.get_checkpoint(lake, "csv").records_processed == 3_000_000_000


@pytest.mark.parametrize("form,rows", [("rows", 4), ("summary", 2)])
def test_drift_of_a_redelivered_batch_is_stored_once(spark, lake, tmp_path, form, rows):
    records = [{"id": "a", "name": "A", "symbol": "a", "extra": 1, "quotes": {}}] * 2
    path = write(tmp_path / "d.json", "\n".join(map(json.dumps, records)))
    for _ in range(2):
        load_batch(lake, TICKER, scan_source(spark, TICKER, path), "same", utc_now(), form)
    got = lake.drift.read()
    assert got.count() == rows and got.agg(F.sum("occurrences")).first()[0] == 4


def replayed(tmp_path):
    """Forget that the last micro-batch was committed, so that it is delivered again."""
    last = max((p for p in (tmp_path / "cp" / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    (tmp_path / "cp" / "commits" / f".{last.name}.crc").unlink(missing_ok=True)
    last.unlink()


def test_a_stream_selects_by_the_listing_as_a_batch_does(spark, lake, tmp_path):
    spec = replace(TICKER, limit=3)
    listing = [{"id": "t1"}, {"id": "t2", "is_active": False}, {"id": "t3", "is_active": True}, {"id": "t4", "is_active": None}, {"id": "t5"}, {"id": "t0"}]
    listing_path = write(tmp_path / "listing" / "1.json", json.dumps(listing))
    options = dict(checkpoint=str(tmp_path / "cp"), listing_path=str(tmp_path / "listing"))
    for lot in ((0, 1, 2), (3, 4, 5)):
        write(tmp_path / "in" / f"{lot[0]}.json", "\n".join(json.dumps(ticker(i)) for i in lot))
        load_new_files(lake, spec, str(tmp_path / "in"), **options)
    batch = Lake(spark, str(tmp_path / "batch"))
    run_all(batch, {spec.name: (str(tmp_path / "in"), listing_path)}, {spec.name: spec}, attempts=1)
    want = {("coinpaprika", i) for i in ("t1", "t3", "t5")}
    assert set(unified(lake)) == set(unified(batch)) == want
    before = sorted(lake.unified.read().collect())
    replayed(tmp_path)
    load_new_files(lake, spec, str(tmp_path / "in"), **options)
    assert sorted(lake.unified.read().collect()) == before and lake.raw(spec).count() == len(want)
    # the next micro-batch reads the listing as it is by then
    write(tmp_path / "listing" / "2.json", json.dumps([{"id": "t9"}]))
    write(tmp_path / "in" / "9.json", json.dumps(ticker(9)))
    load_new_files(lake, spec, str(tmp_path / "in"), **options)
    assert set(unified(lake)) == want | {("coinpaprika", "t9")}


def test_raw_rows_lie_by_day_and_reads_open_later_days_only(spark, lake, tmp_path):
    path = write(tmp_path / "c.csv", HEADER + "a,A,aa,1,2,3\n")
    days = [datetime(2024, 1, d, 12, tzinfo=timezone.utc) for d in (1, 2, 3)]
    for n, day in enumerate(days):
        load_batch(lake, CSV, scan_source(spark, CSV, path), f"b{n}", day)
    assert lake.raw_since(CSV, None).count() == lake.raw(CSV).count() == 3
    rows = lake.raw_since(CSV, days[1])
    assert [r.batch_id for r in rows.collect()] == ["b2"]
    with settings(spark, {"spark.sql.maxMetadataStringLength": "10000"}):  # else filters are cut where column numbers are long
        plan = lake.raw_since(CSV, days[1])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*ingest_date#\d+ >= 20", plan), plan


def test_a_batch_delivered_again_on_another_day_keeps_its_day(spark, lake, tmp_path):
    path = write(tmp_path / "c.csv", HEADER + "a,A,aa,1,2,3\n")
    days = iter(datetime(2024, 1, d, tzinfo=timezone.utc) for d in range(1, 9))

    def broken():
        raise ValueError("lost")

    with pytest.raises(ValueError):
        run_source(lake, CSV, broken, attempts=1, clock=lambda: next(days), run_id="one")
    for _ in range(2):
        done = run_source(lake, CSV, lambda: scan_source(spark, CSV, path), attempts=1, clock=lambda: next(days), run_id="one")
        assert (done.status, done.processed, done.failed) == ("success", 1, 0)
    assert [str(r.ingest_date) for r in lake.raw(CSV).collect()] == ["2024-01-01"]


def test_findings_are_resolved_and_open_again(spark, lake, tmp_path):
    lots = [[{"extra": 1}], [{}], [{"extra": 2}], [{"extra": "x"}]]
    for n, more in enumerate(lots):
        path = write(tmp_path / f"{n}.json", json.dumps(ticker(1, **more[0])))
        run_source(lake, TICKER, lambda path=path: scan_source(spark, TICKER, path), "rows", clock=lambda n=n: datetime(2024, 1, 1 + n, tzinfo=timezone.utc), run_id=f"r{n}")
    got = {r.actual_type: r for r in control.drift_state(lake).collect()}
    assert (got["int"].first_seen.day, got["int"].last_seen.day, got["int"].resolved_at.day, got["int"].occurrences) == (1, 3, 4, 2)
    assert got["str"].resolved_at is None and not got["str"].resolved and got["int"].resolved
