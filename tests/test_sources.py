"""Scans of landed CSV and JSON files and the listing operators."""

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from quotelake.catalog import records as record_queries
from quotelake.functions.coerce import json_to_string
from quotelake.session import settings
from quotelake.sources import csv_files, listing
from quotelake.sources.json_files import read_json, scan_json


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf8")
    return str(path)


HEADER = "coin_id,name,symbol,price\n"


def test_csv_missing_tokens_quotes_and_lengths(spark, tmp_path):
    lines = [
        "a,Alpha,AAA,1",
        "b,NA,null,",
        'c,"x, ""y""",CCC,nan',
        "d,Delta",  # short: the rest is missing
        "e,Eps,EEE,1,2",  # long: malformed
        'f,"p,q",FFF,1',
        "g,Gam,GGG,1,",  # long with a blank
        "007, pad ,S,1",
    ]
    path = write(tmp_path / "a.csv", HEADER + "\n".join(lines) + "\n\n")
    rows = {r.coin_id: r for r in csv_files.scan_csv(spark, path).collect()}
    assert set(rows) == {"a", "b", "c", "d", "e", "f", "g", "007"}
    assert (rows["b"].name, rows["b"].symbol, rows["b"].price) == (None, None, None)
    assert rows["c"].name == 'x, "y"' and rows["c"].price is None
    assert (rows["d"].name, rows["d"].symbol, rows["d"].malformed) == ("Delta", None, False)
    assert rows["007"].name == " pad "
    assert {k for k, r in rows.items() if r.malformed} == {"e", "g"}


def test_csv_line_breaks_in_quotes(spark, tmp_path):
    path = write(tmp_path / "a.csv", HEADER + 'a,"two\nlines",AAA,1\nb,Beta,BBB,2\n')
    rows = csv_files.scan_csv(spark, path, multi_line=True).orderBy("ord").collect()
    assert [(r.coin_id, r.name) for r in rows] == [("a", "two\nlines"), ("b", "Beta")]


def test_csv_long_rows_are_malformed_under_any_projection(spark, tmp_path):
    long = '"' + "x" * 20_000 + '"'
    path = write(tmp_path / "a.csv", HEADER + f"a,{long},AAA,1,more\nb,Beta,BBB,2\n")
    assert [r.malformed for r in csv_files.scan_csv(spark, path).orderBy("ord").collect()] == [True, False]
    assert [tuple(r) for r in csv_files.scan_csv(spark, path).select("coin_id", "malformed").collect()] == [("a", True), ("b", False)]
    assert csv_files.scan_csv(spark, path).filter("malformed").count() == 1


def test_csv_columns_go_by_name_and_headers_must_agree(spark, tmp_path):
    write(tmp_path / "in" / "a.csv", "price,symbol,coin_id,name,extra\n1,AAA,a,Alpha,z\n")
    row = csv_files.scan_csv(spark, str(tmp_path / "in")).first()
    assert (row.coin_id, row.price) == ("a", "1")
    payload = csv_files.scan_csv(spark, str(tmp_path / "in")).select(F.to_json("payload")).first()[0]
    assert json.loads(payload)["extra"] == "z"
    write(tmp_path / "in" / "b.csv", HEADER + "b,Beta,BBB,2\n")
    with pytest.raises(Exception):
        csv_files.scan_csv(spark, str(tmp_path / "in")).collect()


def test_csv_order_follows_the_file(spark, tmp_path):
    path = write(tmp_path / "a.csv", HEADER + "".join(f"c{i},n,s,{i}\n" for i in range(500)))
    rows = csv_files.scan_csv(spark, path).orderBy("ord").collect()
    assert [r.price for r in rows] == [str(i) for i in range(500)]


def test_sample_file_is_written_once(spark, tmp_path):
    path = str(tmp_path / "new" / "quotes.csv")
    csv_files.create_sample_csv(spark, path)
    csv_files.create_sample_csv(spark, path)
    rows = csv_files.scan_csv(spark, path).orderBy("ord").collect()
    assert [r.coin_id for r in rows] == ["bitcoin", "ethereum", "binancecoin", "cardano", "solana"]
    assert rows[0].price == "43250.5" and rows[0].market_cap == "846000000000"


def test_unreadable_source_raises(spark, tmp_path):
    with pytest.raises(Exception):
        csv_files.scan_csv(spark, str(tmp_path / "none.csv")).collect()


def test_json_array_keeps_order_and_bad_pages(spark, tmp_path):
    write(tmp_path / "p" / "1.json", json.dumps([{"id": f"a{i}"} for i in range(30)], indent=1))
    write(tmp_path / "p" / "2.json", "[]")
    write(tmp_path / "p" / "3.json", '{"id":"not a list"}')
    write(tmp_path / "p" / "4.json", '[{"id":')
    df = scan_json(spark, str(tmp_path / "p"), "json_array")
    good = df.filter("not malformed").orderBy("ord")
    ids = [r[0] for r in good.select(json_to_string(listing.variant_field("record", "id"))).collect()]
    assert ids == [f"a{i}" for i in range(30)]
    assert df.filter("malformed").count() == 2


ODD = ['"', "\\", '\\"', "}", "{", "[", "]", ",", "},{", "]}", "\n", "é", "日本", "a", ""]


def any_value(dice, depth=0):
    kind = dice.randrange(8 if depth < 3 else 4)
    if kind < 2:
        return "".join(dice.choices(ODD, k=dice.randrange(6)))
    if kind < 4:
        return dice.choice([None, True, 12, -3.5])
    if kind == 4:
        return [any_value(dice, depth + 1) for _ in range(dice.randrange(4))]
    return {f"{k}{dice.choice(ODD)}": any_value(dice, depth + 1) for k in range(dice.randrange(4))}


def split_rows(spark, path, size):
    """Records in order, read in splits of ``size`` bytes."""
    with settings(spark, {"spark.sql.files.maxPartitionBytes": str(size)}):
        df = scan_json(spark, path, "json_array_split")
        return df.select("ord.file_path", "ord.file_block", F.to_json("payload"), "malformed", "ord").orderBy("ord").collect()


@pytest.mark.parametrize("size", [11, 64, 1 << 20])
def test_split_arrays_equal_whole_ones(spark, tmp_path, size):
    dice, want = random.Random(size), []
    for n in range(12):
        values = [any_value(dice) for _ in range(dice.randrange(12))]
        text = json.dumps(values, indent=dice.choice([None, 2]), ensure_ascii=dice.random() < 0.5)
        write(tmp_path / "p" / f"{n:02}.json", dice.choice(["", " \n", "\ufeff"]) + text + dice.choice(["", "\n"]))
        want.append(values)
    rows = split_rows(spark, str(tmp_path / "p"), size)
    assert not any(r.malformed for r in rows)
    got = [[json.loads(r[2]) for r in rows if r.file_path.endswith(f"/{n:02}.json")] for n in range(12)]
    assert got == want
    if size == 11:
        assert len({(r.file_path, r.file_block) for r in rows}) > 30


@pytest.mark.parametrize("size", [5, 1 << 20])
def test_split_arrays_that_are_damaged(spark, tmp_path, size):
    texts = {
        "empty": ("", []),
        "none": ("[]", []),
        "blank": (" ", [(" ", True)]),
        "bad_record": ('[{"a":1},{"b":tru},{"c":3}]', [({"a": 1}, False), (',{"b":tru}', True), ({"c": 3}, False)]),
        "no_comma": ('[{"a":1}{"b":2}]', [({"a": 1}, False), ('{"b":2}', True)]),
        "two_commas": ('[{"a":1},,{"b":2}]', [({"a": 1}, False), (',,{"b":2}', True)]),
        "last_comma": ('[{"a":1},]', [({"a": 1}, False), (",]", True)]),
        "numbers": ('[1,2,{"a":3},4]', [(1, False), (2, False), ({"a": 3}, False), (4, False)]),
        "wrong_bracket": ('[{"a":[1}],{"b":2}]', None),
        "unclosed": ('[{"a":1},{"b":2}', [('[{"a":1}', True), (',{"b":2', True)]),
        "in_string": ('[{"a":1},{"b":"2}]', None),
        "object": ('{"a":[{"b":1},{"c":2}]}', None),
        "two_arrays": ('[{"a":1}][{"b":2}]', [({"a": 1}, False), ('][{"b":2}', True)]),
    }
    for name, (text, _) in texts.items():
        write(tmp_path / "p" / f"{name}.json", text)
    rows = split_rows(spark, str(tmp_path / "p"), size)
    for name, (_, want) in texts.items():
        got = [(json.loads(r[2]), r.malformed) for r in rows if r.file_path.endswith(f"/{name}.json")]
        if want is None:
            assert got and all(bad for _, bad in got), name
        else:
            assert got == want, name


def test_split_arrays_read_once(spark, tmp_path):
    path = write(tmp_path / "a.json", json.dumps([{"id": i} for i in range(3000)]))
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "1000"}):
        df = scan_json(spark, path, "json_array_split")
        assert df.count() == 3000
        df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    assert "ReusedExchange" in final and final.count("FileScan text") == 1


def test_split_arrays_count_a_piece_once(spark, tmp_path):
    path = write(tmp_path / "a.json", json.dumps([{"id": i, "x": '\\"[{'} for i in range(300)]))
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "1000"}):
        df = scan_json(spark, path, "json_array_split")
        assert df.count() == 300
        df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    assert final.count("regexp_replace(value") == 1  # and not in both uses of the pieces


def test_small_splits_share_tasks(spark, tmp_path, monkeypatch):
    dice, scans = random.Random(3), []
    texts = ["".join(dice.choices(ODD, k=30_000)) for _ in range(30)]
    rows = [(i, text, "en", len(text)) for i, text in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    monkeypatch.setattr(record_queries, "scan_json", lambda *a: scans.append(a) or scan_json(*a))
    got = record_queries.json_array_split(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.text_md5, r.n_chars, r.malformed) for r in got) == [
        (i, hashlib.md5(text.encode()).hexdigest(), n, False) for i, text, _, n in rows
    ]
    pieces = read_json(*scans[0])
    splits = pieces.select("_file_path", "_file_block").distinct().count()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert splits > 5 * tasks and pieces.rdd.getNumPartitions() <= 2 * tasks


def test_json_lines(spark, tmp_path):
    path = write(tmp_path / "a.json", '{"id":"a","x":null}\n\n   \nnot json\n{"id":"b"}\n')
    df = scan_json(spark, path, "ndjson").orderBy("ord")
    rows = df.select(F.to_json("payload"), "malformed").collect()
    assert [tuple(r) for r in rows] == [
        ('{"id":"a","x":null}', False), ('"not json"', True), ('{"id":"b"}', False)
    ]


def records(spark, values):
    rows = [(i, json.dumps(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "ord int, t string").select("ord", F.parse_json("t").alias("record"))


def test_active_filter_and_first_n(spark):
    flags = [True, False, None, 0, 1, "", "false", [], [0], {}, {"a": 1}]
    listed = records(spark, [{"id": "x"}, *[{"id": "x", "is_active": f} for f in flags]])
    kept = [r.ord for r in listing.active_only(listed).orderBy("ord").collect()]
    assert kept == [0] + [i + 1 for i, f in enumerate(flags) if f]
    assert [r.ord for r in listing.first_n(listing.active_only(listed), 3).collect()] == kept[:3]
    many = records(spark, [{"id": str(i)} for i in range(60)])
    assert listing.first_n(listing.active_only(many)).count() == 50


def test_flatten_quotes(spark):
    usd = {"price": 1.5, "volume_24h": 2, "market_cap": "3", "percent_change_24h": None}
    cases = [
        {"id": "full", "quotes": {"USD": usd}},
        {"id": "no quotes"},
        {"id": "no usd", "quotes": {}},
        {"id": "null quotes", "quotes": None},
        {"id": "null usd", "quotes": {"USD": None}},
        {"id": "list quotes", "quotes": []},
        {"id": "text usd", "quotes": {"USD": "x"}},
        {"id": "empty usd", "quotes": {"USD": {}}},
        [1],
        "text",
        None,
    ]
    flat = listing.flatten_quotes(records(spark, cases))
    got = {json.loads(r[0]): r[1:] for r in flat.select(F.to_json("id"), F.to_json("price_usd"), F.to_json("market_cap_usd")).collect()}
    assert got == {
        "full": ("1.5", '"3"'), "no quotes": (None, None), "no usd": (None, None), "empty usd": (None, None)
    }


def test_market_top(spark):
    caps = [5, "7", None, 7, 1, "bad"]
    df = records(spark, [{"id": f"c{i}", "market_cap": c} for i, c in enumerate(caps)])
    files = df.withColumn("ord", F.struct(F.lit("f").alias("file_path"), F.col("ord").alias("row")))
    assert {r.ord.row for r in listing.market_top_records(files, n=4).collect()} == {1, 3, 0, 4}
    two = files.unionByName(files.withColumn("ord", F.struct(F.lit("g").alias("file_path"), F.col("ord.row").alias("row"))))
    assert listing.market_top_records(two, n=4).count() == 8
    marked = two.withColumn("malformed", F.col("ord.row") == 2)
    assert listing.market_top_records(marked, n=1).count() == 4


def test_enrich_keeps_listed_keys(spark):
    detail = spark.range(100).withColumnRenamed("id", "k")
    listed = spark.createDataFrame([(1,), (2,), (500,)], "k long")
    assert sorted(r.k for r in listing.enrich(listed, detail, "k").collect()) == [1, 2]
