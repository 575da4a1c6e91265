"""Readers, sinks, binary frames and recomputing days, on small files of their own."""

import datetime as dt
import json
import struct

import pytest
from pyspark.sql import functions as F

from tickloom.sources import decode, history, readers, sinks
from tickloom.streaming import incremental

DAY1, DAY2 = dt.date(2024, 1, 2), dt.date(2024, 1, 3)


def pack(value) -> bytes:
    """MessagePack of the few kinds that the tests use."""
    if value is None or isinstance(value, bool):
        return bytes([{None: 0xC0, False: 0xC2, True: 0xC3}[value]])
    if isinstance(value, int):
        return bytes([value]) if 0 <= value < 128 else b"\xd3" + struct.pack(">q", value)
    if isinstance(value, float):
        return b"\xcb" + struct.pack(">d", value)
    if isinstance(value, str):
        raw = value.encode()
        return b"\xda" + struct.pack(">H", len(raw)) + raw
    if isinstance(value, dict):
        return b"\xde" + struct.pack(">H", len(value)) + b"".join(pack(k) + pack(v) for k, v in value.items())
    return b"\xdc" + struct.pack(">H", len(value)) + b"".join(map(pack, value))


def put(path, text: str) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


@pytest.fixture()
def feed(tmp_path):
    """Two symbols' trades, one object a line with a blank and a broken line, beside a group that is not asked for."""
    row = {"command": "UpdateTrades", "symbol": "other", "trade_id": "7", "price": "10.5", "volume": "bad"}
    put(tmp_path / "aaa" / "UpdateTrades" / "2024" / "2024-01-02.json", json.dumps(row) + "\n\n{broken\n" + json.dumps(row | {"trade_id": "8"}) + "\n")
    put(tmp_path / "BBB" / "updatetrades" / "2024" / "2024-01-03.json", json.dumps(row | {"trade_id": "9"}) + "\n")
    put(tmp_path / "BBB" / "updateorderbooks" / "2024" / "2024-01-03.json", json.dumps(row) + "\n")
    return str(tmp_path)


def test_lines_by_group_and_folder(spark, feed):
    rows = readers.read_lines(spark, feed, "updatetrades", broken=False).select("symbol", "file_date", "trade_id", "price", "volume").collect()
    assert sorted(map(tuple, rows)) == [("AAA", "2024-01-02", "7", "10.5", "bad"), ("AAA", "2024-01-02", "8", "10.5", "bad"), ("BBB", "2024-01-03", "9", "10.5", "bad")]
    assert {r.symbol for r in readers.read_lines(spark, feed, "updatetrades", " bbb,").collect()} == {"BBB"}


def test_lenient_files_of_every_shape(spark, tmp_path):
    a, b = ({"trade_id": str(i), "price": "1", "bid_levels": None} for i in (1, 2))
    shapes = {"one": json.dumps(a), "array": json.dumps([a, 5, b]), "mark": "\ufeff" + json.dumps(a, indent=2) + json.dumps(b, indent=2), "empty": "", "cut": json.dumps(a) + '{"trade_id": "2'}
    for name, text in shapes.items():
        put(tmp_path / name / "updatetrades" / "2024-01-02.json", text)
    rows = readers.read_lenient(spark, str(tmp_path), "updatetrades", broken=False).select("symbol", "pos", "trade_id").collect()
    assert sorted(map(tuple, rows)) == [("ARRAY", 0, "1"), ("ARRAY", 1, "2"), ("CUT", 0, "1"), ("MARK", 0, "1"), ("MARK", 1, "2"), ("ONE", 0, "1")]


def test_broken_stretches_go_to_quarantine_and_reading_goes_on(spark, tmp_path):
    text = '{"trade_id": "1"}\n{"trade_id": broken}\n{"trade_id": "2"}\n  {"trade_id": "3"}\n[{"trade_id": "4"}, oops\n[{"trade_id": "5"}]\n{"trade_id": "6'
    put(tmp_path / "AAA" / "updatetrades" / "2024-01-02.json", text)
    good, bad = readers.split_broken(readers.read_lenient(spark, str(tmp_path), "updatetrades"))
    assert sorted((r.pos, r.trade_id) for r in good.collect()) == [(0, "1"), (1, "2"), (2, "3"), (3, "5")]
    found = bad.collect()
    assert sorted(r.broken_record for r in found) == ['[{"trade_id": "4"}, oops', '{"trade_id": "6', '{"trade_id": broken}']
    assert {r.symbol for r in found} == {"AAA"} and all(r.path.endswith("2024-01-02.json") for r in found)
    assert readers.read_lenient(spark, str(tmp_path), "updatetrades", "none").count() == 0


@pytest.fixture()
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_split_files_give_the_records_of_whole_ones(spark, tmp_path, small_splits):
    rows = [{"trade_id": str(i), "side": ["a{", "}b", 'c"{', "d\\"][i % 4], "bid_levels": [{"price": "1", "volume": str(i)}]} for i in range(40)]
    shapes = {
        "lines": "\n".join(map(json.dumps, rows)),
        "array": json.dumps(rows),
        "pretty": json.dumps(rows, indent=2),
        "flush": json.dumps(rows, indent=0),
        "printed": "\ufeff" + "".join(json.dumps(r, indent=4) + "\n" for r in rows),
        "joined": "".join(json.dumps(r, indent=1) for r in rows),
        "mixed": "[\n5,\n" + ",\n".join(json.dumps(r) for r in rows) + "\n]\n" + json.dumps(rows[0], indent=3).replace("\n", "\r\n"),
        "empty": "",
    }
    for name, text in shapes.items():
        put(tmp_path / name / "updatetrades" / "2024-01-02.json", text)
    split = readers.read_lenient(spark, str(tmp_path), "updatetrades", whole=False)
    found = {}
    for r in sorted(split.collect(), key=lambda r: (r.symbol, r.block, r.row, r.pos)):
        assert r.broken_record is None
        found.setdefault(r.symbol, []).append((r.trade_id, r.side))
    plain = [(r["trade_id"], r["side"]) for r in rows]
    assert found == {n.upper(): plain + (plain[:1] if n == "mixed" else []) for n in shapes if n != "empty"}


def test_split_files_keep_what_is_broken(spark, tmp_path, small_splits):
    good = [json.dumps({"trade_id": str(i), "side": "x" * 50}, indent=1) for i in range(9)]
    text = "\n".join([*good[:3], '{"trade_id": {', *good[3:6], '{"trade_id": oops}', *good[6:], '{"trade_id": "cut'])
    put(tmp_path / "AAA" / "updatetrades" / "2024-01-02.json", text)
    rows, bad = readers.split_broken(readers.read_lenient(spark, str(tmp_path), "updatetrades", whole=False))
    assert [r.trade_id for r in sorted(rows.collect(), key=lambda r: (r.block, r.row, r.pos))] == [str(i) for i in range(9)]
    assert sorted(r.broken_record for r in bad.collect()) == ['{"trade_id": "cut', '{"trade_id": oops}', '{"trade_id": {']


def test_symbols_with_and_without_folders_in_one_read(spark, feed):
    rows = readers.read_lines(spark, feed, "updatetrades", "aaa,zzz,bbb,ccc", broken=False)
    assert sorted(r.symbol for r in rows.collect()) == ["AAA", "AAA", "BBB"]
    plan = readers.read_lines(spark, feed, "updatetrades", "aaa,bbb")._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan


def test_universe_as_json(spark, tmp_path):
    put(tmp_path / "array.json", json.dumps([{"share_code": " aaa", "ipo_date": "2024-01-20"}, {"share_code": "BBB", "ipo_date": "soon"}, {"share_code": "", "ipo_date": "2024-01-01"}], indent=1))
    assert sorted(map(tuple, readers.read_universe(spark, str(tmp_path / "array.json")).collect())) == [("AAA", dt.date(2024, 1, 20)), ("BBB", None)]


def test_universe_and_its_months(spark, tmp_path):
    put(tmp_path / "universe.csv", "# code,date\n aaa,2024-01-20\nBBB,2024-03-05T00:00:00\nCCC,soon\n")
    universe = readers.read_universe(spark, str(tmp_path / "universe.csv"))
    assert sorted(map(tuple, universe.collect()), key=str) == [("AAA", dt.date(2024, 1, 20)), ("BBB", dt.date(2024, 3, 5)), ("CCC", None)]
    months = sorted(map(tuple, readers.fetch_months(universe, "2024-03-10").collect()))
    day = dt.date
    assert months == [
        ("AAA", day(2024, 1, 20), day(2024, 1, 31)),
        ("AAA", day(2024, 2, 1), day(2024, 2, 29)),
        ("AAA", day(2024, 3, 1), day(2024, 3, 10)),
        ("BBB", day(2024, 3, 5), day(2024, 3, 10)),
    ]


def test_history_opens_only_the_months_that_are_asked_for(spark, tmp_path):
    for symbol, days in {"AAA": ["2024-01-25", "2024-01-31", "2024-02-01", "2024-03-09", "2024-03-11"], "B C": ["2024-03-05"]}.items():
        for d in days:
            put(tmp_path / symbol / "historical_price" / d[:4] / f"{d}.json", json.dumps({"date": f"{d}T00:00:00", "priceClose": 7, "symbol": "other"}))
    put(tmp_path / "AAA/historical_price/2024/2024-02-02.json", "{broken")
    put(tmp_path / "AAA/historical_price/2024/notes.json", "{}")
    rows = [("AAA", "2024-01-30"), ("AAA", "2024-01-20"), ("B C", "2024-03-05"), ("none", "2024-03-01"), ("late", "2025-01-01"), ("x", None), (None, "2024-01-01")]
    universe = spark.createDataFrame(rows, "share_code string, ipo_date string")
    every = history.read_history(universe, f"file://{tmp_path}", "2024-03-10")
    days = lambda df: sorted((r.symbol, str(r.trading_date)) for r in df.collect())
    want = [("AAA", f"2024-{d}") for d in ("01-25", "01-31", "02-01", "02-02", "03-09")] + [("B C", "2024-03-05")]
    assert days(every) == want and every.rdd.getNumPartitions() == 5
    assert {r.priceClose for r in every.filter("broken_record is null").collect()} == {"7"}
    assert [str(r.trading_date) for r in every.filter("broken_record is not null").collect()] == ["2024-02-02"]
    some = history.read_history(universe.filter("share_code = 'AAA'"), f"file://{tmp_path}", "2024-02-01", "2024-01-28")
    assert days(some) == want[1:3] and some.rdd.getNumPartitions() == 2
    assert {(str(r.asked_first), str(r.asked_last)) for r in some.collect()} == {("2024-01-28", "2024-01-31"), ("2024-02-01", "2024-02-01")}
    assert days(every.filter("symbol = 'AAA'")) == want[:5] and days(every) == want  # a filter leaves nothing behind
    assert history.read_history(universe.filter("share_code = 'none'"), f"file://{tmp_path}", "2024-03-10").count() == 0
    assert history.read_history(universe.limit(0), f"file://{tmp_path}", "2024-03-10").count() == 0
    year = history.read_history(universe, f"file://{tmp_path}", "2024-03-10", span=12)
    assert days(year) == want and year.rdd.getNumPartitions() == 3


def test_frames_to_named_columns(spark):
    at = "2024-01-02T02:15:00+00:00"
    price = ["aaa", at, 10.5, 100, 1000, 9.5, None, 40, 0, 100]
    frames = {
        "prices": pack([1, {}, None, "UpdateLastPrices", [[price, ["BBB", *price[1:]]]]]),
        "trades": pack([1, {"k": True}, "x", "UpdateTrades", ["AAA", [[5, at, 10.12345, 200.0, " b", "2024-01-02T00:00:00"], "no record"]]]),
        "broken": b"\xc1" + pack([1, "UpdateLastPrices", [[price]]]),
        "cut": pack([1, "UpdateLastPrices", [[price]]])[:-3],
        "other": pack([6]),
        "nothing": b"",
    }
    df = spark.createDataFrame([(k, bytearray(v)) for k, v in frames.items()] + [("null", None)], "name string, frame binary")
    records = decode.open_frames(df)
    found = {(r.name, r.command, json.loads(r.record)[0]) for r in records.collect()}
    assert found == {("prices", "UpdateLastPrices", "aaa"), ("prices", "UpdateLastPrices", "BBB"), ("trades", "UpdateTrades", "AAA"), ("broken", "UpdateLastPrices", "aaa")}
    prices = decode.route(decode.decode(records, "UpdateLastPrices"), F.lit("AAA"))
    assert sorted((r.name, r.last_price, r.active_buy_volume, r.active_sell_volume) for r in prices.collect()) == [("broken", 10.5, 40.0, 60.0), ("prices", 10.5, 40.0, 60.0)]
    (trade,) = decode.decode(records, "UpdateTrades").collect()
    assert (trade.trade_id, trade.price, trade.event_time, trade.trading_date) == (5, 10.123, "2024-01-02T02:15:00Z", "2024-01-02")


def test_record_without_a_symbol_is_an_error(spark):
    nameless = spark.createDataFrame([(None, 1.0)], "symbol string, last_price double")
    with pytest.raises(Exception, match="record without a symbol"):
        decode.route(nameless, F.lit("AAA")).collect()


def days(spark, rows):
    return spark.createDataFrame(rows, "symbol string, trading_date date, frame_no int, v double")


def read(spark, path):
    return sorted((r.symbol, r.trading_date, r.frame_no, r.v) for r in spark.read.parquet(path).collect())


def test_replaced_and_removed_days(spark, tmp_path):
    path = f"file://{tmp_path}/out"
    sinks.replace_days(days(spark, [("A", DAY1, 1, 1.0), ("A", DAY2, 1, 2.0), ("B", DAY1, 1, 3.0)]), path)
    sinks.replace_days(days(spark, [("A", DAY1, 1, 9.0), ("A", DAY1, 2, 9.5)]), path)
    assert read(spark, path) == [("A", DAY1, 1, 9.0), ("A", DAY1, 2, 9.5), ("A", DAY2, 1, 2.0), ("B", DAY1, 1, 3.0)]
    sinks.remove_days(spark, path, spark.createDataFrame([("A", DAY1), ("C", DAY1)], "symbol string, trading_date date"))
    assert read(spark, path) == [("A", DAY2, 1, 2.0), ("B", DAY1, 1, 3.0)]


def test_bundles_are_in_frame_order(spark):
    out = sinks.bundles(days(spark, [("A", DAY1, i, None) for i in (3, 1, 2)])).collect()
    assert [json.loads(r.value)["frame_no"] for r in out] == [1, 2, 3]


def test_appended_stream_keeps_every_record(spark, tmp_path):
    source, out = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    rows = spark.createDataFrame([("A", 1.0), ("A", 2.0), ("B", 3.0)], "symbol string, price double")
    for part in ("price < 3", "price = 3"):
        rows.filter(part).write.mode("append").parquet(source)
        sinks.append_stream(spark.readStream.schema(rows.schema).parquet(source), out, f"file://{tmp_path}/state", None).awaitTermination()
    found = spark.read.json(out)
    assert sorted((r.symbol, r.price) for r in found.collect()) == [("A", 1.0), ("A", 2.0), ("B", 3.0)]
    assert {"ts", "year", "date"} <= set(found.columns)


def test_late_records_rebuild_their_whole_day(spark, tmp_path):
    source, out, state = (f"file://{tmp_path}/{x}" for x in ("in", "out", "state"))

    def arrive(rows):
        days(spark, rows).write.mode("append").parquet(source)
        arrivals = spark.readStream.schema(days(spark, []).schema).parquet(source)
        incremental.recompute_stream(arrivals, lambda: spark.read.parquet(source), build, lambda df: sinks.replace_days(df, out), state, None).awaitTermination()

    def build(records):
        return records.groupBy("symbol", "trading_date").agg(F.count(F.lit(1)).cast("int").alias("frame_no"), F.sum("v").alias("v"))

    arrive([("A", DAY1, 1, 1.0), ("A", DAY2, 1, 5.0)])
    assert read(spark, out) == [("A", DAY1, 1, 1.0), ("A", DAY2, 1, 5.0)]
    arrive([("A", DAY1, 2, 2.0)])
    assert read(spark, out) == [("A", DAY1, 2, 3.0), ("A", DAY2, 1, 5.0)]


def test_dirty_and_removed_days(spark):
    def scan(rows):
        return spark.createDataFrame(rows, "path string, symbol string, trading_date date, size long, mtime long")

    before = scan([("f1", "A", DAY1, 10, 1), ("f2", "A", DAY2, 10, 1), ("f3", "B", DAY1, 10, 1)])
    now = scan([("f1", "A", DAY1, 10, 1), ("f2", "A", DAY2, 11, 2)])
    assert sorted(map(tuple, incremental.dirty_days(before, now).collect())) == [("A", DAY2), ("B", DAY1)]
    assert [tuple(r) for r in incremental.removed_days(before, now).collect()] == [("B", DAY1)]
    assert incremental.dirty_days(None, now).count() == 2


def test_broken_lines_are_kept_and_folders_pruned(spark, feed):
    good, broken = readers.split_broken(readers.read_lines(spark, feed, "updatetrades", broken=True))
    assert sorted(r.trade_id for r in good.collect()) == ["7", "8", "9"]
    assert [(r.symbol, r.broken_record) for r in broken.collect()] == [("AAA", "{broken")]
    assert readers.read_lines(spark, feed, "updatetrades", "none").count() == 0
    assert {f.rsplit("/", 3)[1] for f in readers.read_lines(spark, feed, "updatetrades", "bbb").inputFiles()} == {"updatetrades"}


def test_strict_objects(spark, tmp_path):
    put(tmp_path / "a.json", '﻿ {"x": 1,\n "y": {"z": 2}}\n')
    assert [r.x for r in readers.read_objects(spark, [f"{tmp_path}/a.json"], "x long").collect()] == [1]
    put(tmp_path / "b.json", "[1]")
    with pytest.raises(Exception, match="expected a JSON object"):
        readers.read_objects(spark, [f"{tmp_path}/b.json"], "x long").collect()


def test_first_of_a_trade_id_stays_and_trades_without_one(spark):
    from tickloom.operators import normalize

    rows = [("A", f"2024-01-02T03:00:0{s}Z", i, str(p)) for s, i, p in ((2, "1", 9), (1, "1", 8), (3, None, 7), (4, None, 6), (5, "2", 5))]
    raw = spark.createDataFrame(rows, "symbol string, event_time string, trade_id string, price string").repartition(3)
    assert sorted(r.price for r in normalize.normalize_trades(raw, distinct_ids=True).collect()) == [5.0, 6.0, 7.0, 8.0]


def test_a_failing_day_leaves_the_others(spark, tmp_path):
    out = f"file://{tmp_path}/out"
    rows = days(spark, [(s, d, i, float(i)) for s in "ABC" for d in (DAY1, DAY2) for i in range(3)])
    bad = (F.col("symbol") == "B") & (F.col("trading_date") == DAY2)
    build = lambda df: df.withColumn("v", F.when(bad, F.raise_error(F.lit("bad day"))).otherwise(F.col("v")))
    gone = []
    run = incremental.run_once(rows, rows.filter("symbol <> 'C'"), build, lambda df: sinks.replace_days(df, out), lambda d: gone.append(d.count()))
    assert run.counts() == {"dirty": 6, "built": 3, "removed": 2, "failed": 1} and gone == [2]
    assert [e[:2] for e in run.errors] == [("B", str(DAY2))] and {(r[0], r[1]) for r in read(spark, out)} == {("A", DAY1), ("A", DAY2), ("B", DAY1)}


def test_errors_as_data_need_one_build(spark, tmp_path):
    out = f"file://{tmp_path}/out"
    rows = days(spark, [(s, d, i, float(i)) for s in "ABCDEFGH" for d in (DAY1, DAY2) for i in range(3)])
    builds = []

    def build(df, bad):
        builds.append(1)
        return df.withColumn("error", F.when(bad, F.concat(F.lit("bad "), F.col("v"))))

    some = F.col("symbol").isin("B", "D", "F") & (F.col("trading_date") == DAY2) & (F.col("v") > 0)
    run = incremental.run_once(rows, rows, lambda df: build(df, some), lambda df: sinks.replace_days(df, out))
    assert run.counts() == {"dirty": 16, "built": 13, "removed": 0, "failed": 3} and run.rows == 48 and len(builds) == 1
    assert sorted(run.errors) == [(s, str(DAY2), "bad 1.0") for s in "BDF"]
    back = spark.read.parquet(out)
    assert "error" not in back.columns and back.count() == 39
    run = incremental.run_once(rows, rows, lambda df: build(df, F.lit(True)), lambda df: sinks.replace_days(df, out))
    assert run.failed == 16 and run.built == 0 and spark.read.parquet(out).count() == 39


def test_what_the_cluster_or_the_plan_raises_goes_through(spark):
    rows = days(spark, [(s, DAY1, 0, 1.0) for s in "ABCD"])
    tries = []

    def full(_):
        tries.append(1)
        raise OSError("no space left on device")

    with pytest.raises(OSError, match="no space"):
        incremental.run_once(rows, rows, lambda df: df, full)
    with pytest.raises(Exception, match="no_such_column"):
        incremental.run_once(rows, rows, lambda df: df.select("no_such_column"), lambda df: tries.append(1))
    assert tries == [1]


def test_layer_2_reads_each_group_of_the_feed_once(spark, feed, monkeypatch):
    from tickloom.plans import layer2

    read, seen = readers.read_lines, []
    monkeypatch.setattr(readers, "read_lines", lambda *a, **b: seen.append(a[2]) or read(*a, **b))
    found = layer2.run(spark, feed)
    assert sorted(seen) == sorted(layer2.GROUPS.values())
    for df in (found.levels, found.validation, found.daily, found.broken, found.failed):
        assert "Scan text" not in df._jdf.queryExecution().executedPlan().toString()
    assert [r.broken_record for r in found.broken.collect()] == ["{broken"]


def test_buckets_spare_the_exchange(spark):
    from pyspark.sql import functions as F
    from pyspark.sql.window import Window

    from tickloom.staging import bucketed

    rows = spark.range(100).select(F.concat(F.lit("S"), (F.col("id") % 7).cast("string")).alias("symbol"), F.to_date(F.lit("2024-01-02")).alias("trading_date"), "id")
    df = bucketed(rows, "rows", ("id",)).withColumn("n", F.row_number().over(Window.partitionBy("symbol", "trading_date").orderBy("id")))
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString() and df.filter("n = 1").count() == 7


def test_many_failing_days_are_found_without_writing(spark, tmp_path):
    out = f"file://{tmp_path}/out"
    rows = days(spark, [(s, d, i, float(i)) for s in "ABCDEFGHIJKLMNOPQR" for d in (DAY1, DAY2) for i in range(3)])
    raised = lambda c, bad: F.when(bad, F.raise_error(F.concat(F.lit("bad "), F.col("symbol")))).otherwise(c)
    good, writes = (F.col("symbol") == "B") & (F.col("trading_date") == DAY2), []

    def write(df):
        writes.append(1)
        sinks.replace_days(df, out)

    run = incremental.run_once(rows, rows, lambda df: df.withColumn("v", raised(F.col("v"), ~good)), write)
    assert run.counts() == {"dirty": 36, "built": 1, "removed": 0, "failed": 35} and len(writes) == 2
    assert sorted((e[0], e[1]) for e in run.errors) == sorted((s, str(d)) for s in "ABCDEFGHIJKLMNOPQR" for d in (DAY1, DAY2) if (s, d) != ("B", DAY2))
    assert all(f"bad {e[0]}" in e[2] for e in run.errors) and {(r[0], r[1]) for r in read(spark, out)} == {("B", DAY2)}
    # a few of many days, records that raise themselves, and what only writing raises
    few = F.col("symbol").isin("C", "Q") & (F.col("trading_date") == DAY1)
    cases = [(rows, lambda df: df.withColumn("v", raised(F.col("v"), few)), write), (rows.withColumn("v", raised(F.col("v"), few)), lambda df: df, write)]
    for records, build, put in [*cases, (rows, lambda df: df, lambda df: write(df.withColumn("v", raised(F.col("v"), few))))]:
        run = incremental.run_once(rows, records, build, put)
        assert run.counts() == {"dirty": 36, "built": 34, "removed": 0, "failed": 2} and sorted(e[:2] for e in run.errors) == [(s, str(DAY1)) for s in "CQ"]


def test_days_without_a_symbol_are_tried_too(spark, tmp_path):
    rows = days(spark, [(s, DAY1, i, float(i)) for s in ("", "A", "B=%/") for i in range(3)])
    seen = []
    build = lambda df: df.withColumn("v", F.when(F.col("symbol") != "A", F.raise_error(F.lit("bad"))).otherwise(F.col("v")))
    run = incremental.run_once(rows, rows, build, lambda df: seen.append([r.symbol for r in df.collect()]))
    assert sorted(e[0] for e in run.errors) == ["", "B=%/"] and run.built == 1 and seen == [["A"] * 3]
