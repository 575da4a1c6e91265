"""The live deep book over several batches and a restart: equal to the batch form, and writing only what it touched."""

import datetime

import pytest
from pyspark.sql import functions as F

from tickloom.operators import align, deep_book
from tickloom.params import Memory
from tickloom.plans import bindings as B
from tickloom.streaming import memory_book

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["symbol", "trading_date", *memory_book.COLUMNS]


@pytest.fixture()
def rocksdb(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    memory_book.use_rocksdb(spark)
    yield
    spark.conf.set(key, before)


def run(spark, source, schema, out, state, memory, **more):
    stream = memory_book.memory_book(spark.readStream.schema(schema).parquet(source), memory, **more)
    query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()
    found = [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]
    return max(x["customMetrics"]["rocksdbPutCount"] for x in found), found[-1]["numRowsTotal"]


def result(df):
    return sorted(repr(tuple(round(x, 9) if isinstance(x, float) else x for x in r)) for r in df.select(*COLUMNS).collect())


def test_batches_and_restarts_equal_the_batch_form(spark, rocksdb, tmp_path):
    """Every batch is a query of its own, which begins from the state that the last one left."""
    s, b, t = (f(spark, FOLDER) for f in (B.snapshots, B.books, B.trades))
    line = align.timeline(s, b, t)
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    times = line.select(F.percentile_approx("event_us", [0.3, 0.6, 1.0], 10_000)).first()[0]
    low = -1
    for high in times:
        line.filter((F.col("event_us") > low) & (F.col("event_us") <= high)).coalesce(1).write.mode("append").parquet(source)
        run(spark, source, line.schema, out, state, B.MEMORY, idle_ms=10**12)
        low = high
    frames = align.align(s, b, t, B.WINDOWS)
    want = deep_book.deep_book(frames, align.assign_forward(s, t), B.MEMORY)
    assert result(spark.read.parquet(out)) == result(want)


MINUTE = 60_000_000
TICK = "symbol string, trading_date date, event_us long, ingested_us long, seq long, kind int"
LEVELS = "array<struct<price:double,volume:double>>"
LINE = f"{TICK}, book struct<bid_levels:{LEVELS},ask_levels:{LEVELS}>, trade struct<price:double,volume:double,side:string>, snap struct<last_price:double>"


def rows(spark, path, events, symbol="AAA"):
    day = datetime.date(2024, 1, 2)
    at = lambda i, us, kind: (symbol, day, us, us, i, kind)
    data = []
    for i, (us, kind, value) in enumerate(events):
        data.append((*at(i, us, kind), (value, []) if kind == align.BOOK else None, value if kind == align.TRADE else None, (1.0,) if kind == align.FRAME else None))
    spark.createDataFrame(data, LINE).coalesce(1).write.mode("append").parquet(path)


def test_a_batch_writes_only_the_levels_it_touched_and_a_timer_ends_the_day(spark, rocksdb, tmp_path):
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    spark.createDataFrame([], LINE).write.parquet(source)
    schema = spark.createDataFrame([], LINE).schema
    memory = Memory(expiry_ms=10**9)
    deep = [(10.0 + i / 10, 100.0) for i in range(200)]

    def batch(minute, *events, symbol="AAA"):
        """Puts into the state, and rows of it afterwards."""
        rows(spark, source, [(minute * MINUTE + i, *e) for i, e in enumerate(events)], symbol)
        return run(spark, source, schema, out, state, memory, idle_ms=3_600_000, late="0 seconds")

    frame = (align.FRAME, None)
    first = batch(60, (align.BOOK, deep), frame)
    # a trade alone touches no level
    second = batch(61, (align.TRADE, (10.0, 30.0, "S")))
    # 198 levels are missed for the first time, and then stay as they are but for one with trades
    third = batch(62, (align.BOOK, deep[:2]), frame)
    fourth = batch(63, (align.TRADE, (12.0, 30.0, "S")), frame)
    puts = [x[0] for x in (first, second, third, fourth)]
    assert puts[0] >= 200 and puts[1] < 20 and puts[2] >= 200 and puts[3] < 20, puts
    found = spark.read.parquet(out)
    assert found.filter("frame_no = 3").count() == 200 and found.filter("frame_no = 3 and executed_volume_at_price = 30").count() == 1
    # another symbol's rows hours later move the watermark: the day's state goes
    late = [batch(m, (align.TRADE, (10.0, 1.0, "S")), symbol="BBB") for m in (240, 480)]
    assert late[-1][1] < 20
