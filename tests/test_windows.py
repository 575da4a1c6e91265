"""Trailing windows: their plan, odd values, and a day of a million rows."""

import math
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tickloom.operators import align
from tickloom.params import SECOND, Windows
from tickloom.plans import queries as Q

FOLDER = "/root/testdata/sf0.001"
TICKS = "symbol string, trading_date date, event_us long, ingested_us long, seq long"


@pytest.mark.parametrize("name", ["jn03_ag08_trailing_windows", "wn10_wn11_realized_volatility", "flagship_book_and_flow", "l3p2_base_features"])
def test_no_frame_slides(spark, name):
    """Every range begins at the day's first row; frames that begin at a distance are summed anew at each row."""
    plan = Q.QUERIES[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"RangeFrame, (?!unboundedpreceding)", plan)


def day(spark, trades, frames):
    """One symbol's day from (time, volume, side) trades and (time, price) frames."""
    head = lambda i, t: ("AAA", None, t, t, i)
    cast = lambda df: df.withColumn("trading_date", F.to_date(F.lit("2024-01-02")))
    t = spark.createDataFrame([(*head(i, t), 1.0, v, s) for i, (t, v, s) in enumerate(trades)], TICKS + ", price double, volume double, side string")
    s = spark.createDataFrame([(*head(i, t), p) for i, (t, p) in enumerate(frames)], TICKS + ", last_price double")
    books = spark.createDataFrame([], TICKS + ", bid_levels array<struct<price:double,volume:double>>, ask_levels array<struct<price:double,volume:double>>")
    return cast(s), books, cast(t)


def plain_sums(trades, t, w):
    inside = [(v, s) for u, v, s in trades if t - w < u <= t]
    known = [(v, s) for v, s in inside if v is not None]
    sign = {"B": 1, "S": -1}
    total = sum(v for v, _ in known) if known else None
    signed = sum(v * sign.get(s, 0) for v, s in known) if known else None
    if any(not math.isfinite(v) for v, _ in known):
        total = signed = "nan"
    return len(inside), total, signed, sum(s is None for _, s in inside)


def shown(x):
    return "nan" if isinstance(x, float) and math.isnan(x) else x


def test_windows_equal_plain_sums_with_odd_volumes(spark):
    rng = random.Random(3)
    odd = [None, float("nan"), float("inf"), 0.0, -5.0]
    trades = [(rng.randrange(0, 400) * SECOND // 2, rng.choice([100.0, 250.0, 7.0, rng.choice(odd)]), rng.choice(["B", "S", None])) for _ in range(300)]
    frames = [(rng.randrange(0, 420) * SECOND // 2, 1.0) for _ in range(120)]
    sizes = {"1s": SECOND, "7s": 7 * SECOND, "5m": 300 * SECOND}
    rows = align.align(*day(spark, trades, frames), Windows(trailing=sizes)).collect()
    assert len(rows) == 120
    for r in rows:
        for n, w in sizes.items():
            got = (r[f"trade_count_{n}"], shown(r[f"volume_sum_{n}"]), shown(r[f"signed_volume_{n}"]), r[f"null_side_count_{n}"])
            assert got == plain_sums(trades, r.event_us, w)


def test_volatility_equals_plain_sums(spark):
    rng = random.Random(4)
    times = sorted(rng.choice([rng.randrange(0, 200), 50, 51]) * SECOND for _ in range(150))
    frames = [(t, rng.choice([10.0, 10.5, 11.0, None, 0.0])) for t in times]
    sizes = {"10s": 10 * SECOND, "60s": 60 * SECOND}
    s, _, _ = day(spark, [(0, 1.0, "B")], frames)
    framed = s.withColumn("frame_no", F.col("seq") + 1)
    for r in align.realized_volatility(framed, "last_price", Windows(volatility=sizes)).collect():
        for n, w in sizes.items():
            inside = [i for i, (t, _) in enumerate(frames) if r.event_us - w < t <= r.event_us and i <= r.frame_no - 1]
            pairs = [(frames[i - 1][1], frames[i][1]) for i in inside[1:]]
            returns = [b / a - 1 for a, b in pairs if a and b is not None]
            want = math.sqrt(sum(x * x for x in returns)) if returns else None
            got = r[f"rv_{n}"]
            assert (got is None) == (want is None) and (got is None or abs(got - want) < 1e-9)


def test_a_day_of_a_million_rows(spark):
    """Rows times window would be some 1e10 sums here."""
    n = 900_000
    ticks = spark.range(n).select(
        F.lit("AAA").alias("symbol"), F.to_date(F.lit("2024-01-02")).alias("trading_date"), (F.col("id") * 20_000).alias("event_us"),
        (F.col("id") * 20_000).alias("ingested_us"), F.col("id").alias("seq"), F.lit(10.0).alias("price"), F.lit(100.0).alias("volume"), F.lit("B").alias("side"),
    )
    _, books, _ = day(spark, [(0, 1.0, "B")], [(0, 1.0)])
    snaps = ticks.filter(F.col("seq") % 9 == 0).select("symbol", "trading_date", "event_us", "ingested_us", "seq", F.col("price").alias("last_price"))
    begin = time.time()
    found = align.align(snaps, books, ticks).agg(F.max("volume_sum_5m"), F.max("trade_count_1s"), F.count("*")).first()
    assert tuple(found) == (15_000 * 100.0, 50, n // 9) and time.time() - begin < 60
