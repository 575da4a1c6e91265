"""The pipeline's tables made from the test tables, so that every operator runs on them.

``events`` become a market: the symbol is the user modulo 10, views are last-price snapshots, clicks order books with
synthetic levels, purchases, errors and signups are trades (bought, sold, no side).  Events lie minutes apart, so
windows are hours here; the operators' defaults are those of real ticks.  ``orders`` become daily bars.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..params import HOUR, KEYS, Memory, Windows

WINDOWS = Windows(
    trailing={"2h": 2 * HOUR, "6h": 6 * HOUR, "24h": 24 * HOUR},
    lags={"2h": 2 * HOUR, "6h": 6 * HOUR},
    volatility={"2h": 2 * HOUR, "6h": 6 * HOUR, "24h": 24 * HOUR},
)
MEMORY = Memory(expiry_ms=5 * 3_600_000, carry_ms=1_800_000, wall_stale_ms=3_600_000, wall_score=0.5, wall_volume=5_000.0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _micros(t: str) -> Column:
    """Microseconds of a timestamp without zone, whatever the session's zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(t).cast("timestamp_ntz"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    rows = e.select(
        F.concat(F.lit("S"), (F.col("user_id") % 10).cast("string")).alias("symbol"),
        _micros("ts").alias("event_us"),
        F.col("event_id").alias("seq"),
        "event_type",
        "value",
        F.regexp_extract("props", r"(\d+)", 1).try_cast("bigint").alias("k"),
    )
    local = F.col("event_us") + 7 * HOUR
    date = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(local / F.lit(X.DAY)).cast("int"))
    return rows.select("*", F.col("event_us").alias("ingested_us"), local.alias("local_us"), date.alias("trading_date"))


def _of(df: DataFrame, *kinds: str) -> DataFrame:
    return df.filter(F.col("event_type").isin(*kinds))


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, v = F.col("k"), F.col("value")
    return _of(events(spark, sf_dir), "view").select(
        *KEYS,
        "event_us",
        "ingested_us",
        "seq",
        "local_us",
        F.when(k % 11 != 0, v).alias("last_price"),
        F.when(k % 5 != 0, k * 1000.0).alias("deal_volume"),
        F.when(k % 7 != 0, v * k * 1000.0).alias("deal_value"),
        (k * 400.0).alias("active_buy_volume"),
        F.when(k % 3 != 1, k * 600.0 + k % 4).alias("active_sell_volume"),
    )


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    base = F.floor(F.col("value") / 100) * 10.0 + 10.0
    places = F.filter(F.sequence(F.lit(1), F.lit(3)), lambda i: (k % 13 != 0) | (i < 3))
    side = lambda sign: F.transform(places, lambda i: F.struct(i.alias("level_no"), (base + sign * 0.1 * i).alias("price"), ((k + i) * 100.0).alias("volume")))
    return _of(events(spark, sf_dir), "click").select(
        *KEYS,
        "event_us",
        "ingested_us",
        "seq",
        side(-1).alias("bid_levels"),
        side(1).alias("ask_levels"),
        F.when(k % 2 == 0, k * 0.0).otherwise(k * 1.0).alias("reported_total_bid_volume"),
        F.lit(0.0).alias("reported_total_ask_volume"),
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    base = F.floor(F.col("value") / 100) * 10.0 + 10.0
    return _of(events(spark, sf_dir), "purchase", "error", "signup").select(
        *KEYS,
        "event_us",
        "ingested_us",
        "seq",
        F.when(k % 17 != 0, F.col("seq")).alias("trade_id"),
        X.price_token(base + (k % 7 - 3) * 0.1).alias("price"),
        (k * 10.0).alias("volume"),
        F.when(F.col("event_type") == "purchase", "B").when(F.col("event_type") == "error", "S").alias("side"),
    )


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bar for each symbol and day of the events."""
    g = events(spark, sf_dir).groupBy(*KEYS).agg(
        F.min_by("value", "seq").alias("price_open"),
        F.max("value").alias("price_high"),
        F.min("value").alias("price_low"),
        F.max_by("value", "seq").alias("price_close"),
        F.sum("k").cast("double").alias("q"),
        F.count(F.lit(1)).alias("n"),
        F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("cents"),
    )
    average = F.col("cents") / 100.0 / F.col("n")
    put = F.col("cents") / 100.0
    return g.select(
        *KEYS,
        "price_open",
        "price_high",
        "price_low",
        "price_close",
        (average + F.when(F.col("n") % 4 == 0, 0.05).otherwise(0.001)).alias("price_average"),
        (F.col("q") * 100).alias("total_volume"),
        (F.col("q") * 90).alias("deal_volume"),
        (F.col("q") * 10 + F.col("n") % 3).alias("putthrough_volume"),
        (put + average * F.col("q") * 90 * 1000).alias("total_value"),
        put.alias("putthrough_value"),
        (F.col("q") * 3).alias("buy_foreign_quantity"),
        F.when(F.col("n") % 6 != 0, F.col("q") * 2).alias("sell_foreign_quantity"),
        F.col("q").alias("prop_net_deal_value"),
        F.col("n").cast("double").alias("prop_net_pt_value"),
        (F.col("q") + F.col("n") + F.col("n") % 5).alias("prop_net_value"),
        F.lit(1000.0).alias("unit"),
    )


def event_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = daily(spark, sf_dir)
    return d.select("symbol", F.col("trading_date").alias("date"), F.col("price_open").alias("open"), F.col("price_high").alias("high"), F.col("price_low").alias("low"), F.col("price_close").alias("close"), F.col("total_volume").alias("volume"))


def order_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars by order priority and day; some highs, closes and volumes are missing."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("symbol"), F.col("o_orderdate").cast("date").alias("date"), "o_orderkey", "o_totalprice")
    day = F.dayofmonth("date")
    g = o.groupBy("symbol", "date").agg(
        F.min_by("o_totalprice", "o_orderkey").alias("open"),
        F.max("o_totalprice").alias("high"),
        F.min("o_totalprice").alias("low"),
        F.max_by("o_totalprice", "o_orderkey").alias("close"),
        (F.count(F.lit(1)) * 100.0).alias("volume"),
    )
    return g.select("symbol", "date", "open", F.when(day != 17, F.col("high")).alias("high"), "low", F.when(day != 19, F.col("close")).alias("close"), F.when(day != 23, F.col("volume")).alias("volume"))


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded, days as text: what queries return."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(name)
        out.append((F.round(c, places) + 0.0).alias(name) if kind in ("double", "float") else c.cast("string").alias(name) if kind == "date" else c.cast("long").alias(name) if kind == "int" else c)
    return df.select(*out)


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
