"""Daily technicals on every bar, previous bars, history and the merge of daily sources.

Indicators are windows over the bars of a symbol that have a close, ordered by date.  Exponential averages are seeded
with the mean of the first n closes of all history: x(t) = a·c(t) + (1-a)·x(t-1).  The fold runs JVM-side over the
symbol's ordered closes in blocks of ``BLOCK`` bars and yields the value after every bar; only the last value goes from
block to block, so that no array is copied at every bar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import exprs as X

SMA = (5, 10, 20, 50, 100, 200)
EMA = (12, 20, 26)
BLOCK = 64


def dedup_history(records: DataFrame, position: list[str]) -> DataFrame:
    """One bar for each symbol and date: the last record in file order wins."""
    w = Window.partitionBy("symbol", "date").orderBy(*[F.col(c).desc() for c in position])
    return records.filter("date is not null").withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def rolling_mean(value: Column, n: int, order: Window) -> Column:
    """Mean of the last n values, null with fewer."""
    w = order.rowsBetween(-(n - 1), 0)
    return F.when(F.count(value).over(w) == n, F.avg(value).over(w))


def ema_steps(values: Column, n: int) -> Column:
    """An array with the exponential average after each element of an array of doubles; null before n."""
    a = 2.0 / (n + 1)
    seed = F.aggregate(F.slice(values, 1, n), F.lit(0.0), lambda s, x: s + x) / F.lit(float(n))
    doubles = "array<double>"

    def step(state: Column, x: Column) -> Column:
        new = F.lit(a) * x + F.lit(1 - a) * state["now"]
        return F.struct(new.alias("now"), F.concat(state["out"], F.array(new)).alias("out"))

    def block(state: Column, part: Column) -> Column:
        inner = F.aggregate(part, F.struct(state["now"].alias("now"), F.array().cast(doubles).alias("out")), step)
        joined = lambda r: F.struct(r["now"].alias("now"), F.concat(state["all"], F.array(r["out"])).alias("all"))
        return F.transform(F.array(inner), joined)[0]

    rest = F.greatest(F.size(values) - n, F.lit(0))
    starts = F.when(rest > 0, F.sequence(F.lit(0), F.floor((rest - 1) / BLOCK).cast("int"))).otherwise(F.array().cast("array<int>"))
    blocks = F.transform(starts, lambda i: F.slice(values, F.lit(n + 1) + i * BLOCK, F.lit(BLOCK)))
    start = F.struct(seed.alias("now"), F.array(F.array(seed)).alias("all"))
    later = F.aggregate(blocks, start, block, lambda s: F.flatten(s["all"]))
    none = F.array_repeat(F.lit(None).cast("double"), F.least(F.size(values), F.lit(n - 1)))
    return F.when(F.size(values) >= n, F.concat(none, later)).otherwise(none)


def _ema_columns(bars: DataFrame) -> DataFrame:
    """(symbol, date) with ema_n, macd_line_d and macd_signal_d for each bar with a close."""
    closes = bars.groupBy("symbol").agg(F.array_sort(F.collect_list(F.struct("date", "close"))).alias("bars"))
    values = F.transform("bars", lambda b: b["close"])
    emas = closes.select("symbol", "bars", *[ema_steps(values, n).alias(f"ema_{n}") for n in EMA])
    line = F.zip_with("ema_12", "ema_26", lambda a, b: a - b)
    emas = emas.withColumn("line", line).withColumn("known", F.filter("line", lambda x: x.isNotNull()))
    signal = F.concat(F.array_repeat(F.lit(None).cast("double"), F.size("line") - F.size("known")), ema_steps(F.col("known"), 9))
    zipped = F.arrays_zip(F.col("bars"), *[F.col(f"ema_{n}") for n in EMA], F.col("line"), F.col("signal"))
    rows = emas.withColumn("signal", signal).select("symbol", F.explode(zipped).alias("x"))
    return rows.select(
        "symbol", F.col("x.bars.date").alias("date"), *[F.col(f"x.ema_{n}").alias(f"ema_{n}") for n in EMA], F.col("x.line").alias("macd_line_d"), F.col("x.signal").alias("macd_signal_d")
    )


def true_ranges(bars: DataFrame) -> DataFrame:
    """Adds tr: null unless high, low and close are known; without a previous close it is high - low."""
    order = Window.partitionBy("symbol").orderBy("date")
    before = F.lag("close").over(order)
    span = F.col("high") - F.col("low")
    tr = F.when(before.isNull(), span).otherwise(F.greatest(span, F.abs(F.col("high") - before), F.abs(F.col("low") - before)))
    valid = F.col("high").isNotNull() & F.col("low").isNotNull() & F.col("close").isNotNull()
    return bars.withColumn("tr", F.when(valid, tr)).withColumn("bar_no", F.row_number().over(order))


def moving(bars: DataFrame) -> DataFrame:
    """Windowed indicators of every bar with a close."""
    order = Window.partitionBy("symbol").orderBy("date")
    last = lambda n: order.rowsBetween(-(n - 1), 0)
    close = F.col("close")
    seen = F.count(close).over(order.rowsBetween(Window.unboundedPreceding, 0))
    df = bars.filter("close is not null").withColumn("__change", close - F.lag("close").over(order))
    df = df.withColumn("__return", X.simple_return(close, F.lag("close").over(order))).withColumn("__seen", seen)
    df = df.select("*", *[rolling_mean(close, n, order).alias(f"ma_{n}") for n in SMA])
    gain = F.avg(F.greatest("__change", F.lit(0.0))).over(last(14))
    loss = F.avg(F.greatest(-F.col("__change"), F.lit(0.0))).over(last(14))
    rsi = F.when(loss == 0, 100.0).otherwise(100 - 100 / (1 + X.safe_div(gain, loss)))
    sigma = F.stddev_samp(close).over(last(20))
    before = F.lag("ma_20", 5).over(order)
    return df.select(
        "symbol",
        "date",
        *[f"ma_{n}" for n in SMA],
        F.when(F.col("__seen") >= 15, rsi).alias("rsi_14_d"),
        F.col("ma_20").alias("bollinger_mid_20"),
        (F.col("ma_20") + 2 * sigma).alias("bollinger_upper_20"),
        (F.col("ma_20") - 2 * sigma).alias("bollinger_lower_20"),
        F.when(F.col("__seen") >= 21, F.stddev_samp("__return").over(last(20))).alias("volatility_20d"),
        X.safe_div(F.col("ma_20") - before, before).alias("ma20_slope_5d"),
        X.safe_div(F.col("ma_20"), F.col("ma_200")).alias("ma20_ma200_ratio"),
    )


def volume_means(bars: DataFrame) -> DataFrame:
    order = Window.partitionBy("symbol").orderBy("date")
    return bars.filter("volume is not null").select("symbol", "date", rolling_mean(F.col("volume"), 20, order).alias("avg_volume_20d"))


def average_true_range(bars: DataFrame) -> DataFrame:
    """Mean of the last 14 true ranges of bars that have one; needs 15 bars of any kind."""
    order = Window.partitionBy("symbol").orderBy("date")
    valid = true_ranges(bars).filter("tr is not null")
    return valid.select("symbol", "date", F.when(F.col("bar_no") >= 15, rolling_mean(F.col("tr"), 14, order)).alias("atr_14"))


def daily_technicals(bars: DataFrame) -> DataFrame:
    """All indicators as of each bar, carried forward from the last bar that has what they need."""
    order = Window.partitionBy("symbol").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    closes = bars.filter("close is not null")
    out = bars.select("symbol", "date", F.col("close").alias("bar_close")).withColumn("available_days", F.count(F.lit(1)).over(order))
    parts = [moving(bars), _ema_columns(closes.select("symbol", "date", "close")), volume_means(bars), average_true_range(bars)]
    for part in parts:
        names = [c for c in part.columns if c not in ("symbol", "date")]
        packed = part.select("symbol", "date", F.struct(*names).alias("__x"))
        out = out.join(packed, ["symbol", "date"], "left").withColumn("__x", F.last("__x", ignorenulls=True).over(order))
        out = out.select("*", *[F.col("__x")[c].alias(c) for c in names]).drop("__x")
    return out.withColumn("macd_hist_d", F.col("macd_line_d") - F.col("macd_signal_d"))


def as_of_days(days: DataFrame, bars: DataFrame, include_current_bar: bool = False) -> DataFrame:
    """For each (symbol, trading_date) the technicals of its last usable bar and the previous bar's close.

    With ``include_current_bar`` the day's own bar counts, otherwise only earlier ones do (no look-ahead).
    """
    technicals = daily_technicals(bars)
    names = [c for c in technicals.columns if c not in ("symbol", "date", "bar_close")]
    line = (
        technicals.select("symbol", F.col("date").alias("d"), F.lit(0 if include_current_bar else 2).alias("k"), F.struct(*names).alias("t"), F.struct("bar_close").alias("b"))
        .unionByName(days.select("symbol", F.col("trading_date").alias("d"), F.lit(1).alias("k")).distinct(), allowMissingColumns=True)
    )
    to_date = Window.partitionBy("symbol").orderBy("d", "k").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("symbol").orderBy(F.unix_date("d")).rangeBetween(Window.unboundedPreceding, -1)
    found = line.select("symbol", "d", "k", F.last("t", ignorenulls=True).over(to_date).alias("t"), F.last("b", ignorenulls=True).over(earlier).alias("b")).filter("k = 1")
    return found.select("symbol", F.col("d").alias("trading_date"), *[F.col("t")[c].alias(c) for c in names], F.col("b.bar_close").alias("previous_close"))


def latest_of_day(records: DataFrame, date: Column, values: list[str], prefix: str) -> DataFrame:
    """Per symbol and date the record that is last by event time, then ingest time (nulls first), then file."""
    order = F.struct("event_time", "ts", "position")
    rows = records.withColumn("date", date).filter("date is not null")
    picked = rows.groupBy("symbol", "date").agg(F.max_by(F.struct(*values), order).alias("x"))
    return picked.select("symbol", "date", *[F.col("x")[v].alias(f"{prefix}_{v}") for v in values])


def daily_merge(parts: list[DataFrame]) -> DataFrame:
    """Full outer merge of daily sources on (symbol, date)."""
    out = parts[0]
    for part in parts[1:]:
        out = out.join(part, ["symbol", "date"], "full_outer")
    return out
