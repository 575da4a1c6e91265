"""Frames: every intraday snapshot with what was known at its time.

Snapshots, books and trades are united, partitioned by symbol and day once, and read by two window orders of that one
partitioning: rows in full tie-break order for as-of values and running sums, ranges of microseconds for trailing
windows.  At equal times books come before trades and trades before frames, so that as-of is inclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import exprs as X
from ..params import KEYS, Windows

BOOK, TRADE, FRAME = 0, 1, 2
ORDER = ("event_us", "kind", "ingested_us", "seq")


def _payload(df: DataFrame) -> Column:
    return F.struct(*[c for c in df.columns if c not in (*KEYS, "ingested_us", "seq")])


def timeline(snapshots: DataFrame, books: DataFrame, trades: DataFrame) -> DataFrame:
    """All three as one table: keys, order columns, kind, and one struct for each kind."""
    parts = {"book": (BOOK, books), "trade": (TRADE, trades), "snap": (FRAME, snapshots)}
    types = {name: df.select(_payload(df).alias("x")).schema["x"].dataType for name, (_, df) in parts.items()}
    out = None
    for name, (kind, df) in parts.items():
        part = df.select(
            *KEYS,
            "event_us",
            "ingested_us",
            "seq",
            F.lit(kind).alias("kind"),
            *[(_payload(df) if n == name else F.lit(None).cast(t)).alias(n) for n, t in types.items()],
        )
        out = part if out is None else out.unionByName(part)
    return out


def trailing_sums(is_trade: Column, volume: Column, side: Column, sizes: dict[str, int]) -> dict[str, Column]:
    """Counts and sums of the trades in (t - w, t] for each window w.

    A sum is null where no trade there has a volume, and NaN where one there has a volume that is not finite.
    """
    by_time = Window.partitionBy(*KEYS).orderBy("event_us")
    finite = F.when(F.abs(volume) < float("inf"), volume)
    counted = {"trades": is_trade, "known": volume.isNotNull(), "odd": volume.isNotNull() & finite.isNull(), "sideless": is_trade & side.isNull()}
    added = {"volume": finite, "signed": X.signed_volume(side, finite)}

    def until(upper: int) -> dict[str, Column]:
        w = by_time.rangeBetween(Window.unboundedPreceding, upper)
        return {k: F.count(F.when(c, 1)).over(w) for k, c in counted.items()} | {k: F.coalesce(F.sum(c).over(w), F.lit(0.0)) for k, c in added.items()}

    now, out = until(0), {}
    for name, size in sizes.items():
        then = until(-size)
        within = {k: now[k] - then[k] for k in now}
        total = lambda k: F.when(within["odd"] > 0, F.lit(float("nan"))).when(within["known"] > 0, within[k])  # noqa: B023, E731
        out |= {
            f"trade_count_{name}": within["trades"],
            f"volume_sum_{name}": total("volume"),
            f"signed_volume_{name}": total("signed"),
            f"null_side_count_{name}": within["sideless"],
        }
    return out


def align(snapshots: DataFrame, books: DataFrame, trades: DataFrame, windows: Windows = Windows()) -> DataFrame:
    """One row for each snapshot: frame_no, as-of book and trade, running and trailing trade sums, ages."""
    line = timeline(snapshots, books, trades)
    to_date = Window.partitionBy(*KEYS).orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
    volume, price, side = F.col("trade.volume"), F.col("trade.price"), F.col("trade.side")
    is_trade = F.col("kind") == TRADE
    columns = {
        "frame_no": F.count(F.when(F.col("kind") == FRAME, 1)).over(to_date),
        "book_asof": F.last("book", ignorenulls=True).over(to_date),
        "trade_asof": F.last("trade", ignorenulls=True).over(to_date),
        "trade_count_intraday": F.count(F.when(is_trade, 1)).over(to_date),
        "run_volume": F.sum(volume).over(to_date),
        "run_value": F.sum(price * volume).over(to_date),
    }
    columns |= trailing_sums(is_trade, volume, side, windows.trailing)
    frames = line.select(*KEYS, "event_us", "ingested_us", "seq", "kind", "snap", *[c.alias(n) for n, c in columns.items()]).filter(F.col("kind") == FRAME)
    return frames.select(
        "*",
        X.age_ms(F.col("event_us"), F.col("book_asof.event_us")).alias("book_age_ms"),
        X.age_ms(F.col("event_us"), F.col("trade_asof.event_us")).alias("tick_age_ms"),
        F.lit(0).cast("long").alias("snapshot_age_ms"),
    ).drop("kind")


def assign_forward(snapshots: DataFrame, trades: DataFrame) -> DataFrame:
    """Each trade with the first frame at or after its time (null after the last): it belongs to one frame only."""
    s = snapshots.select(*KEYS, "event_us", "ingested_us", "seq", F.lit(FRAME).alias("kind"), F.lit(None).cast(trades.select(_payload(trades)).schema[0].dataType).alias("trade"))
    t = trades.select(*KEYS, "event_us", "ingested_us", "seq", F.lit(TRADE).alias("kind"), _payload(trades).alias("trade"))
    order = Window.partitionBy(*KEYS).orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
    is_frame = F.when(F.col("kind") == FRAME, 1)
    # frames are numbered in this order, so the next one is the number so far plus one
    ahead = s.unionByName(t).select("*", F.count(is_frame).over(order).alias("__before"), F.count(is_frame).over(Window.partitionBy(*KEYS)).alias("__all"))
    number = F.when(F.col("__before") < F.col("__all"), F.col("__before") + 1)
    return ahead.filter(F.col("kind") == TRADE).select(*KEYS, "seq", number.alias("frame_no"), "ingested_us", "trade.*")


def frame_summary(frames: DataFrame) -> DataFrame:
    """Per day: number of frames, first and last time, last frame_no."""
    return frames.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("frame_count"), F.min("event_us").alias("first_us"), F.max("event_us").alias("last_us"), F.max("frame_no").alias("last_frame"))


def lagged_prices(frames: DataFrame, price: str, windows: Windows = Windows(), order: tuple[str, str] = ("event_us", "frame_no")) -> DataFrame:
    """The price of the last frame at or before t - lag, for each lag; a null price there is not skipped."""
    time, number = order
    by_time = Window.partitionBy(*KEYS).orderBy(time)
    last = lambda lag: F.max(F.struct(number, price)).over(by_time.rangeBetween(Window.unboundedPreceding, -lag))
    return frames.withColumns({f"price_lag_{name}": last(lag)[price] for name, lag in windows.lags.items()})


def realized_volatility(frames: DataFrame, price: str, windows: Windows = Windows()) -> DataFrame:
    """Root of summed squared frame returns in (t - w, t], without the return into the first frame there.

    A running sum of squared returns is taken at the frame and at the first frame of its window.  That is the frame
    after the last one at or before t - w, so each frame carries the sum at its follower; no frame slides.
    """
    rows = Window.partitionBy(*KEYS).orderBy("frame_no")
    to_date = rows.rowsBetween(Window.unboundedPreceding, 0)
    by_time = Window.partitionBy(*KEYS).orderBy("event_us")
    base = frames.withColumn("frame_return", X.simple_return(F.col(price), F.lag(price).over(rows)))
    base = base.withColumns({"__sq": F.coalesce(F.sum(F.col("frame_return") ** 2).over(to_date), F.lit(0.0)), "__n": F.count("frame_return").over(to_date)})
    base = base.withColumns({"__sq_next": F.lead("__sq").over(rows), "__n_next": F.lead("__n").over(rows)})
    last = F.struct("frame_no", "__sq_next", "__n_next")
    before = {f"__before_{n}": F.max(last).over(by_time.rangeBetween(Window.unboundedPreceding, -size)) for n, size in windows.volatility.items()}
    base = base.withColumns(before)
    out = {}
    for name in windows.volatility:
        # without a frame before the window it begins at the day's first frame, whose sum is 0
        sq, n = (F.coalesce(F.col(f"__before_{name}")[f"{c}_next"], F.lit(0)) for c in ("__sq", "__n"))
        out[f"rv_{name}"] = F.when(F.col("__n") > n, F.sqrt(F.greatest(F.col("__sq") - sq, F.lit(0.0))))
    return base.withColumns(out).drop("__sq", "__n", "__sq_next", "__n_next", *before)
