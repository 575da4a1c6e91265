"""Market state, base features, feature store and feature quality of every frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import exprs as X
from ..params import KEYS, Session, Windows
from .align import lagged_prices, realized_volatility

AFTER_CLOSE_US = Session().close


def market_state(frames: DataFrame, extension: DataFrame | None, daily: DataFrame) -> DataFrame:
    """Prices, cumulative volumes, book depths, spread and day range so far.

    ``frames`` from align (snap with last_price, deal_volume, deal_value), ``extension`` from deep_book.depth_extension,
    ``daily`` one row for each symbol and day with price_open.
    """
    bid, ask = (X.usable_levels(F.col(f"book_asof.{s}_levels")) for s in ("bid", "ask"))
    df = frames.join(daily.select(*KEYS, F.col("price_open").alias("day_open")), list(KEYS), "left")
    df = df.select(
        *[c for c in frames.columns if c not in ("snap", "book_asof", "trade_asof")],
        "day_open",
        F.col("trade_asof.price").alias("last_trade_price"),
        F.col("trade_asof.volume").alias("last_trade_volume"),
        F.col("trade_asof.side").alias("last_trade_side"),
        F.coalesce("snap.deal_volume", "run_volume").alias("cum_volume"),
        F.coalesce("snap.deal_value", "run_value").alias("cum_trade_value"),
        F.coalesce("snap.last_price", "trade_asof.price").alias("current_price"),
        bid.alias("__bid"),
        ask.alias("__ask"),
    )
    for side in ("bid", "ask"):
        found = F.col(f"__{side}")
        df = df.withColumns({f"best_{side}": X.best(found, "price"), f"best_{side}_size": X.best(found, "volume"), f"{side}_depth_l1": X.depth(found, 1), f"{side}_depth_l3": X.depth(found, 3)})
    df = df.drop("__bid", "__ask", "run_volume", "run_value")
    if extension is not None:
        df = df.join(extension, [*KEYS, "frame_no"], "left")
    mid = (F.col("best_bid") + F.col("best_ask")) / 2
    spread = F.col("best_ask") - F.col("best_bid")
    so_far = Window.partitionBy(*KEYS).orderBy("frame_no").rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumns({"mid_price": mid, "spread": spread, "day_high_so_far": F.max("current_price").over(so_far), "day_low_so_far": F.min("current_price").over(so_far)})
    span = F.col("day_high_so_far") - F.col("day_low_so_far")
    return df.withColumns(
        {
            "spread_bps": X.safe_div(F.col("spread"), F.col("mid_price")) * 10_000,
            "vwap_intraday": X.safe_div(F.col("cum_trade_value"), F.col("cum_volume")),
            "intraday_return_from_open": X.simple_return(F.col("current_price"), F.col("day_open")),
            "intraday_pos_in_range": X.clamp(X.safe_div(F.col("current_price") - F.col("day_low_so_far"), span)),
        }
    )


def base_features(state: DataFrame, windows: Windows = Windows(), short: str = "10s", long: str = "60s", short_seconds: float = 10.0) -> DataFrame:
    """Lagged returns, realized volatility, trade flow, and book imbalances and ratios."""
    df = realized_volatility(lagged_prices(state, "current_price", windows), "current_price", windows)
    out = {f"ret_{n}": X.simple_return(F.col("current_price"), F.col(f"price_lag_{n}")) for n in windows.lags}
    out[f"trade_intensity_{short}"] = F.col(f"trade_count_{short}") / F.lit(short_seconds)
    for n in (1, 3, 5):
        if f"bid_depth_l{n}" in df.columns:
            bid, ask = F.col(f"bid_depth_l{n}"), F.col(f"ask_depth_l{n}")
            out |= {f"book_imbalance_l{n}": X.imbalance(bid, ask), f"depth_ratio_l{n}": X.safe_div(bid, ask)}
    sizes = F.col("best_bid_size") + F.col("best_ask_size")
    out["queue_pressure_l1"] = F.when(sizes > 0, X.safe_div(F.col("best_bid_size"), sizes))
    return df.withColumns(out).drop(*[f"price_lag_{n}" for n in windows.lags])


def feature_store(base: DataFrame, technicals: DataFrame, daily: DataFrame, local_us: str = "local_us", short: str = "10s") -> DataFrame:
    """Daily technicals beside each frame and the hybrids of both."""
    context = daily.select(
        *KEYS, (F.col("buy_foreign_quantity") - F.col("sell_foreign_quantity")).alias("__foreign"), F.col("total_volume").alias("__total")
    )
    df = base.join(technicals, list(KEYS), "left").join(context, list(KEYS), "left")
    price, closed = F.col("current_price"), X.time_of_day(F.col(local_us)) >= AFTER_CLOSE_US
    relative = X.safe_div(F.col("cum_volume"), F.col("avg_volume_20d"))
    return df.withColumns(
        {
            "price_to_ma20": X.safe_div(price, F.col("ma_20")),
            "price_to_ma200": X.safe_div(price, F.col("ma_200")),
            "gap_pct": X.simple_return(F.col("day_open"), F.col("previous_close")),
            "relative_volume_day": relative,
            "distance_to_day_high": X.simple_return(price, F.col("day_high_so_far")),
            "distance_to_day_low": X.simple_return(price, F.col("day_low_so_far")),
            "foreign_net_volume_day": F.when(closed, F.col("__foreign")),
            "foreign_net_ratio_day": F.when(closed, X.safe_div(F.col("__foreign"), F.col("__total"))),
            "signed_volume_x_imbalance": F.col(f"signed_volume_{short}") * F.col("book_imbalance_l1"),
            "price_to_vwap_x_relative_volume": X.safe_div(price, F.col("vwap_intraday")) * relative,
        }
    ).drop("__foreign", "__total")


def outlier(ret_1: Column, ret_5: Column, rv_10: Column, spread_bps: Column) -> Column:
    tests = [F.abs(ret_1) > 0.03, F.abs(ret_5) > 0.06, rv_10 > 0.08, spread_bps > 500.0]
    out = F.lit(False)
    for t in tests:
        out |= F.coalesce(t, F.lit(False))
    return out


def feature_quality(
    store: DataFrame,
    windows_ms: tuple[int, int] = (10_000, 60_000),
    names: tuple[str, str, str, str] = ("10s", "60s", "1s", "5s"),
    status: Column | None = None,
    flag_count: Column | None = None,
    local_us: str = "local_us",
) -> DataFrame:
    """Coverage, flags, feature_confidence and data_quality_score.

    ``status`` and ``flag_count`` feed the penalties for validation status and degraded flags; without them those
    penalties do not apply.
    """
    short, long, lag_1, lag_5 = names
    tod = X.time_of_day(F.col(local_us))
    zero = F.lit(0.0)
    count = lambda n: F.col(f"trade_count_{n}")
    df = store.withColumns(
        {
            "tick_coverage_10s": X.freshness(count(short), F.col("tick_age_ms"), windows_ms[0]),
            "tick_coverage_60s": X.freshness(count(long), F.col("tick_age_ms"), windows_ms[1]),
            "book_coverage_10s": X.freshness(F.lit(1), F.col("book_age_ms"), windows_ms[0]),
            "book_coverage_60s": X.freshness(F.lit(1), F.col("book_age_ms"), windows_ms[1]),
            "stale_tick_ms": F.col("tick_age_ms"),
            "stale_book_ms": F.col("book_age_ms"),
            "stale_book_seconds": F.col("book_age_ms") / F.lit(1000.0),
            "trade_side_inferred_ratio": F.coalesce(X.safe_div(F.col(f"null_side_count_{long}"), count(long)), zero),
            "spread_invalid_flag": F.coalesce(F.col("spread") < 0, F.lit(True)),
            "outlier_flag": outlier(F.col(f"ret_{lag_1}"), F.col(f"ret_{lag_5}"), F.col(f"rv_{short}"), F.col("spread_bps")),
            "book_reconstructed_flag": F.coalesce(F.col("used_reconstructed_depth_l5"), F.lit(False)),
            "duplicate_event_flag": F.count(F.lit(1)).over(Window.partitionBy(*KEYS, "event_us")) > 1,
            "session_valid_flag": X.in_quality_session(tod),
            "auction_flag": X.in_auction(tod),
            "near_close_flag": X.near_close(tod),
        }
    )
    off = lambda flag, weight: F.when(flag, weight).otherwise(0.0)
    confidence = F.lit(1.0)
    if status is not None:
        confidence -= F.when(status == "fail", 0.35).when(status == "degraded", 0.15).otherwise(0.0)
    if flag_count is not None:
        confidence -= 0.10 * F.least(flag_count, F.lit(3))
    confidence = (
        confidence
        - 0.20 * (1 - F.col("tick_coverage_60s"))
        - 0.20 * (1 - F.col("book_coverage_60s"))
        - 0.10 * F.col("trade_side_inferred_ratio")
        - off(F.col("book_reconstructed_flag"), 0.08)
        - 0.03 * F.least(F.coalesce("missing_depth_level_count", F.lit(0)), F.lit(4))
        - off(F.col("spread_invalid_flag"), 0.08)
        - off(F.col("outlier_flag"), 0.05)
        - off(F.col("duplicate_event_flag"), 0.05)
        - off(~F.col("session_valid_flag"), 0.05)
    )
    df = df.withColumn("feature_confidence", X.clamp(confidence))
    parts = [F.col(f"{kind}_coverage_{n}") for kind in ("tick", "book") for n in ("10s", "60s")]
    total = F.col("feature_confidence") + parts[0] + parts[1] + parts[2] + parts[3] + off(F.col("session_valid_flag"), 1.0)
    return df.withColumn("data_quality_score", X.clamp(total / 6))


def package(quality: DataFrame, state: list[str], store: list[str], scores: list[str]) -> DataFrame:
    """The final frames: keys and three structs.  Where the store has a name of the base features, the store's wins."""
    return quality.select(*KEYS, "frame_no", F.struct(*state).alias("market_state"), F.struct(*store).alias("feature_store"), F.struct(*scores).alias("feature_quality"))


def bundle_mismatches(left: DataFrame, right: DataFrame) -> DataFrame:
    """Days whose frames differ in number, frame_no or time between two frame tables: they go to quarantine."""
    a = left.select(*KEYS, "frame_no", F.col("event_us").alias("t_left"))
    b = right.select(*KEYS, "frame_no", F.col("event_us").alias("t_right"))
    both = a.join(b, [*KEYS, "frame_no"], "full_outer")
    return both.filter(~F.col("t_left").eqNullSafe(F.col("t_right"))).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("mismatches"))


def joined_frames(reference: DataFrame, deep: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(frames of both tables, days for quarantine): days that only one table has are left out, and days whose frames
    differ in number, frame_no or time fail as a whole."""
    both = reference.select(*KEYS).distinct().join(deep.select(*KEYS).distinct(), list(KEYS))
    failed = bundle_mismatches(reference, deep).join(both, list(KEYS), "left_semi")
    added = [c for c in deep.columns if c not in reference.columns or c == "frame_no"]
    joined = reference.join(deep.select(*KEYS, *added), [*KEYS, "frame_no"])
    return joined.join(failed, list(KEYS), "left_anti"), failed
