"""The whole plan: aligned frames, deep book, market state, features, quality and the package.

Everything is lazy but for the aligned frames, which half a dozen later steps read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import align, daily, deep_book, features
from ..params import KEYS, Memory, Windows
from ..staging import bucketed

STATE = [
    "event_us", "last_trade_price", "last_trade_volume", "last_trade_side", "cum_volume", "cum_trade_value",
    "trade_count_intraday", "best_bid", "best_ask", "best_bid_size", "best_ask_size", "bid_depth_l1", "ask_depth_l1",
    "bid_depth_l3", "ask_depth_l3", "bid_depth_l5", "ask_depth_l5", "mid_price", "spread", "spread_bps", "day_open",
    "current_price", "day_high_so_far", "day_low_so_far", "vwap_intraday", "intraday_return_from_open",
    "intraday_pos_in_range", "book_age_ms", "tick_age_ms", "used_reconstructed_depth_l5",
    "missing_depth_level_count",
]
HYBRIDS = [
    "price_to_ma20", "price_to_ma200", "gap_pct", "relative_volume_day", "distance_to_day_high",
    "distance_to_day_low", "foreign_net_volume_day", "foreign_net_ratio_day", "signed_volume_x_imbalance",
    "price_to_vwap_x_relative_volume",
]
SCORES = [
    "tick_coverage_10s", "tick_coverage_60s", "book_coverage_10s", "book_coverage_60s", "stale_tick_ms",
    "stale_book_ms", "stale_book_seconds", "trade_side_inferred_ratio", "spread_invalid_flag", "outlier_flag",
    "book_reconstructed_flag", "duplicate_event_flag", "session_valid_flag", "auction_flag", "near_close_flag",
    "feature_confidence", "data_quality_score",
]


def frames_with_memory(
    snapshots: DataFrame, books: DataFrame, trades: DataFrame, windows: Windows = Windows(), memory: Memory = Memory(), validation: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Frames and the remembered levels of each.  The frames are read by several steps and so written once, in buckets
    of symbol and day that no step has to shuffle again.

    ``validation`` (see rules.validation_status) gives the degraded flags that lower the levels' confidence.
    """
    frames = bucketed(align.align(snapshots, books, trades, windows), "frames", ("frame_no",))
    levels = deep_book.deep_book(frames, align.assign_forward(snapshots, trades), memory, validation)
    return frames, levels


def market_state(
    snapshots: DataFrame, books: DataFrame, trades: DataFrame, days: DataFrame, windows: Windows = Windows(), memory: Memory = Memory(), validation: DataFrame | None = None
) -> DataFrame:
    return state_of(*frames_with_memory(snapshots, books, trades, windows, memory, validation), days, memory)


def state_of(frames: DataFrame, levels: DataFrame, days: DataFrame, memory: Memory = Memory()) -> DataFrame:
    """The market state of aligned frames and their remembered levels."""
    # the local time of a frame travels in its snapshot
    frames = frames.withColumn("local_us", F.col("snap.local_us")) if "local_us" in frames.schema["snap"].dataType.names else frames
    return features.market_state(frames, deep_book.depth_extension(frames, levels, scale=memory.price_scale), days)


def feature_frames(
    snapshots: DataFrame,
    books: DataFrame,
    trades: DataFrame,
    days: DataFrame,
    bars: DataFrame,
    windows: Windows = Windows(),
    memory: Memory = Memory(),
    names: tuple[str, str, str, str] = ("10s", "60s", "1s", "5s"),
    windows_ms: tuple[int, int] = (10_000, 60_000),
    include_current_bar: bool = False,
    validation: DataFrame | None = None,
) -> DataFrame:
    """Every frame with all its columns; with ``validation`` its status and degraded flags lower the quality."""
    state = market_state(snapshots, books, trades, days, windows, memory, validation)
    return features_of(state, days, bars, windows, names, windows_ms, include_current_bar, validation)


def features_of(
    state: DataFrame,
    days: DataFrame,
    bars: DataFrame,
    windows: Windows,
    names: tuple[str, str, str, str],
    windows_ms: tuple[int, int],
    include_current_bar: bool = False,
    validation: DataFrame | None = None,
) -> DataFrame:
    """Features, hybrids and quality on top of the market state."""
    short, long, *_ = names
    base = features.base_features(state, windows, short, long, windows_ms[0] / 1000)
    technicals = daily.as_of_days(days.select(*KEYS), bars, include_current_bar)
    store = features.feature_store(base, technicals, days, short=short)
    if validation is None:
        return features.feature_quality(store, windows_ms, names)
    flags = [F.coalesce(F.col(c), F.lit(False)).cast("int") for c in ("book_total_depth_unusable", "trade_side_nullable")]
    found = validation.select(*KEYS, F.col("validation_status").alias("__status"), (flags[0] + flags[1]).alias("__flags"))
    judged = store.join(found, list(KEYS), "left")
    return features.feature_quality(judged, windows_ms, names, F.col("__status"), F.coalesce("__flags", F.lit(0))).drop("__status", "__flags")


def feature_package(frames: DataFrame) -> DataFrame:
    skip = {*KEYS, "frame_no", "ingested_us", "seq", "local_us", *STATE, *SCORES}
    return features.package(frames, STATE, [c for c in frames.columns if c not in skip], SCORES)
