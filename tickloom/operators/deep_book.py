"""Deep-book memory as windows: what each price level that left the visible book would be by now.

A level is a (side, price) of a symbol and day.  While it is visible it is observed; once gone it is remembered until
it has been unseen for the expiry time at some frame.  Levels never interact, so a level's history is cut into lives
(a sighting after an expiry starts a new one), every sighting is densified up to the next sighting or expiry, and
state, score and confidence are expressions over running sums.  No Python, no state store; see ``streaming`` for the
stateful twin.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import exprs as X
from ..params import CARRIED_STATES, KEYS, STATE_CONFIDENCE, Memory

LEVEL = (*KEYS, "side", "price")


def _last_of_price(levels: Column, scale: int) -> Column:
    """The usable levels of an array; of equal prices the last counts.  A frame's levels lie in one row: no shuffle."""
    plain = F.transform(F.coalesce(levels, F.array()), lambda x: F.struct(X.price_token(x["price"], scale).alias("price"), x["volume"].alias("volume")))
    usable = F.filter(plain, lambda x: x["price"].isNotNull() & x["volume"].isNotNull())
    last = lambda found: F.filter(found, lambda x, i: ~F.exists(F.slice(found, i + 2, F.size(found)), lambda y: y["price"] == x["price"]))
    return F.transform(F.array(usable), last)[0]


def visible_levels(frames: DataFrame, scale: int = 6, keep: tuple[str, ...] = ()) -> DataFrame:
    """(keys, frame_no, event_us, kept columns, side, price, volume) of the as-of book of each frame."""
    tagged = lambda side: F.transform(_last_of_price(F.col(f"book_asof.{side}_levels"), scale), lambda x: F.struct(F.lit(side).alias("side"), x["price"].alias("price"), x["volume"].alias("volume")))
    both = frames.select(*KEYS, "frame_no", "event_us", *keep, F.explode(F.concat(tagged("ask"), tagged("bid"))).alias("x"))
    return both.select(*KEYS, "frame_no", "event_us", *keep, "x.*")


def matched_volumes(assigned: DataFrame, scale: int = 6) -> DataFrame:
    """Traded volume by frame and level: sells hit bids, buys hit asks, trades without a side both."""
    sides = F.when(F.col("side") == "S", F.array(F.lit("bid"))).when(F.col("side") == "B", F.array(F.lit("ask"))).otherwise(F.array(F.lit("ask"), F.lit("bid")))
    usable = assigned.filter("frame_no is not null and price is not null and volume is not null")
    rows = usable.select(*KEYS, "frame_no", X.price_token(F.col("price"), scale).alias("price"), "volume", F.explode(sides).alias("book_side"))
    return rows.groupBy(*KEYS, "frame_no", F.col("book_side").alias("side"), "price").agg(F.sum("volume").alias("matched"))


def wall_score(unexplained: Column, largest: Column, reappeared: Column, stale_ms: Column, m: Memory) -> Column:
    return X.clamp(
        0.35 * unexplained
        + 0.20 * X.clamp(largest / F.lit(m.wall_volume))
        + 0.25 * X.clamp(reappeared / F.lit(3.0))
        + 0.20 * X.clamp(stale_ms / F.lit(float(m.expiry_ms)))
    )


def missing_state(stale_ms: Column, ratio: Column, carry: Column, largest: Column, score: Column, reappeared: Column, m: Memory) -> Column:
    wall = (stale_ms >= m.wall_stale_ms) & (reappeared > 0) & (score >= m.wall_score) & (largest >= m.wall_volume)
    return (
        F.when(stale_ms >= m.expiry_ms, "EXPIRED")
        .when(ratio >= 0.95, "CONSUMED_BY_TRADES")
        .when((carry > 0) & (stale_ms <= m.carry_ms), "CARRIED_OUTSIDE_TOP3")
        .when(wall, "SUSPECTED_FAKE_WALL")
        .otherwise("PULLED_OR_CANCELLED")
    )


def confidence(state: Column, stale_ms: Column, depth_unusable: Column, side_nullable: Column, m: Memory) -> Column:
    base = F.element_at(F.create_map(*[F.lit(x) for kv in STATE_CONFIDENCE.items() for x in kv]), state)
    penalties = F.when(depth_unusable, 0.08).otherwise(0.0) + F.when(side_nullable, 0.04).otherwise(0.0)
    return X.clamp(base - 0.20 * X.clamp(stale_ms / F.lit(float(m.expiry_ms))) - penalties)


def deep_book(frames: DataFrame, assigned: DataFrame, memory: Memory = Memory(), flags: DataFrame | None = None) -> DataFrame:
    """Every remembered level of every frame.

    ``frames`` has the keys, frame_no (from 1 in the order of event_us), event_us and book_asof; ``assigned`` the trades with their frame (see
    align.assign_forward); ``flags`` optionally book_total_depth_unusable and trade_side_nullable for each day.
    """
    expiry_us = memory.expiry_ms * 1000
    day = Window.partitionBy(*KEYS)
    # frames earlier than a frame's expiry; the next one in number is the first at or after it
    before = F.count(F.lit(1)).over(day.orderBy("event_us").rangeBetween(Window.unboundedPreceding, expiry_us - 1))
    clocked = frames.select(
        *KEYS,
        "frame_no",
        "event_us",
        "book_asof",
        F.lag("event_us").over(day.orderBy("frame_no")).alias("t_before"),
        before.alias("__before"),
        F.max("frame_no").over(day).alias("last_frame"),
    ).withColumn("expiry_frame", F.when(F.col("__before") < F.col("last_frame"), F.col("__before") + 1))
    seen = visible_levels(clocked, memory.price_scale, ("t_before", "expiry_frame", "last_frame"))
    level = Window.partitionBy(*LEVEL).orderBy("frame_no")
    gone = (F.col("frame_no") - 1 > F.lag("frame_no").over(level)) & (F.col("t_before") - F.lag("event_us").over(level) >= expiry_us)
    seen = seen.withColumn("__new", F.coalesce(gone, F.lit(True)).cast("int"))
    seen = seen.withColumn("life", F.sum("__new").over(level.rowsBetween(Window.unboundedPreceding, 0)))
    life = Window.partitionBy(*LEVEL, "life").orderBy("frame_no")
    so_far = life.rowsBetween(Window.unboundedPreceding, 0)
    seen = (
        seen.withColumn("first_seen_us", F.first("event_us").over(so_far))
        .withColumn("__late", F.col("frame_no") - F.first("frame_no").over(so_far) != F.row_number().over(life) - 1)
        .withColumn("reappeared_count", F.count(F.when(F.col("__late"), 1)).over(so_far))
        .withColumn("max_observed_volume", F.max("volume").over(so_far))
        .withColumn("__first", F.row_number().over(life) == 1)
        .withColumn("__until", F.least(F.lead("frame_no").over(level) - 1, F.coalesce("expiry_frame", "last_frame"), "last_frame"))
    )
    # every sighting with the frames up to the next one or its expiry, in one pass
    dense = seen.select(
        *LEVEL,
        F.col("frame_no").alias("seen_no"),
        F.col("event_us").alias("last_seen_us"),
        "first_seen_us",
        "reappeared_count",
        "max_observed_volume",
        F.col("volume").alias("last_observed_volume"),
        "__first",
        F.explode(F.sequence(F.col("frame_no"), F.col("__until"))).alias("frame_no"),
    )
    dense = dense.join(frames.select(*KEYS, "frame_no", "event_us"), [*KEYS, "frame_no"]).join(
        matched_volumes(assigned, memory.price_scale), [*KEYS, "frame_no", "side", "price"], "left"
    )
    since = Window.partitionBy(*LEVEL, "seen_no").orderBy("frame_no").rowsBetween(Window.unboundedPreceding, 0)
    zero, shown = F.lit(0.0), F.col("frame_no") == F.col("seen_no")
    both = (
        dense.withColumn("__fresh", shown & F.col("__first"))
        .withColumn("baseline", F.when(shown, zero).otherwise(F.greatest(F.col("last_observed_volume"), zero)))
        .withColumn("stale_age_ms", F.when(shown, F.lit(0).cast("long")).otherwise(X.age_ms(F.col("event_us"), F.col("last_seen_us"))))
        .withColumn("executed", F.least(F.col("baseline"), F.coalesce(F.sum(F.when(~shown, F.col("matched"))).over(since), zero)))
        .withColumn("ratio", F.when(F.col("baseline") <= 0, 1.0).otherwise(X.clamp(X.safe_div(F.col("executed"), F.col("baseline")))))
        .withColumn("carry", F.greatest(F.col("baseline") - F.col("executed"), zero))
        .withColumn("score", F.when(shown, zero).otherwise(wall_score(1 - F.col("ratio"), F.col("max_observed_volume"), F.col("reappeared_count"), F.col("stale_age_ms"), memory)))
    )
    values = [F.col(c) for c in ("stale_age_ms", "ratio", "carry", "max_observed_volume", "score", "reappeared_count")]
    visible = F.when(F.col("reappeared_count") > 0, "REAPPEARED").otherwise("OBSERVED_TOP3")
    both = both.withColumn("state", F.when(shown, visible).otherwise(missing_state(*values, memory)))
    if flags is not None:
        both = both.join(flags.select(*KEYS, "book_total_depth_unusable", "trade_side_nullable"), list(KEYS), "left")
        unusable, nullable = (F.coalesce(F.col(c), F.lit(False)) for c in ("book_total_depth_unusable", "trade_side_nullable"))
    else:
        unusable = nullable = F.lit(False)
    sure = F.when(F.col("__fresh"), F.lit(STATE_CONFIDENCE["OBSERVED_TOP3"])).otherwise(confidence(F.col("state"), F.col("stale_age_ms"), unusable, nullable, memory))
    return both.select(
        *LEVEL,
        "frame_no",
        "event_us",
        "state",
        "first_seen_us",
        "last_seen_us",
        "last_observed_volume",
        "max_observed_volume",
        F.col("reappeared_count").cast("long").alias("reappeared_count"),
        "stale_age_ms",
        F.col("baseline").alias("disappeared_volume"),
        F.col("executed").alias("executed_volume_at_price"),
        F.col("ratio").alias("trade_explained_ratio"),
        F.col("carry").alias("carry_forward_volume"),
        F.col("carry").alias("cancel_inferred_volume"),
        F.col("score").alias("wall_suspicion_score"),
        sure.alias("reconstruction_confidence"),
    )


def frame_totals(levels: DataFrame) -> DataFrame:
    """Per frame: memory_level_count, carried_level_count, wall_candidate_count."""
    return levels.groupBy(*KEYS, "frame_no").agg(
        F.count(F.lit(1)).alias("memory_level_count"),
        F.count_if(F.col("state").isin(*CARRIED_STATES)).alias("carried_level_count"),
        F.count_if(F.col("state") == "SUSPECTED_FAKE_WALL").alias("wall_candidate_count"),
    )


def day_summary(frames: DataFrame, levels: DataFrame) -> DataFrame:
    """Per day: frame_count and frames_with_wall_candidates."""
    with_walls = frame_totals(levels).groupBy(*KEYS).agg(F.count_if(F.col("wall_candidate_count") > 0).alias("frames_with_wall_candidates"))
    return frames.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("frame_count")).join(with_walls, list(KEYS), "left").fillna(0, ["frames_with_wall_candidates"])


def wall_candidates(levels: DataFrame) -> DataFrame:
    return levels.filter("state = 'SUSPECTED_FAKE_WALL'").select(*LEVEL, "frame_no", "state", "wall_suspicion_score", "reconstruction_confidence")


def latest_levels(levels: DataFrame) -> DataFrame:
    """The levels of each day's last frame that has any."""
    last = levels.groupBy(*KEYS).agg(F.max("frame_no").alias("frame_no"))
    return levels.join(last, [*KEYS, "frame_no"], "left_semi")


def depth_extension(frames: DataFrame, levels: DataFrame, depth: int = 5, scale: int = 6) -> DataFrame:
    """Per frame and side the first three observed levels, filled from memory to ``depth``.

    Remembered prices that are not observed on that side and not expired come best first, with the volume carried
    forward or, where none is, the volume last seen.  Returns depth sums, level counts and the number missing.
    """
    observed = visible_raw(frames, scale)
    shown = observed.filter(F.col("nth") <= 3).groupBy(*KEYS, "frame_no", "side").agg(F.count(F.lit(1)).alias("observed_count"), F.sum("volume").alias("observed_depth"))
    volume = F.when(F.col("carry_forward_volume") > 0, F.col("carry_forward_volume")).otherwise(F.col("last_observed_volume"))
    memory = levels.filter("state <> 'EXPIRED'").withColumn("fill", volume).filter("fill > 0").join(observed.select(*KEYS, "frame_no", "side", "price"), [*KEYS, "frame_no", "side", "price"], "left_anti")
    better = F.when(F.col("side") == "bid", -F.col("price")).otherwise(F.col("price"))
    ranked = memory.withColumn("rank", F.row_number().over(Window.partitionBy(*KEYS, "frame_no", "side").orderBy(better)))
    base = frames.select(*KEYS, "frame_no", F.explode(F.array(F.lit("ask"), F.lit("bid"))).alias("side"))
    with_shown = base.join(shown, [*KEYS, "frame_no", "side"], "left").fillna({"observed_count": 0, "observed_depth": 0.0})
    filled = (
        with_shown.select(*KEYS, "frame_no", "side", "observed_count")
        .join(ranked, [*KEYS, "frame_no", "side"])
        .filter(F.col("rank") <= F.lit(depth) - F.col("observed_count"))
        .groupBy(*KEYS, "frame_no", "side")
        .agg(F.count(F.lit(1)).alias("used_count"), F.sum("fill").alias("used_depth"))
    )
    out = with_shown.join(filled, [*KEYS, "frame_no", "side"], "left").fillna({"used_count": 0, "used_depth": 0.0})
    one = lambda side, value: F.max(F.when(F.col("side") == side, value))
    total, count = F.col("observed_depth") + F.col("used_depth"), F.col("observed_count") + F.col("used_count")
    return out.groupBy(*KEYS, "frame_no").agg(
        one("bid", total).alias("bid_depth_l5"),
        one("ask", total).alias("ask_depth_l5"),
        one("bid", F.col("observed_count")).alias("observed_bid_level_count"),
        one("ask", F.col("observed_count")).alias("observed_ask_level_count"),
        one("bid", F.col("used_count")).alias("reconstructed_bid_levels_used"),
        one("ask", F.col("used_count")).alias("reconstructed_ask_levels_used"),
        F.sum(F.lit(depth) - count).alias("missing_depth_level_count"),
        (F.max("used_count") > 0).alias("used_reconstructed_depth_l5"),
    )


def visible_raw(frames: DataFrame, scale: int = 6) -> DataFrame:
    """Usable levels of the as-of book in their order, numbered from 1."""
    usable = lambda side: X.usable_levels(F.coalesce(F.col(f"book_asof.{side}_levels"), F.array()), scale)
    tagged = lambda side: F.transform(usable(side), lambda x, i: F.struct(F.lit(side).alias("side"), (i + 1).alias("nth"), x["price"].alias("price"), x["volume"].alias("volume")))
    return frames.select(*KEYS, "frame_no", F.explode(F.concat(tagged("ask"), tagged("bid"))).alias("x")).select(*KEYS, "frame_no", "x.*")
