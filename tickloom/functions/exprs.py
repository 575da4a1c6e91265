"""Column expressions shared by the operators.  All stay in whole-stage code; bad input gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import LOCAL_SHIFT_HOURS, Session

DAY = 24 * 3600 * 1_000_000


def safe_div(a: Column, b: Column) -> Column:
    """a / b, null where b is null or 0."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def simple_return(current: Column, previous: Column) -> Column:
    return safe_div(current, previous) - 1


def clamp(x: Column, low: float = 0.0, high: float = 1.0) -> Column:
    """Limited to [low, high]; null stays null (greatest and least alone would skip it)."""
    return F.when(x.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), x)))


def price_token(price: Column, scale: int = 6) -> Column:
    return F.bround(price, scale)


def signed_volume(side: Column, volume: Column) -> Column:
    """Bought +, sold -, unknown side 0; null without a volume."""
    return F.when(volume.isNotNull(), F.when(side == "B", volume).when(side == "S", -volume).otherwise(F.lit(0.0)))


def approx_equal(a: Column, b: Column, tolerance: float) -> Column:
    return F.coalesce(F.abs(a - b) <= F.lit(tolerance), F.lit(False))


def age_ms(now_us: Column, then_us: Column) -> Column:
    """Whole milliseconds, at least 0; null if nothing was seen."""
    return F.when(then_us.isNotNull(), F.greatest(F.floor((now_us - then_us) / 1000), F.lit(0)).cast("long"))


def clean_symbol(raw: Column) -> Column:
    text = F.translate(F.trim(F.upper(raw)), "/\\", "__")
    return F.coalesce(F.nullif(text, F.lit("")), F.lit("UNKNOWN"))


def clean_side(raw: Column) -> Column:
    return F.nullif(F.upper(F.trim(raw)), F.lit(""))


def date_text(raw: Column) -> Column:
    """The first ten characters as a date, null unless they are one."""
    head = F.substring(F.trim(raw), 1, 10)
    return F.when(F.length(head) == 10, head.try_cast("date"))


def to_float(raw: Column) -> Column:
    return raw.try_cast("double")


def to_int(raw: Column) -> Column:
    return raw.try_cast("bigint")


_OFFSET = r"(Z|[+-]\d{2}:?\d{2})$"


def parse_event_time(raw: Column) -> Column:
    """UTC instant of ISO text; without an offset the text is UTC.  The session time zone must be UTC."""
    return F.trim(raw).try_cast("timestamp")


def parse_ingest_time(raw: Column) -> Column:
    """UTC instant of ISO text; without an offset the text is local."""
    t = F.trim(raw)
    return F.when(t.rlike(_OFFSET), t.try_cast("timestamp")).otherwise(t.try_cast("timestamp") - F.expr(f"INTERVAL {LOCAL_SHIFT_HOURS} HOURS"))


def ingest_zone_source(raw: Column) -> Column:
    t = F.trim(raw)
    return F.when(t.try_cast("timestamp").isNull(), None).when(t.rlike(_OFFSET), F.lit("explicit")).otherwise(F.lit("assumed"))


def to_local(utc: Column) -> Column:
    return utc + F.expr(f"INTERVAL {LOCAL_SHIFT_HOURS} HOURS")


def micros(t: Column) -> Column:
    return F.unix_micros(t.cast("timestamp"))


def time_of_day(local_us: Column) -> Column:
    """Microseconds since local midnight of local epoch microseconds."""
    return F.pmod(local_us, F.lit(DAY))


def in_intake_session(tod: Column, s: Session = Session()) -> Column:
    """Morning half-open, afternoon closed; null is outside."""
    morning = (tod >= s.morning[0]) & (tod < s.morning[1])
    return F.coalesce(morning | tod.between(*s.afternoon), F.lit(False))


def in_quality_session(tod: Column, s: Session = Session()) -> Column:
    """Both halves closed."""
    return F.coalesce(tod.between(*s.morning) | tod.between(*s.afternoon), F.lit(False))


def in_auction(tod: Column, s: Session = Session()) -> Column:
    opening = (tod >= s.opening_auction[0]) & (tod < s.opening_auction[1])
    return F.coalesce(opening | tod.between(*s.closing_auction), F.lit(False))


def near_close(tod: Column, s: Session = Session()) -> Column:
    return F.coalesce(tod.between(*s.near_close), F.lit(False))


def levels(raw: Column) -> Column:
    """Numbered levels: the number is the place in the raw array, missing entries keep theirs."""
    numbered = F.transform(
        raw,
        lambda x, i: F.when(
            x.isNotNull(),
            F.struct((i + 1).cast("int").alias("level_no"), to_float(x["price"]).alias("price"), to_float(x["volume"]).alias("volume")),
        ),
    )
    return F.filter(numbered, lambda x: x.isNotNull())


def usable_levels(found: Column, scale: int = 6) -> Column:
    """Levels with price and volume, the price as a token."""
    kept = F.filter(found, lambda x: x["price"].isNotNull() & x["volume"].isNotNull())
    return F.transform(
        kept, lambda x: F.struct(x["level_no"].alias("level_no"), price_token(x["price"], scale).alias("price"), x["volume"].alias("volume"))
    )


def depth(found: Column, n: int) -> Column:
    """Volume of the first n levels; 0 without any."""
    return F.coalesce(F.aggregate(F.slice(found, 1, n), F.lit(0.0), lambda a, x: a + x["volume"]), F.lit(0.0))


def best(found: Column, part: str) -> Column:
    return F.try_element_at(found, F.lit(1))[part]


def imbalance(bid: Column, ask: Column) -> Column:
    return safe_div(bid - ask, bid + ask)


def freshness(count: Column, stale_ms: Column, window_ms: int) -> Column:
    """1 - age / window in [0, 1]; 0 without events or age."""
    return F.when((count > 0) & stale_ms.isNotNull(), clamp(1 - stale_ms / F.lit(float(window_ms)))).otherwise(F.lit(0.0))


def clean_number(x: Column, scale: int = 6) -> Column:
    return F.bround(x.cast("double"), scale)


def sort_prices(prices: Column, side: Column) -> Column:
    """Prices from the best of their side on: bids from the highest, asks from the lowest."""
    rising = F.array_sort(prices)
    return F.when(F.lower(side) == "bid", F.reverse(rising)).otherwise(rising)
