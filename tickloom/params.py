"""Named constants of the feature pipeline; every operator takes them as arguments."""

from __future__ import annotations

from dataclasses import dataclass, field

SECOND = 1_000_000  # microseconds
HOUR = 3600 * SECOND
LOCAL_SHIFT_HOURS = 7
KEYS = ("symbol", "trading_date")


def clock(hours: int, minutes: int = 0) -> int:
    """A time of day in microseconds."""
    return hours * HOUR + minutes * 60 * SECOND


@dataclass(frozen=True)
class Session:
    """Times of day in microseconds, local."""

    morning: tuple[int, int] = (clock(9), clock(11, 30))
    afternoon: tuple[int, int] = (clock(13), clock(14, 45))
    opening_auction: tuple[int, int] = (clock(9), clock(9, 5))
    closing_auction: tuple[int, int] = (clock(14, 40), clock(14, 45))
    near_close: tuple[int, int] = (clock(14, 30), clock(14, 45))
    close: int = clock(14, 45)
    coverage_gap_seconds: int = 120


@dataclass(frozen=True)
class Windows:
    """Trailing windows and lags in microseconds."""

    trailing: dict[str, int] = field(default_factory=lambda: {"1s": SECOND, "5s": 5 * SECOND, "10s": 10 * SECOND, "60s": 60 * SECOND, "5m": 300 * SECOND})
    lags: dict[str, int] = field(default_factory=lambda: {"1s": SECOND, "5s": 5 * SECOND, "30s": 30 * SECOND, "60s": 60 * SECOND})
    volatility: dict[str, int] = field(default_factory=lambda: {"10s": 10 * SECOND, "60s": 60 * SECOND, "5m": 300 * SECOND})


@dataclass(frozen=True)
class Memory:
    """Thresholds of the deep-book memory."""

    expiry_ms: int = 300_000
    carry_ms: int = 15_000
    wall_stale_ms: int = 60_000
    wall_score: float = 0.75
    wall_volume: float = 100_000.0
    price_scale: int = 6


@dataclass(frozen=True)
class Tolerances:
    """Tolerances of the validation rules."""

    volume: float = 1.0
    average_price: float = 0.01
    close: float = 0.001
    value: float = 50_000.0


#: Confidence of a remembered level by its state.
STATE_CONFIDENCE = {
    "OBSERVED_TOP3": 0.95,
    "REAPPEARED": 0.88,
    "CONSUMED_BY_TRADES": 0.78,
    "CARRIED_OUTSIDE_TOP3": 0.72,
    "PULLED_OR_CANCELLED": 0.64,
    "SUSPECTED_FAKE_WALL": 0.58,
    "EXPIRED": 0.40,
}
CARRIED_STATES = ("CARRIED_OUTSIDE_TOP3", "PULLED_OR_CANCELLED", "SUSPECTED_FAKE_WALL")
