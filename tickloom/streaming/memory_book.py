"""The deep book as a stateful stream: the twin of operators.deep_book for live frames.

Rows of ``align.timeline`` arrive in micro-batches; rows of one day are taken in order inside a batch and batches in
order of time.  A day's state is keyed by level: a map from (side, price) to what is remembered of it, a list of the
trades since the last frame, and one value with the frame's number and the last book.  A batch reads the day's levels
once, as their frames list them all, and writes only those that it changed; expired ones are removed.  A timer ends
the day when the watermark is ``idle_ms`` past its last row.  Rows later than ``late`` are dropped here, and no
late row changes frames that are out; the batch form recomputes the whole day.

The state lies in RocksDB (``PROVIDER``), which Spark's keyed state asks for; ``use_rocksdb`` sets it for a session.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..operators.align import BOOK, FRAME, ORDER, TRADE
from ..params import KEYS, Memory

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUT = "symbol string, trading_date date, side string, price double, frame_no long, state string, last_observed_volume double, max_observed_volume double, reappeared_count long, stale_age_ms long, executed_volume_at_price double, wall_suspicion_score double"
COLUMNS = ["side", "price", "frame_no", "state", "last_observed_volume", "max_observed_volume", "reappeared_count", "stale_age_ms", "executed_volume_at_price", "wall_suspicion_score"]


LEVEL_KEY = "side string, price double"
LEVEL = "volume double, largest double, again int, seen long, executed double, missed boolean"
FIELDS = ["volume", "largest", "again", "seen", "executed", "missed"]
#: Whose trades take volume from a side.
TAKER = {"bid": "S", "ask": "B"}


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


class Levels:
    """The remembered levels of a day: a row of numbers for each (side, price), and which of them changed."""

    def __init__(self, stored: Iterator[tuple[tuple, tuple]]):
        found = [(tuple(key), tuple(value)) for key, value in stored]
        self.keys = [key for key, _ in found]
        # microseconds and counts are exact as doubles
        self.rows = np.array([value for _, value in found], dtype=np.float64).reshape(-1, len(FIELDS))
        self.changed: set[tuple[str, float]] = set()
        self.known = set(self.keys)

    def frame(self, number: int, now: int, visible: dict[tuple[str, float], float], trades: list[tuple], m: Memory) -> list[np.ndarray]:
        """Moves the levels on to the next frame and returns them by column; expired ones are gone afterwards."""
        place = {key: i for i, key in enumerate(self.keys)}
        new = [key for key in visible if key not in place]
        place |= {key: len(self.keys) + i for i, key in enumerate(new)}
        keys = self.keys + new
        rows = np.concatenate([self.rows, np.tile([0.0, -np.inf, 0.0, now, 0.0, 0.0], (len(new), 1))])
        before = rows.copy()
        here = np.zeros(len(keys), dtype=bool)
        at = np.array([place[key] for key in visible], dtype=np.int64)
        here[at] = True
        gone = ~here
        volume, largest, again, seen, executed, missed = rows.T
        again[at] += (missed[at] > 0) | (again[at] > 0)
        volume[at] = list(visible.values())
        largest[at] = np.maximum(largest[at], volume[at])
        seen[at], missed[:] = now, gone
        base = np.maximum(volume, 0.0)
        traded = np.zeros(len(keys))
        for side, price, size in trades:
            for i in (place.get((book, price)) for book, taker in TAKER.items() if side in (None, taker)):
                if i is not None:
                    traded[i] += size
        executed[:] = np.where(gone, np.minimum(base, executed + traded), 0.0)
        stale = np.where(gone, (now - seen) // 1000, 0)
        ratio = np.divide(executed, base, out=np.ones(len(keys)), where=base > 0)
        share = lambda x: np.clip(x, 0.0, 1.0)
        score = share(0.35 * (1 - ratio) + 0.20 * share(largest / m.wall_volume) + 0.25 * share(again / 3) + 0.20 * share(stale / m.expiry_ms))
        wall = (stale >= m.wall_stale_ms) & (again > 0) & (score >= m.wall_score) & (largest >= m.wall_volume)
        expired = gone & (stale >= m.expiry_ms)
        tests = [here & (again > 0), here, expired, ratio >= 0.95, (base > executed) & (stale <= m.carry_ms), wall]
        names = ["REAPPEARED", "OBSERVED_TOP3", "EXPIRED", "CONSUMED_BY_TRADES", "CARRIED_OUTSIDE_TOP3", "SUSPECTED_FAKE_WALL"]
        state = np.select(tests, names, "PULLED_OR_CANCELLED")
        touched = (rows != before).any(axis=1) | (np.arange(len(keys)) >= len(self.keys))
        self.changed |= {keys[i] for i in np.flatnonzero(touched).tolist()}
        self.keys, self.rows = [key for key, end in zip(keys, expired) if not end], rows[~expired]
        sides, prices = np.array([k[0] for k in keys], dtype=object), np.array([k[1] for k in keys], dtype=np.float64)
        return [sides, prices, np.full(len(keys), number), state.astype(object), volume, largest, again.astype(np.int64), stale.astype(np.int64), executed, np.where(gone, score, 0.0)]

    def differences(self) -> tuple[list[tuple], list[tuple]]:
        """(key and value of each level to be written, keys to be removed)."""
        kinds = (float, float, int, int, float, bool)
        left = [(k, tuple(f(x) for f, x in zip(kinds, row.tolist()))) for k, row in zip(self.keys, self.rows) if k in self.changed]
        return left, sorted(self.known - set(self.keys))


class DayBook(StatefulProcessor):
    """The deep book of one symbol's day, one map entry for each level."""

    def __init__(self, memory: Memory, idle_ms: int):
        self.memory, self.idle_ms = memory, idle_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.levels = handle.getMapState("levels", LEVEL_KEY, LEVEL)
        self.trades = handle.getListState("trades", "side string, price double, volume double")
        self.day = handle.getValueState("day", "frame long, book string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(rows)).sort_values(list(ORDER))
        number, book = self.day.get() if self.day.exists() else (0, "[]")
        held = list(self.trades.get()) if self.trades.exists() else []
        carried, out, levels = len(held), [], None
        for kind, us, shown, tick in zip(rows["kind"], rows["event_us"], rows["levels"], rows["tick"]):
            if kind == BOOK:
                book = shown
            elif kind == TRADE and isinstance(tick, str):
                x = json.loads(tick)
                held.append((x["side"], x["price"], x["volume"]))
            elif kind == FRAME:
                # only frames need the levels
                levels = levels or Levels(self.levels.iterator())
                number += 1
                visible = {(x["side"], x["price"]): x["volume"] for x in json.loads(book)}
                out.append(levels.frame(number, int(us), visible, held, self.memory))
                held, carried = [], 0
        if levels:
            written, removed = levels.differences()
            for level, value in written:
                self.levels.updateValue(level, value)
            for level in removed:
                self.levels.removeKey(level)
            self.trades.clear()
        if held[carried:]:
            self.trades.appendList(held[carried:])
        self.day.update((number, book))
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        last = int(rows["event_us"].iloc[-1]) // 1000
        self.handle.registerTimer(max(last, timerValues.getCurrentWatermarkInMs()) + self.idle_ms)
        found = pd.DataFrame(dict(zip(COLUMNS, map(np.concatenate, zip(*out))))) if out else pd.DataFrame(columns=COLUMNS)
        found.insert(0, "symbol", key[0])
        found.insert(1, "trading_date", key[1])
        yield found

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.levels.clear()
        self.trades.clear()
        self.day.clear()
        yield pd.DataFrame(columns=["symbol", "trading_date", *COLUMNS])

    def close(self) -> None:
        pass


def memory_book(timeline: DataFrame, memory: Memory = Memory(), idle_ms: int = 86_400_000, late: str = "5 minutes") -> DataFrame:
    """Levels of every frame of a streaming timeline (see align.timeline)."""
    tagged = lambda side: F.transform(F.coalesce(F.col(f"book.{side}_levels"), F.array()), lambda x: F.struct(F.lit(side).alias("side"), F.bround(x["price"], memory.price_scale).alias("price"), x["volume"].alias("volume")))
    usable = F.filter(F.concat(tagged("ask"), tagged("bid")), lambda x: x["price"].isNotNull() & x["volume"].isNotNull())
    trade = F.when((F.col("kind") == TRADE) & F.col("trade.price").isNotNull() & F.col("trade.volume").isNotNull(), F.struct(F.col("trade.side").alias("side"), F.bround("trade.price", memory.price_scale).alias("price"), F.col("trade.volume").alias("volume")))
    timed = timeline.withColumn("event_ts", F.timestamp_micros("event_us")).withWatermark("event_ts", late)
    rows = timed.select(*KEYS, "event_ts", *ORDER, F.to_json(usable).alias("levels"), F.to_json(trade, {"ignoreNullFields": "false"}).alias("tick"))
    return rows.groupBy(*KEYS).transformWithStateInPandas(DayBook(memory, idle_ms), OUT, "Append", "EventTime")
