"""The first layers as one plan: the feed's files to validated, aligned frames with their deep book."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import deep_book, intake, normalize, rules
from ..params import KEYS, Memory, Windows
from ..sources import readers
from ..staging import bucketed, written
from . import pipeline

#: The folders of the feed.
GROUPS = {"daily": "historical_price", "snapshots": "updatelastprices", "books": "updateorderbooks", "trades": "updatetrades"}
PLACE = ["path", "block", "row"]


@dataclass(frozen=True)
class Layer2:
    """Tables of a run; ``failed`` has the days in quarantine, ``broken`` the lines that are no records."""

    daily: DataFrame
    snapshots: DataFrame
    books: DataFrame
    trades: DataFrame
    results: DataFrame
    validation: DataFrame
    frames: DataFrame
    levels: DataFrame
    summary: DataFrame
    failed: DataFrame
    broken: DataFrame


def read_raw(spark: SparkSession, root: str, symbols: str | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """The raw records of the four groups, one object a line, and the broken lines."""
    raw, broken = {}, None
    for name, group in GROUPS.items():
        raw[name], bad = readers.split_broken(readers.read_lines(spark, root, group, symbols, broken=True))
        broken = bad if broken is None else broken.unionByName(bad)
    return raw, broken


def _ticks(records: DataFrame) -> DataFrame:
    """Numbered by their place in the files, and then only those inside the session."""
    numbered = normalize.number_records(records, PLACE).withColumn("local_us", X.micros(F.col("event_ts_local")))
    return numbered.drop(*PLACE, "event_ts", "event_ts_local", "ingested_ts", "ingested_tz_source")


def stage(spark: SparkSession, root: str, symbols: str | None = None) -> tuple[DataFrame, dict[str, DataFrame], DataFrame]:
    """(daily bars, normalized ticks of each kind, broken lines), each group of the feed read and parsed once.

    Ticks lie in tables bucketed by symbol and day and sorted by time, for the steps that follow.
    """
    kinds = {"snapshots": normalize.normalize_snapshots, "books": normalize.normalize_books, "trades": normalize.normalize_trades}
    read = lambda name: readers.read_lines(spark, root, GROUPS[name], symbols, broken=True)
    raw_days = written(read("daily"), "daily-bars")
    days, broken = readers.split_broken(raw_days)
    found = {}
    for name, normalized in kinds.items():
        ticks = bucketed(normalized(read(name), keep=(*PLACE, "broken_record")), name, ("event_us",))
        found[name], bad = readers.split_broken(ticks)
        broken = broken.unionByName(bad)
    return normalize.normalize_daily(days), found, broken


def build(days: DataFrame, found: dict[str, DataFrame], broken: DataFrame, windows: Windows = Windows(), memory: Memory = Memory(), include_historical_only: bool = False) -> Layer2:
    """From staged tables (see stage): quarantines days with books or trades without a time, validates, aligns and remembers levels."""
    # a book or trade whose time can't be read fails its whole day
    marked = [found[n].select(*KEYS, F.col("event_ts_local").isNull().alias("bad")) for n in ("books", "trades")]
    _, failed = intake.quarantine(marked[0].unionByName(marked[1]), F.col("bad"))
    good = {n: df.join(failed.select(*KEYS), list(KEYS), "left_anti") for n, df in found.items()}
    ticks = {n: _ticks(df.filter(X.in_intake_session(X.time_of_day(X.micros(F.col("event_ts_local")))))) for n, df in good.items()}
    snapshots, books, trades = ticks["snapshots"], ticks["books"], ticks["trades"]
    daily = intake.with_intraday(days, snapshots.select(*KEYS).unionByName(books.select(*KEYS)).unionByName(trades.select(*KEYS)), include_historical_only)
    results = rules.rule_results(daily, snapshots, books, trades)
    validation = rules.validation_status(results, books, trades)
    frames, levels = pipeline.frames_with_memory(snapshots, books, trades, windows, memory, validation)
    return Layer2(daily, snapshots, books, trades, results, validation, frames, levels, deep_book.day_summary(frames, levels), failed, broken)


def run(spark: SparkSession, root: str, symbols: str | None = None, windows: Windows = Windows(), memory: Memory = Memory(), include_historical_only: bool = False) -> Layer2:
    return build(*stage(spark, root, symbols), windows, memory, include_historical_only)
