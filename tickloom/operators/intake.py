"""Intake of raw records: which symbols, days and sources count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..params import KEYS


def only_symbols(df: DataFrame, symbols: str | None) -> DataFrame:
    """Rows of the comma-separated symbols, whatever their case; without any all rows.

    On a table partitioned by symbol it prunes partitions; the feed's readers prune folders (see readers.feed_paths).
    """
    wanted = sorted({s.strip().upper() for s in (symbols or "").split(",") if s.strip()})
    return df.filter(F.col("symbol").isin(wanted)) if wanted else df


def with_intraday(days: DataFrame, intraday: DataFrame, include_historical_only: bool = False) -> DataFrame:
    """Daily records of days that have intraday records; all of them if asked for."""
    return days if include_historical_only else days.join(intraday.select(*KEYS).distinct(), list(KEYS), "left_semi")


def latest_source(records: DataFrame, order: list[str]) -> DataFrame:
    """Of each day the record that is last by ``order``."""
    rest = [c for c in records.columns if c not in KEYS]
    picked = records.groupBy(*KEYS).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("x"))
    return picked.select(*KEYS, "x.*")


def source_counts(records: DataFrame, value: str, time: str = "mtime", path: str = "path") -> DataFrame:
    """Per day: records, how many have a value, whether all values are good, newest source and number of files."""
    return records.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("record_count"),
        F.count(value).alias("priced_count"),
        F.bool_and(F.col(value) > 0).alias("complete"),
        F.max(time).alias("newest"),
        F.count_distinct(path).alias("file_count"),
    )


def quarantine(records: DataFrame, bad: Column) -> tuple[DataFrame, DataFrame]:
    """(records of days without a bad record, the other days with their number of bad records)."""
    marked = records.withColumn("__bad", bad)
    failed = marked.filter("__bad").groupBy(*KEYS).agg(F.count(F.lit(1)).alias("bad_records"))
    return records.join(failed, list(KEYS), "left_anti"), failed
