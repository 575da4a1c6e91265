"""Manifests kept between runs: what files and days an input had, one version for each micro-batch.

A version is a partition of the manifest table that its batch writes whole.  A batch compares what it finds with the
newest version older than itself, so a batch that is repeated after a failure sees the same changes again, writes the
same days and replaces its own version: a repetition changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import KEYS
from ..sources.sinks import listed
from ..staging import written
from .incremental import Run, dirty_days, run_once

ROW = "path string, symbol string, trading_date date, size long, mtime timestamp"


@dataclass(frozen=True)
class Kept:
    """The manifest table of one consumer in a folder of its own."""

    spark: SparkSession
    folder: str

    def versions(self) -> list[int]:
        """The batches that have committed, from the folder's listing."""
        try:
            files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(self.folder)
            found = files.select(F.regexp_extract("path", r"/batch=(\d+)/", 1).cast("int").alias("n")).distinct()
            # bounded: one row for each version, of which two are kept
            return sorted(r.n for r in found.collect())
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def before(self, batch: int) -> DataFrame | None:
        """The newest version older than ``batch``; none before the first one."""
        older = [v for v in self.versions() if v < batch]
        if not older:
            return None
        return self.spark.read.schema(f"{ROW}, batch int").parquet(self.folder).filter((F.col("batch") == older[-1]) & F.col("path").isNotNull()).drop("batch")

    def commit(self, now: DataFrame, batch: int) -> None:
        """Writes the version of ``batch``, in place of one that it may have written before."""
        # a row without a path marks a version that has no files
        mark = self.spark.range(1).select(*[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in ROW.split(", ")])
        rows = now.select("path", *KEYS, F.col("size").cast("long").alias("size"), F.col("mtime").cast("timestamp").alias("mtime")).unionByName(mark)
        rows.withColumn("batch", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(self.folder)


def of_tables(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The manifest of tables partitioned by symbol and day: their files by listing, without reading a row."""
    out = None
    for path in paths:
        found = listed(spark, path)
        out = found if out is None else out.unionByName(found)
    return out


def run_batch(
    kept: Kept,
    batch: int,
    now: DataFrame,
    records: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    write: Callable[[DataFrame], None],
    remove: Callable[[DataFrame], None] = lambda days: None,
    more: DataFrame | None = None,
    failing: Callable[[DataFrame], DataFrame] | None = None,
) -> Run:
    """Rebuilds the days whose files changed since the last version (and ``more``), removes those without files, and commits.

    ``failing`` names among the dirty days those to be left as they are, in quarantine.  They and days whose build
    fails are not in the committed version, so the next batch takes them up again.
    """
    now = written(now, "manifest")
    dirty = dirty_days(kept.before(batch), now)
    dirty = written(dirty if more is None else dirty.unionByName(more.select(*KEYS)).distinct(), "dirty")
    held = written(failing(dirty).select(*KEYS).distinct(), "held") if failing else dirty.limit(0)
    run = run_once(dirty.join(held, list(KEYS), "left_anti"), records, build, write, remove)
    lost = kept.spark.createDataFrame([(s, d) for s, d, _ in run.errors], "symbol string, trading_date string")
    left = now.join(held, list(KEYS), "left_anti").join(lost.withColumn("trading_date", F.col("trading_date").cast("date")), list(KEYS), "left_anti")
    kept.commit(left, batch)
    count = held.count()
    return Run(run.dirty + count, run.built, run.removed, run.failed + count, run.errors)
