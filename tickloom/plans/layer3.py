"""Layer 3 as a run of its own: from the stored tables of layer 2 to feature packages by day.

Layer 2 stores aligned frames and, beside them, one row for each frame with its remembered levels.  A run finds by the
files of both which days changed, joins the two tables, puts days whose frames do not match in quarantine, and replaces
the packages of the days that changed; days that are gone lose theirs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features
from ..params import KEYS, Memory, Windows
from ..sources import readers, sinks
from ..streaming import manifests
from ..streaming.incremental import Run, only_days
from . import pipeline

FRAMES, DEEP = "frames", "deep"


def store(frames: DataFrame, levels: DataFrame, root: str) -> None:
    """Writes the days of both tables below ``root``, replacing those days."""
    rest = [c for c in levels.columns if c not in (*KEYS, "frame_no")]
    found = levels.groupBy(*KEYS, "frame_no").agg(F.collect_list(F.struct(*rest)).alias("levels"))
    sinks.replace_days(frames, f"{root}/{FRAMES}")
    sinks.replace_days(frames.select(*KEYS, "frame_no", "event_us").join(found, [*KEYS, "frame_no"], "left"), f"{root}/{DEEP}")


@dataclass(frozen=True)
class Layer3:
    """What a run reads beside the stored tables, and its parameters."""

    days: DataFrame
    bars: DataFrame
    windows: Windows = Windows()
    memory: Memory = Memory()
    names: tuple[str, str, str, str] = ("10s", "60s", "1s", "5s")
    windows_ms: tuple[int, int] = (10_000, 60_000)
    include_current_bar: bool = False
    validation: DataFrame | None = None

    def packages(self, frames: DataFrame, deep: DataFrame) -> DataFrame:
        """The packages of joined days."""
        joined, _ = features.joined_frames(frames, deep)
        levels = joined.select(*KEYS, "frame_no", F.explode("levels").alias("x")).select(*KEYS, "frame_no", "x.*")
        state = pipeline.state_of(joined.drop("levels"), levels, self.days, self.memory)
        found = pipeline.features_of(state, self.days, self.bars, self.windows, self.names, self.windows_ms, self.include_current_bar, self.validation)
        return pipeline.feature_package(found)

    def run(self, spark: SparkSession, source: str, out: str, manifest: str, batch: int) -> Run:
        """One run over the days of ``source`` that changed since the last one; ``failed`` counts those in quarantine too."""
        paths = [f"{source}/{FRAMES}", f"{source}/{DEEP}"]
        frames, deep = (readers.read_days(spark, p) for p in paths)
        # days that only one of the tables has are no days of this layer
        records = only_days(frames, deep)
        return manifests.run_batch(
            manifests.Kept(spark, manifest),
            batch,
            manifests.of_tables(spark, paths),
            records,
            lambda some: self.packages(some, only_days(deep, some)),
            lambda df: sinks.replace_days(df, out),
            lambda gone: sinks.remove_days(spark, out, gone),
            failing=lambda dirty: features.joined_frames(only_days(frames, dirty), only_days(deep, dirty))[1],
        )
