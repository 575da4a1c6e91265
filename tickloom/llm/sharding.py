"""Hierarchical weighted hash tree: documents to shards through regions and racks.

Shards hang in racks, racks in regions (``SHARDS_PER_RACK`` and ``RACKS_PER_REGION`` children each); shard numbers fill
racks and regions in order.  A document's key descends the tree.  Every region makes one weighted draw, an exponential
variate whose rate is the weight of all its places, and the smallest wins; inside the region each rack makes a draw
at its own weight, inside the rack each shard.  Draws come from a hash of key, node and attempt, so the work is
regions + racks + shards of one path and not all shards.

The last region may have places that hold no shard yet.  Its places are drawn all the same: a draw that ends at an
empty place is set aside, and the region's next attempt adds its own exponential to the time of the one before.  So each
place has a first time of its own, whether it holds a shard or not, and a document goes to the shard with the
smallest.  This is the law ``key``: key and shard count alone decide, and a shard that is added can only win
documents.  A weight that changes changes only the draws of the nodes above it: documents move between the changed
region and others, or inside it, and never between regions, racks or shards whose weights stay.

Defined results: a null key is hashed as the text ``null``; repeated keys land in the same shard; null text has
0 bytes and the checksum of the empty text; other columns of the input are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import gapless, written
from .textbytes import mix

SHARDS_PER_RACK = 4
RACKS_PER_REGION = 3
PER_REGION = SHARDS_PER_RACK * RACKS_PER_REGION


def draw(keys: np.ndarray, node: int, attempt: int, weight: float) -> np.ndarray:
    """An exponential variate of rate ``weight`` for each key, fixed by key, node and attempt."""
    label = mix(np.array([node * 2**20 + attempt], dtype=np.uint64))
    h = mix(keys ^ label) >> np.uint64(11)
    return -np.log((h.astype(np.float64) + 0.5) / 2.0**53) / weight


class Tree:
    """Weights of the places of all regions that the shards need."""

    def __init__(self, shards: int, weights: list[float] | None = None):
        regions = -(-shards // PER_REGION)
        places = np.ones(regions * PER_REGION)
        given = np.asarray(weights if weights is not None else [], dtype=float)[: len(places)]
        if (given <= 0).any():
            raise ValueError("weights must be positive")
        places[: len(given)] = given
        self.shards = shards
        self.place = places.reshape(regions, RACKS_PER_REGION, SHARDS_PER_RACK)
        self.rack = self.place.sum(2)
        self.region = self.rack.sum(1)

    @staticmethod
    def _node(level: int, number: int) -> int:
        return 3 * number + level

    def _smallest(self, keys: np.ndarray, level: int, first: int, attempt: int, weights: np.ndarray) -> np.ndarray:
        """Which of sibling nodes has the smallest draw."""
        return np.stack([draw(keys, self._node(level, first + i), attempt, w) for i, w in enumerate(weights)]).argmin(0)

    def descend(self, keys: np.ndarray, region: int, attempt: int) -> np.ndarray:
        """The place inside a region at which each key ends."""
        rack = self._smallest(keys, 1, region * RACKS_PER_REGION, attempt, self.rack[region])
        out = np.empty(len(keys), dtype=np.int64)
        for r in range(RACKS_PER_REGION):
            here = np.flatnonzero(rack == r)
            if len(here):
                first = region * PER_REGION + r * SHARDS_PER_RACK
                out[here] = first + self._smallest(keys[here], 2, first, attempt, self.place[region, r])
        return out

    def shard(self, keys: np.ndarray) -> np.ndarray:
        """The shard of each key."""
        best, out = np.full(len(keys), np.inf), np.full(len(keys), -1, dtype=np.int64)
        winner = np.full(len(keys), -1)
        for region, weight in enumerate(self.region):
            time = draw(keys, self._node(0, region), 0, weight)
            if (region + 1) * PER_REGION <= self.shards:
                won = time < best
                best[won], winner[won] = time[won], region
                continue
            # the last region: attempts until one ends at a shard or comes later than the best so far
            open_, attempt = np.flatnonzero(time < best), 0
            time = time[open_]
            while len(open_):
                place = self.descend(keys[open_], region, attempt)
                good = place < self.shards
                won = open_[good]
                best[won], winner[won], out[won] = time[good], -1, place[good]
                open_, time, attempt = open_[~good], time[~good], attempt + 1
                time = time + draw(keys[open_], self._node(0, region), attempt, weight)
                early = time < best[open_]
                open_, time = open_[early], time[early]
        for region in np.unique(winner[winner >= 0]).tolist():
            here = np.flatnonzero(winner == region)
            out[here] = self.descend(keys[here], region, 0)
        return out


def assign(docs: DataFrame, shards: int = 24, weights: list[float] | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, size (UTF-8 bytes + 8), text_crc32, law, shard, slot (gapless per shard), grown_shard."""
    trees = Tree(shards, weights), Tree(shards + 1, weights)
    rows = docs.select(
        F.col(key).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit("null"))).alias("__key"),
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(3).to_numpy(zero_copy_only=False).view(np.uint64)
            found = [pa.array(t.shard(keys).astype(np.int32)) for t in trees]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *found], ["doc_id", "size", "text_crc32", "shard", "grown_shard"])

    kind = docs.schema[key].dataType.simpleString()
    placed = rows.mapInArrow(place, f"doc_id {kind}, size long, text_crc32 long, shard int, grown_shard int")
    order = [F.col("doc_id").asc_nulls_first(), F.col("text_crc32"), F.col("size")]
    # written once, so that the texts are read once
    numbered = gapless(written(placed, "placed"), "shard", order, F.struct("doc_id", "text_crc32", "size"), "slot")
    return numbered.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
