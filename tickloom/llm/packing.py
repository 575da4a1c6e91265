"""Best-fit packing of documents into sequences of a fixed number of tokens, by large-item matching.

Documents are encoded where they lie; only longer ones than a sequence are cut, into full pieces after a first piece
that may be shorter.  What follows needs the pieces' lengths alone, and of those only how many there are of each: at
most ``capacity`` numbers.  The driver plans on these counts.  Pieces above a third of the capacity are matched
largest first with the largest partner that still fits, at most two to a bin; smaller pieces then go, largest first,
into the smallest gap that holds them, and open new bins when none does.  The plan says for each length which ranks
go to which bins; the pieces of a length are ranked without meeting in one task, and look their places up.

Defined results: a null or empty text is its end token alone; repeated ids and rows are packed like any others; a
null id keeps its row; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import gapless, written
from .textbytes import blocks, release_memory
from .tokens import BLOCK_BYTES, encoder

CAPACITY = 1024


@dataclass(frozen=True)
class Slot:
    """Ranks lo..hi-1 of a length go to bins from ``base`` on, ``per_bin`` to each, from place ``offset`` there."""

    length: int
    lo: int
    hi: int
    per_bin: int
    base: int
    offset: int


class _Bins:
    """Kinds of bins: (parts, number of bins), by their gap."""

    def __init__(self, capacity: int):
        self.by_gap: list[list[tuple[tuple[tuple[int, int], ...], int]]] = [[] for _ in range(capacity + 1)]
        self.mask = 0

    def add(self, gap: int, parts: tuple[tuple[int, int], ...], count: int) -> None:
        if count:
            self.by_gap[gap].append((parts, count))
            self.mask |= 1 << gap

    def tightest(self, size: int) -> int | None:
        """The smallest gap that holds ``size``."""
        rest = self.mask >> size
        return None if not rest else size + (rest & -rest).bit_length() - 1

    def take(self, gap: int) -> tuple[tuple[tuple[int, int], ...], int]:
        kind = self.by_gap[gap].pop()
        if not self.by_gap[gap]:
            self.mask &= ~(1 << gap)
        return kind


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Slot]:
    """Slots for ``counts`` pieces of each length; every rank of every length is in exactly one slot."""
    left = {size: n for size, n in counts.items() if n > 0}
    bins = _Bins(capacity)
    large = sorted((s for s in left if 3 * s > capacity), reverse=True)
    for size in large:
        for partner in (p for p in large if p <= min(size, capacity - size)):
            n = left[size] // 2 if partner == size else min(left[size], left[partner])
            bins.add(capacity - size - partner, ((size, 1), (partner, 1)), n)
            left[size] -= n
            left[partner] -= n
            if left[size] <= (partner == size):
                break
        bins.add(capacity - size, ((size, 1),), left[size])
        left[size] = 0
    for size in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        n = left[size]
        while n and (gap := bins.tightest(size)) is not None:
            parts, count = bins.take(gap)
            used = min(n, count)
            bins.add(gap, parts, count - used)
            if parts[-1][0] == size:
                parts = (*parts[:-1], (size, parts[-1][1] + 1))
            else:
                parts = (*parts, (size, 1))
            bins.add(gap - size, parts, used)
            n -= used
        each = capacity // size
        bins.add(capacity - each * size, ((size, each),), n // each)
        if n % each:
            bins.add(capacity - n % each * size, ((size, n % each),), 1)
    slots, base, next_rank = [], 0, dict.fromkeys(counts, 0)
    for kinds in bins.by_gap:
        for parts, count in kinds:
            offset = 0
            for size, each in parts:
                lo = next_rank[size]
                next_rank[size] = hi = lo + each * count
                slots.append(Slot(size, lo, hi, each, base, offset))
                offset += each * size
            base += count
    return slots


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` tokens: all full but perhaps the first."""
    head = n % capacity or capacity
    return [(0, min(n, head))] + [(s, capacity) for s in range(head, n, capacity)]


def _pieces(batches: Iterator[pa.RecordBatch], vocabulary: str, capacity: int) -> Iterator[pa.RecordBatch]:
    # an executor's tasks take its cores; the library's threads would only add to a worker's memory
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    try:
        coder = encoder(vocabulary)
        for batch in batches:
            rows: list[tuple[int, int, int, int, int]] = []
            for first, end, data, at in blocks(batch.column(1), BLOCK_BYTES):
                ids, bounds = coder.block(data, at)
                for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                    raw = memoryview(ids[a:b].astype("<u4").tobytes())
                    for k, (start, length) in enumerate(cut(b - a, capacity)):
                        rows.append((first + i, k, start, length, zlib.crc32(raw[4 * start : 4 * (start + length)])))
            row, k, start, length, crc = np.array(rows, dtype=np.int64).reshape(-1, 5).T
            columns = [batch.column(0).take(pa.array(row)), pa.array(k.astype(np.int32)), *map(pa.array, (start, length, crc))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])
    finally:
        # Spark keeps idle workers and takes them in turn, so each would hold an encoder
        coder = batch = data = ids = raw = rows = None  # noqa: F841
        encoder.cache_clear()
        release_memory()


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    encode = functools.partial(_pieces, vocabulary=vocabulary, capacity=capacity)
    return rows.mapInArrow(encode, "doc_id long, piece int, start long, length long, ids_crc32 long")


def place(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to rows with doc_id, piece and length."""
    spark = items.sparkSession
    # bounded: one count for each length up to the capacity
    counts = {r["length"]: r["n"] for r in items.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = plan(counts, capacity)
    # bounded by the capacity, not by the number of pieces: some thousands of slots of 48 bytes for 1024 tokens
    table = spark.createDataFrame(
        [(s.length, s.lo, s.hi, s.per_bin, s.base, s.offset) for s in slots],
        "length long, lo long, hi long, per_bin long, base long, first long",
    )
    order = [F.col("doc_id").asc_nulls_first(), F.col("piece"), F.col("ids_crc32")]
    ranked = gapless(items, "length", order, F.struct("doc_id", "piece", "ids_crc32"), "rank")
    inside = (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))
    placed = ranked.join(F.broadcast(table.withColumnRenamed("length", "of")), (F.col("length") == F.col("of")) & inside)
    nth = F.col("rank") - F.col("lo")
    return placed.select(
        *items.columns,
        (F.col("base") + F.floor(nth / F.col("per_bin"))).cast("long").alias("sequence_id"),
        (F.col("first") + nth % F.col("per_bin") * F.col("length")).cast("long").alias("offset"),
    )


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return place(written(pieces(docs, vocabulary, capacity, key, text), "pieces"), capacity)
