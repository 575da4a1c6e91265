"""Hard negatives of anchors by pruned inner products over leading principal components.

A component x becomes floor(256 * x), and a row's score is its integer inner product with the anchor.  An anchor's
positives are its best other rows of its label; for each positive, its hard negatives are the best rows of other labels
whose score lies between two shares of the positive's.

Anchors are taken in blocks of a bounded number of bytes; every row meets every block in the task that reads it, once
for the positives and once for the negatives.  Rows and anchors are turned onto orthogonal principal axes, on which
the first few components hold most of a product.  Partial products over them, plus the product of the residual norms
and a slack for rounding, bound each score; a pair whose bound is below all that its anchor still needs is discarded
(or whose score must be above every window).  How many components are worth a product depends on the vectors and is
tried on a few pairs now and then.  What is left is verified by its integer product, in slices of a bounded number of
bytes.  A task returns its best rows of each anchor, and a ranking of these few gives the result, so nothing is
approximate.  Tasks are no more than twice the cores, since each returns rows for every anchor.

The axes come from at most ``SAMPLE`` rows and ``SAMPLE_BYTES`` bytes, chosen by hash; they decide the speed only.

Defined results: rows whose id, label or vector is null, or whose vector has a null or non-finite component, take no
part; neither do empty vectors.  Vectors of different lengths have no score together.  Rows that repeat in id, label and
vector are one row; rows of one id that differ are rows of their own, in an order by a hash beyond that by id.  Scores
beyond the range of long are the ends of that range.  An anchor without positives, and a positive without negatives in its
window, give no rows, and so does an empty table.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import shared_path, written

SCALE = 256
#: Bytes of the anchors that meet the rows at once, and of the lists of their best rows.
ANCHOR_BYTES, LIST_BYTES = 8 << 20, 32 << 20
SAMPLE, SAMPLE_BYTES = 4096, 8 << 20
#: Leading components after which pairs are discarded.
STEPS = (8, 32, 64, 128)
#: Rows and entries of a matrix of partial products; components of the pairs that are verified at once.
ROWS, ENTRIES, VERIFIED = 1024, 1 << 21, 1 << 20
#: Found pairs that wait until lists are sorted again, if not as many as the lists hold; rows of a batch that goes back.
WAITING, BATCH = 1 << 17, 1 << 16
_EXACT = float(1 << 53)
_LONG = np.iinfo(np.int64)

FOUND = "a int, p int, id long, row long, score long"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def usable(rows: DataFrame, key: str, vector: str, label: Column, anchor: Column) -> DataFrame:
    """Distinct rows as (id, label, v, row, anchor): row is a hash that orders rows of one id, anchor says if any row of the id is one.

    Only rows whose id is repeated meet in an exchange.
    """
    v = F.col(vector).cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # floats stay floats, as doubles they would take twice the room
    kept = F.col(vector) if rows.schema[vector].dataType.simpleString() == "array<float>" else v
    every = rows.filter(F.col(key).isNotNull()).withColumns({"__id": F.col(key).cast("long"), "__anchor": F.coalesce(anchor, F.lit(False))})
    again = written(every.groupBy(F.col("__id").alias("id")).agg(F.count(F.lit(1)).alias("n"), F.max("__anchor").alias("anchor")).filter("n > 1").drop("n"), "repeated")
    found = every.filter(label.isNotNull() & (F.size(vector) > 0) & good)
    found = found.select(F.col("__id").alias("id"), label.cast("string").alias("label"), kept.alias("v"), F.col("__anchor").alias("anchor"))
    single = found.join(again, "id", "left_anti")
    several = found.drop("anchor").join(again, "id").select("id", "label", "v", "anchor").distinct()
    return single.unionByName(several).withColumn("row", F.xxhash64("label", F.col("v").cast("array<double>")))


def integers(column: pa.Array, n: int) -> np.ndarray:
    """floor(256 * x) of n vectors of one length, as doubles that are whole numbers."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(np.clip(flat * SCALE, -1e300, 1e300)).reshape(n, -1)


def products(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The exact inner product of each row of ``a`` with the same row of ``x``, within the range of long."""
    if not len(a) or a.shape[1] * np.abs(a).max() * np.abs(x).max() < _EXACT:
        return np.einsum("ij,ij->i", a, x).astype(np.int64)
    whole = [sum(int(p) * int(q) for p, q in zip(u, v)) for u, v in zip(a.tolist(), x.tolist())]
    return np.array([min(max(s, _LONG.min), _LONG.max) for s in whole], dtype=np.int64)


def axes(sample: np.ndarray) -> np.ndarray:
    """Orthonormal leading directions of the vectors, as columns."""
    _, found = np.linalg.eigh(sample.T @ sample)
    return np.ascontiguousarray(found[:, ::-1][:, : max(STEPS)])


@dataclass
class Turned:
    """Vectors of one length with their leading components and what is left beyond each step."""

    whole: np.ndarray
    lead: np.ndarray
    rest: list[np.ndarray]
    norm: np.ndarray
    ids: np.ndarray
    rows: np.ndarray
    labels: np.ndarray
    number: np.ndarray
    screens: dict = field(default_factory=dict)

    @classmethod
    def of(cls, whole, basis, ids, rows, labels, number) -> Turned:
        lead = whole @ basis
        square = np.einsum("ij,ij->i", whole, whole)
        part = np.cumsum(lead**2, axis=1)
        # above the true residual whatever the rounding
        rest = [np.sqrt(np.maximum(square - part[:, s - 1], 0) + 1e-12 * square) for s in steps(whole.shape[1])]
        return cls(whole, lead, rest, np.sqrt(square), ids, rows, labels, number)

    def screen(self, k: int) -> tuple[np.ndarray, float]:
        """Floats and a scale: the product of two such rows, times both scales, is above their score.

        They are the components up to step ``k``, what is left beyond it, and a share of the norm for the rounding of floats.
        """
        if k not in self.screens:
            s = steps(self.whole.shape[1])[k]
            scale = float(self.norm.max(initial=0)) or 1.0
            columns = (self.lead[:, :s], self.rest[k][:, None], np.sqrt(slack(s)) * self.norm[:, None])
            with np.errstate(all="ignore"):
                self.screens[k] = (np.concatenate(columns, axis=1) / scale).astype(np.float32), scale
        return self.screens[k]


def steps(length: int) -> list[int]:
    return [s for s in STEPS if s < length] + [length] * (length <= max(STEPS))


def slack(s: int) -> float:
    """Above the relative error of a product of s components in floats."""
    return (s + 10) * 2.0**-22


def basis_of(bases: dict[int, np.ndarray], length: int) -> np.ndarray:
    """The axes for a length; those of lengths that no sampled row has are the first coordinates."""
    return bases[length] if length in bases else np.eye(length, min(length, max(STEPS)))


def above(left: np.ndarray, right: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of a product of matrices that are not below its rows' bounds, and all of it, flat."""
    with np.errstate(all="ignore"):
        total = left @ right.T
        # what is not a number may be anything
        return np.flatnonzero(~(total < low[:, None])), total.ravel()


def scaled(bound: np.ndarray, *scales: float) -> np.ndarray:
    """Bounds of scores as bounds of products of screens; less a little, since the least floats are no numbers of full precision."""
    with np.errstate(all="ignore"):
        for scale in scales:
            bound = bound / scale
        return (bound - 1e-30).astype(np.float32)


def cheapest(a: Turned, x: Turned, need: np.ndarray) -> int:
    """The step after which pairs are best discarded: a longer product costs all pairs, and what a shorter one leaves is verified."""
    some = np.unique(np.linspace(0, len(a.ids) - 1, min(64, len(a.ids))).astype(int))
    length = a.whole.shape[1]
    cost = []
    for k, s in enumerate(steps(length)):
        (left, size), (right, other) = a.screen(k), x.screen(k)
        left = above(left[some], right, scaled(need[some], size, other))[0]
        # in products of one component by matrix, of which a verified pair costs some dozens for each component
        cost.append(s + 8 + (1000 + 40 * length) * len(left) / (len(some) * max(1, len(x.ids))))
    return int(np.argmin(cost))


def close(a: Turned, x: Turned, at: np.ndarray, who: np.ndarray, need: np.ndarray, most: np.ndarray, differ: bool, k: int | None = None) -> Iterator[tuple]:
    """(anchor, row, score) of pairs of anchors ``at`` and rows ``who`` that can have a score from need to most.

    Need and most are per anchor of ``at``.  With ``differ``, pairs of one label are left out.  Pairs are discarded after
    step ``k``, or the last one.
    """
    length = a.whole.shape[1]
    sizes = steps(length)
    k = len(sizes) - 1 if k is None else k
    if not len(at) or not len(who):
        return
    (left, size), (right, other) = a.screen(k), x.screen(k)
    right, low = right[who], scaled(need, size, other)
    chunk, pairs = max(1, ENTRIES // len(who)), max(1, VERIFIED // length)
    for c in range(0, len(at), chunk):
        part, high = at[c : c + chunk], most[c : c + chunk]
        places, total = above(left[part], right, low[c : c + chunk])
        for f in range(0, len(places), pairs):
            flat = places[f : f + pairs]
            i, j = np.divmod(flat, len(who))
            p, q = part[i], who[j]
            with np.errstate(all="ignore"):
                margin = a.rest[k][p] * x.rest[k][q] + slack(sizes[k]) * a.norm[p] * x.norm[q]
                least = (total[flat].astype(np.float64) - 1e-30) * size * other - 2 * margin
            keep = ~(least > high[i])
            if differ:
                keep &= a.labels[p] != x.labels[q]
            i, p, q = i[keep], p[keep], q[keep]
            if sizes[-1] < length and k < len(sizes) - 1:
                with np.errstate(all="ignore"):
                    sums = np.einsum("ij,ij->i", a.lead[p], x.lead[q])
                    margin = a.rest[-1][p] * x.rest[-1][q] + 1e-9 * a.norm[p] * x.norm[q]
                keep = ~((sums + margin < need[c : c + chunk][i]) | (sums - margin > high[i]))
                p, q = p[keep], q[keep]
            if len(p):
                yield p, q, products(a.whole[p], x.whole[q])


class Best:
    """The best ``size`` rows of each group: higher scores first, then smaller ids."""

    def __init__(self, groups: int, size: int):
        self.size, self.groups = size, groups
        self.kept = tuple(np.zeros(0, np.int64) for _ in range(4))
        self.new: list[tuple] = []
        self.waiting = 0
        self.least = np.full(groups, -np.inf)
        #: The last row of a full list: its score, and the id that an equal score must not be beyond.
        self.last, self.edge = np.full(groups, _LONG.min), np.full(groups, _LONG.max)

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        fits = (score > self.last[group]) | ((score == self.last[group]) & (ids <= self.edge[group]))
        if fits.any():
            self.new.append((group[fits], score[fits], ids[fits], rows[fits]))
            self.waiting += len(self.new[-1][0])
            # sorting costs as much as the lists are long
            if self.waiting > max(WAITING, len(self.kept[0])):
                self.settle()

    def batches(self) -> Iterator[dict[str, np.ndarray]]:
        self.settle()
        for k in range(0, len(self.kept[0]), BATCH):
            yield dict(zip(("group", "score", "id", "row"), (v[k : k + BATCH] for v in self.kept)))

    def settle(self) -> None:
        if not self.new:
            return
        group, score, ids, rows = (np.concatenate(x) for x in zip(self.kept, *self.new))
        # complements, since the least long has no negative
        order = np.lexsort((rows, ids, ~score, group))
        group, score, ids, rows = group[order], score[order], ids[order], rows[order]
        place = np.arange(len(group)) - np.searchsorted(group, group)
        last = place == self.size - 1
        self.least[group[last]] = self.last[group[last]] = score[last]
        self.edge[group[last]] = ids[last]
        self.kept = tuple(v[place < self.size] for v in (group, score, ids, rows))
        self.new, self.waiting = [], 0


class Block:
    """A block of anchors, by length, and their positives once they are known."""

    def __init__(self, table: pa.Table, bases: dict[int, np.ndarray]):
        self.bases = bases
        self.names = pc.unique(table.column("label").combine_chunks())
        self.count = table.num_rows
        self.ids = table.column("id").to_numpy()
        self.turned = {x.whole.shape[1]: x for x in self.turn(table)}

    def turn(self, table: pa.Table) -> Iterator[Turned]:
        """Rows by length; labels as numbers, -1 for those that no anchor has."""
        size = pc.list_value_length(table.column("v"))
        number = np.arange(table.num_rows)
        for n in pc.unique(size).to_pylist():
            at = pc.equal(size, n)
            part = table.filter(at).combine_chunks()
            labels = pc.fill_null(pc.index_in(part.column("label"), value_set=self.names), -1).to_numpy()
            whole = integers(part.column("v").combine_chunks(), part.num_rows)
            ids, rows = part.column("id").to_numpy(), part.column("row").to_numpy()
            yield Turned.of(whole, basis_of(self.bases, n), ids, rows, labels, number[at.to_numpy()])

    def pieces(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Turned, Turned, bool]]:
        """Anchors and rows of one length; whether it is time to look for the best step once more."""
        seen: dict[int, int] = {}
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for k in range(0, table.num_rows, ROWS):
                for x in self.turn(table.slice(k, ROWS)):
                    length = x.whole.shape[1]
                    if length in self.turned:
                        n = seen[length] = seen.get(length, 0) + 1
                        yield self.turned[length], x, not n & (n - 1) or n % 32 == 0

    def positives(self, batches: Iterator[pa.RecordBatch], size: int) -> Best:
        best, step = Best(self.count, size), {}
        for a, x, look in self.pieces(batches):
            if look:
                step[a.whole.shape[1]] = cheapest(a, x, best.least[a.number])
            for label in np.unique(x.labels[x.labels >= 0]).tolist():
                at, who = np.flatnonzero(a.labels == label), np.flatnonzero(x.labels == label)
                for i, j, score in close(a, x, at, who, best.least[a.number[at]], np.full(len(at), np.inf), False, step[a.whole.shape[1]]):
                    other = (a.ids[i] != x.ids[j]) | (a.rows[i] != x.rows[j])
                    i, j = i[other], j[other]
                    best.add(a.number[i], score[other], x.ids[j], x.rows[j])
        return best

    def negatives(self, batches: Iterator[pa.RecordBatch], chosen: np.ndarray, size: int, low: int, high: int) -> Best:
        """``chosen``: the scores of each anchor's positives, masked where it has fewer."""
        # hundred times a score beyond these is more than any window's edge
        edge = _LONG.max // max(200, 2 * abs(low), 2 * abs(high))
        wide = len(chosen.compressed()) and not -edge <= chosen.min() <= chosen.max() <= edge
        scores = chosen.astype(object) if wide else chosen
        best = Best(chosen.size, size)
        floor = np.ma.filled((low * scores).astype(float) / 100, np.inf)
        most = np.ma.filled((high * scores).astype(float) / 100, -np.inf).max(axis=1)
        # rounding of the two shares
        floor, most = floor - 1e-9 * np.abs(floor), most + 1e-9 * np.abs(most)
        # a window that nothing fits, where there is no positive
        bottom, top, step = np.ma.filled(low * scores, 1), np.ma.filled(high * scores, 0), {}
        for a, x, look in self.pieces(batches):
            need = np.maximum(floor, best.least.reshape(chosen.shape)).min(axis=1)
            if look:
                step[a.whole.shape[1]] = cheapest(a, x, need[a.number])
            at, who = np.arange(len(a.ids)), np.arange(len(x.ids))
            for i, j, score in close(a, x, at, who, need[a.number], most[a.number], True, step[a.whole.shape[1]]):
                anchor = a.number[i]
                hundred = 100 * (score.astype(object) if wide else np.clip(score, -_LONG.max // 100, _LONG.max // 100))
                for p in range(chosen.shape[1]):
                    inside = ((bottom[anchor, p] <= hundred) & (hundred <= top[anchor, p])).astype(bool)
                    best.add(anchor[inside] * chosen.shape[1] + p, score[inside], x.ids[j[inside]], x.rows[j[inside]])
        return best


def _blocks(anchors: DataFrame, bases: dict[int, np.ndarray], listed: int) -> Iterator[Block]:
    """Anchors in blocks of about ``ANCHOR_BYTES``, or fewer with lists of ``listed`` rows; dealt by a hash of the row."""
    total, n = anchors.agg(F.sum(F.size("v") + 8), F.count(F.lit(1))).first()
    count = max(-(-8 * (total or 0) // ANCHOR_BYTES), -(-32 * listed * n // LIST_BYTES))
    for k in range(count):
        # bounded: one block
        table = anchors.filter(F.pmod(F.xxhash64("id", "row"), F.lit(count)) == k).toArrow()
        if table.num_rows:
            yield Block(table.sort_by([("id", "ascending"), ("row", "ascending")]), bases)


def _bases(rows: DataFrame) -> dict[int, np.ndarray]:
    longest, n = rows.agg(F.max(F.size("v")), F.count(F.lit(1))).first()
    if longest is None:
        return {}
    # bounded in rows and bytes; it decides the speed only
    size = max(1, min(SAMPLE, SAMPLE_BYTES // (8 * longest)))
    some = rows.filter(F.pmod(F.xxhash64("id", "row"), F.lit(-(-n // (2 * size)))) == 0)
    sample = some.orderBy(F.xxhash64("id", "row"), "id", "row").limit(size).toArrow()
    size = pc.list_value_length(sample.column("v"))
    out = {}
    for n in pc.unique(size).to_pylist():
        part = sample.filter(pc.equal(size, n)).column("v").combine_chunks()
        found = integers(part, len(part))
        out[n] = axes(found / max(1.0, np.abs(found).max()))
    return out


def _ranked(found: DataFrame, group: list[str], size: int) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)


def hard_negatives(
    rows: DataFrame,
    anchor: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: Column | None = None,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), ranks from 1.

    ``anchor`` says by ``key`` which rows are anchors; a negative's score is from ``low`` to ``high`` percent of the
    positive's.
    """
    spark = rows.sparkSession
    found = written(usable(rows, key, vector, F.col("label") if label is None else label, anchor), "vectors")
    anchors = written(found.filter("anchor").drop("anchor"), "anchors")
    rows = found.drop("anchor")
    bases = _bases(rows)
    # every task returns rows for every anchor
    rows = rows.coalesce(2 * spark.sparkContext.defaultParallelism)
    folder, empty = shared_path(spark, "negatives"), True
    for block in _blocks(anchors, bases, positives * negatives):
        empty = False
        shared = spark.sparkContext.broadcast(block)

        def first(batches, shared=shared):
            for x in shared.value.positives(batches, positives).batches():
                yield pa.record_batch({"a": x["group"].astype(np.int32), "id": x["id"], "row": x["row"], "score": x["score"]})

        # bounded: a few rows for each anchor of the block
        chosen = _ranked(rows.mapInArrow(first, "a int, id long, row long, score long"), ["a"], positives).toArrow()
        a, p = chosen.column("a").to_numpy(), chosen.column("rank").to_numpy() - 1
        scores = np.ma.masked_all((block.count, positives), dtype=np.int64)
        names = np.zeros((block.count, positives), dtype=np.int64)
        scores[a, p], names[a, p] = chosen.column("score").to_numpy(), chosen.column("id").to_numpy()
        given = spark.sparkContext.broadcast((block.ids, scores, names))
        _second(rows, shared, given, (negatives, low, high)).write.mode("append").parquet(folder)
        shared.unpersist()
        given.unpersist()
    return spark.createDataFrame([], RESULT) if empty else spark.read.schema(RESULT).parquet(folder)


def _second(rows: DataFrame, shared, given, limits: tuple[int, int, int]) -> DataFrame:
    """The negatives of one block, ranked."""

    def second(batches):
        _, scores, _ = given.value
        for x in shared.value.negatives(batches, scores, *limits).batches():
            a, p = np.divmod(x["group"], scores.shape[1])
            yield pa.record_batch({"a": a.astype(np.int32), "p": p.astype(np.int32), "id": x["id"], "row": x["row"], "score": x["score"]})

    def named(batches):
        ids, scores, names = given.value
        for x in batches:
            a, p = x.column("a").to_numpy(), x.column("p").to_numpy()
            columns = (ids[a], names[a, p], x.column("rank"), x.column("id"), scores.data[a, p], x.column("score"))
            yield pa.record_batch([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], names=[c.split()[0] for c in RESULT.split(", ")])

    return _ranked(rows.mapInArrow(second, FOUND), ["a", "p"], limits[0]).mapInArrow(named, RESULT)
