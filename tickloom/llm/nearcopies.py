"""Near copies by the exact Jaccard similarity of five-word shingles: SimHash and sketches propose, sets decide.

A text is the set of its ``WIDTH``-word shingles (lower-cased A-Z, words one space apart; a shorter text is one
shingle).  Two texts are near copies if their sets have a Jaccard similarity of at least 0.8; texts without words are
copies of each other.  Components of near copies are named by the smallest number of a text in them.

Candidates are taken between distinct texts (told apart by their SHA-256), so exact copies, however many, count once.
A quick pass finds most links:

* SimHash: fingerprints at most ``RADIUS`` bits apart, as in simhash.  On ``WIDTH``-word shingles a pair at 0.8 is
  mostly 3 to 11 bits apart, which no affordable ball reaches, hence also
* sketches: ``BANDS`` keys of ``ROWS`` minima each, under multiplied shingle hashes.  All pairs of up to ``SMALL`` texts
  with the same key are candidates.  Where more texts share a key, each is paired with the smallest of all and with
  ``NEXT`` others in an order of that band, so that pairs grow with the texts alone.

An exact pass finds every link between texts that the quick pass left in different components.  In one order of all
shingles, two similar sets share one of their first n - ceil(0.8 n) + 1 shingles (n: the set's size).  All texts that
share such a key meet, those of one component excepted; a key with many texts meets in cells of ``CELL`` by ``CELL``.
At the first shingle that both have, what is left of the smaller rest bounds what they can share, so a pair is a
candidate only where that reaches the threshold; and of prefixes that are longer than need be for one shared shingle by
k, similar sets share k + 1.  The order puts shingles that are common in about ``SAMPLE`` texts last;
it decides how many candidates there are, not which links are found.

Every candidate pair is verified on its two sets.  In the quick pass each text is first verified against its smallest
candidate; then all pairs that are not yet in one component.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import components, written
from .simhash import linked, majority, shingle_hashes
from .textbytes import LOWER, blocks, find_words, mix, single_spaced

WIDTH = 5
RADIUS = 2
BANDS, ROWS = 16, 4
SMALL, NEXT = 16, 2
CELL = 256
#: The order of the shingles: about so many texts are looked at, and the most frequent with so many of them come last.
SAMPLE, OFTEN, MOST = 8192, 4, 1 << 16

_FACTORS = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)) | np.uint64(1)


def _documents(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, shingle hashes) of every text; no hashes without words."""
    for first, end, data, at in blocks(column):
        words = find_words(data, at)
        text, start, stop = single_spaced(LOWER[data], words)
        for i in range(end - first):
            a, b = words.first[i], words.first[i + 1]
            yield first + i, shingle_hashes(text, start[a:b], stop[a:b], WIDTH)


def _distinct_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, hashes in _documents(batch.column(0)):
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(hashes).view(np.int64))], ["shingle"])


def common_shingles(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles, in order, that several of about SAMPLE texts have, and how many have them; bounded by MOST."""
    step = max(1, rows.count() // SAMPLE)
    some = rows.filter(F.pmod(F.xxhash64("text"), F.lit(step)) == 0).select("text").distinct()
    counts = some.mapInArrow(_distinct_shingles, "shingle long").groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    most = counts.filter(F.col("n") >= OFTEN).orderBy(F.desc("n"), "shingle").limit(MOST).collect()
    shingle, n = np.array([r["shingle"] for r in most], np.int64).view(np.uint64), np.array([r["n"] for r in most], np.int64)
    order = np.argsort(shingle)
    return shingle[order], n[order]


def _prefix(shingles: np.ndarray, common: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first shingles of a set, in the order of all, of which similar sets share one; texts without words share 0."""
    n = len(shingles)
    if not n:
        return np.zeros(1, np.uint64)
    at = np.searchsorted(common, shingles)
    known = at < len(common)
    known[known] = common[at[known]] == shingles[known]
    if known.any():
        rank = np.zeros(n, np.int64)
        rank[known] = counts[at[known]]
        shingles = shingles[np.lexsort((shingles, rank))]
    return shingles[: n - (4 * n + 4) // 5 + 1]


def _lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)])
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.concatenate([np.zeros(0, np.uint64), *values]).view(np.int64)))


def _sketch(batches: Iterator[pa.RecordBatch], common: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints, sizes = np.zeros(batch.num_rows, dtype=np.uint64), np.zeros(batch.num_rows, dtype=np.int32)
        bands, prefixes = np.zeros((batch.num_rows, BANDS), dtype=np.uint64), []
        for row, hashes in _documents(batch.column(1)):
            shingles = np.unique(hashes)
            sizes[row] = len(shingles)
            prefixes.append(_prefix(shingles, common, counts))
            if len(hashes):
                prints[row] = majority(hashes)
                least = np.full(BANDS * ROWS, ~np.uint64(0))
                for i in range(0, len(shingles), 1 << 12):
                    np.minimum(least, (shingles[i : i + (1 << 12), None] * _FACTORS).min(0), out=least)
                for part in least.reshape(BANDS, ROWS).T:
                    bands[row] = mix(bands[row] + part)
        columns = [batch.column(0), pa.array(prints.view(np.int64)), _lists(list(bands)), pa.array(sizes), _lists(prefixes)]
        yield pa.RecordBatch.from_arrays(columns, ["digest", "print", "bands", "size", "prefix"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [np.unique(h).tobytes() for _, h in _documents(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["node", "shingles"])


def similar(a: bytes, b: bytes) -> bool:
    """Whether two sets, as sorted hashes, have a Jaccard similarity of at least 4/5."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if 5 * min(len(x), len(y)) < 4 * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 5 * both >= 4 * (len(x) + len(y) - both)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = [similar(a.as_py(), b.as_py()) for a, b in zip(batch.column(2), batch.column(3))]
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def digest_of(text: str) -> Column:
    """The SHA-256 that stands for a text; null counts as empty."""
    return F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256)


def candidates(sketches: DataFrame) -> DataFrame:
    """Distinct pairs (a, b), a > b, of nodes that may be near copies; ``sketches`` has one row for each node."""
    least = sketches.groupBy("print").agg(F.min("node").alias("least"))
    named = [least.select(F.col("print").alias(x), F.col("least").alias(f"n{x}")) for x in "ab"]
    ball = linked(sketches, RADIUS).join(named[0], "a").join(named[1], "b").select(F.col("na").alias("x"), F.col("nb").alias("y"))
    same = sketches.join(least, "print").select(F.col("node").alias("x"), F.col("least").alias("y"))
    members = sketches.select("node", F.posexplode("bands").alias("band", "key"))
    sizes = members.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("least")).filter("n > 1")
    met = members.join(written(sizes, "bands"), ["band", "key"])
    # texts beyond SMALL meet in parts, so that no key has to meet in one task
    part = F.when(F.col("n") > SMALL, F.pmod(F.xxhash64("node", "band"), F.ceil(F.col("n") / SMALL))).otherwise(F.lit(0))
    before = Window.partitionBy("band", "key", "part").orderBy(F.xxhash64("node", "band"), "node").rowsBetween(1 - SMALL, -1)
    met = met.withColumn("part", part).withColumn("others", F.collect_list("node").over(before))
    few = F.when(F.size("others") > NEXT, F.slice("others", -NEXT, NEXT)).otherwise(F.col("others"))
    others = F.when(F.col("n") > SMALL, F.array_append(few, F.col("least"))).otherwise(F.col("others"))
    band = met.select(F.col("node").alias("x"), F.explode(others).alias("y"))
    pairs = ball.union(same).union(band).filter("x != y")
    return pairs.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()


def remaining(sketches: DataFrame, groups: DataFrame) -> DataFrame:
    """Distinct pairs (a, b), a > b, with every link between nodes of different ``groups`` (node, component)."""
    named = sketches.join(groups, "node", "left").select("node", F.coalesce("component", "node").alias("of"), "size", F.posexplode("prefix").alias("at", "key"))
    members = named.select("key", "node", "of", "size", (F.col("size") - F.col("at")).alias("rest"))
    keys = members.groupBy("key").agg(F.min("of").alias("lo"), F.max("of").alias("hi")).filter("lo < hi")
    met = written(members.join(written(keys.select("key"), "keys"), "key"), "met")
    sizes = written(met.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "sizes")
    # any two nodes of a key meet in the cell of their parts, once as (a, b) and once as (b, a)
    parts = F.ceil(F.col("n") / CELL)
    part, every = F.pmod(F.xxhash64("node"), parts), F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))
    sides = [
        met.join(sizes, "key").select("key", own.alias("i"), other.alias("j"), *[F.col(c).alias(f"{c}_{x}") for c in ("node", "of", "size", "rest")])
        for x, own, other in (("a", part, every), ("b", every, part))
    ]
    pairs = sides[0].join(sides[1], ["key", "i", "j"]).filter("node_a > node_b AND of_a != of_b")
    # what sets of these sizes share at the least, if they are similar
    least = F.floor((4 * (F.col("size_a") + F.col("size_b")) + 8) / 9)
    pairs = pairs.filter(F.least("rest_a", "rest_b") >= least)
    pairs = written(pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"), "size_a", "size_b").distinct(), "met")
    beyond = F.least(*[1 - F.floor((4 * F.col(f"size_{x}") + 4) / 5) for x in "ab"]) + least
    # one row for each node, bounded by its own prefix, so that the join makes no more rows than there are pairs
    keys = met.groupBy("node").agg(F.collect_list("key").alias("keys"))
    keys = [keys.select(F.col("node").alias(x), F.col("keys").alias(f"keys_{x}")) for x in "ab"]
    shared = F.size(F.array_intersect("keys_a", "keys_b"))
    return pairs.join(keys[0], "a").join(keys[1], "b").filter(shared >= beyond).select("a", "b")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose sets are similar."""
    left, right = (sets.select(F.col("node").alias(x), F.col("shingles").alias(f"s{x}")) for x in "ab")
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb")
    return both.mapInArrow(_verify, "a long, b long")


def _nodes(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()


def near_copies(docs: DataFrame, text: str = "text") -> DataFrame:
    """(digest, component) for every text that has a near copy other than itself.

    Texts are told apart by their digests and numbered when their sketches are written; component is the smallest number.
    """
    rows = docs.select(digest_of(text).alias("digest"), F.col(text).cast("string").alias("text"))
    common, counts = common_shingles(rows)
    sketch = functools.partial(_sketch, common=common, counts=counts)
    sketches = written(rows.mapInArrow(sketch, "digest string, print long, bands array<long>, size int, prefix array<long>"), "sketches")
    sketches = written(sketches.dropDuplicates(["digest"]).withColumn("node", F.monotonically_increasing_id()), "nodes")
    pairs = written(candidates(sketches), "pairs")
    asked = sketches.select("digest", "node").join(_nodes(pairs), "node")
    sets = rows.dropDuplicates(["digest"]).join(asked, "digest").select("node", "text")
    sets = written(sets.mapInArrow(_sets, "node long, shingles binary"), "sets")
    first = written(verified(pairs.groupBy("a").agg(F.min("b").alias("b")), sets), "near")
    groups = written(components(first), "groups")
    named = [groups.select(F.col("node").alias(x), F.col("component").alias(f"c{x}")) for x in "ab"]
    left = pairs.join(named[0], "a", "left").join(named[1], "b", "left")
    left = left.filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")
    links = written(first.union(verified(left, sets)), "near")
    groups = written(components(links), "groups")
    # what the quick pass may have missed
    more = written(remaining(sketches, groups).join(pairs, ["a", "b"], "left_anti"), "remaining")
    asked = written(sketches.select("digest", "node").join(_nodes(more), "node"), "asked")
    texts = rows.join(asked, "digest").dropDuplicates(["digest"]).select("node", "text")
    missed = written(verified(more, written(texts.mapInArrow(_sets, "node long, shingles binary"), "sets")), "missed")
    # a missed link joins two components; where there is none, those found stand
    if not missed.isEmpty():
        groups = components(links.union(missed))
    return groups.join(sketches.select("digest", "node"), "node").select("digest", "component")


def drop_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row with the smallest id, null ids last.

    Where that id has several rows in the component, the one with the smallest digest of its text stays.
    """
    tagged = docs.withColumn("__node", digest_of(text)).withColumn("__none", F.col(key).isNull()).withColumn("__id", F.coalesce(F.col(key).cast("long"), F.lit(0)))
    groups = written(near_copies(docs, text), "components").withColumnRenamed("digest", "__node")
    rows = tagged.select("__node", "__none", "__id").distinct().join(groups, "__node", "left")
    rows = rows.withColumn("component", F.coalesce(F.col("component").cast("string"), "__node"))
    best = rows.groupBy("component").agg(F.min(F.struct("__none", "__id", "__node")).alias("best"))
    kept = written(best.select("best.__node", "best.__none", "best.__id"), "kept")
    of = ["__node", "__none", "__id"]
    return tagged.dropDuplicates(of).join(kept, of, "left_semi").select(*docs.columns)
