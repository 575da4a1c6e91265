"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprint: texts are lower-cased (A-Z only) and cut into words; each 3-word shingle, repeats included, is joined by
single spaces and hashed with XXH64 (seed 42); a bit is set if it is set in over half the hashes.  Shingle width and
radius are parameters; 3 words and two bits are what they are without.

Links: fingerprints at most two bits apart.  Every distinct fingerprint emits itself and its 64 one-bit neighbours,
all variants within half the radius.  Two fingerprints link exactly if they share a variant, and no variant can be
emitted by more than 65 distinct fingerprints, so copies of a text, however many, count once and no group is large.
(A radius of four has 2081 variants for each.)
Fingerprints sharing a variant are chained in order, which joins the same components as all their pairs; each chained
pair is verified by its bit distance and pairs found through several variants are kept once.

Defined results: null and empty texts, and texts without words, have fingerprint zero and link like any other;
texts of one or two words use the whole word sequence as their single shingle; a null id is kept as a document of
its own row but never names a component unless its whole component has null ids; repeated rows are returned as
often as they come; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import components, spread_join, written
from .textbytes import LOWER, blocks, find_words, single_spaced

SHINGLE_WORDS = 3
RADIUS = 2
SEED = 42


def shingle_hashes(text: bytes, start: np.ndarray, end: np.ndarray, width: int = SHINGLE_WORDS) -> np.ndarray:
    """XXH64 of each shingle of one document, whose words are already one space apart in ``text``."""
    digest = xxhash.xxh64_intdigest
    n = len(start)
    if not n:
        return np.zeros(0, np.uint64)
    if n < width:
        return np.array([digest(text[start[0] : end[-1]], SEED)], dtype=np.uint64)
    a, b = start[: n - width + 1].tolist(), end[width - 1 :].tolist()
    return np.array([digest(text[i:j], SEED) for i, j in zip(a, b)], dtype=np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The 64-bit number of bits that over half of the hashes have."""
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i : i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int((2 * counts > len(hashes)).astype(np.uint64) @ (np.uint64(1) << np.arange(64, dtype=np.uint64)))


def _fingerprints(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.zeros(batch.num_rows, dtype=np.uint64)
        for first, end, data, at in blocks(batch.column(1)):
            words = find_words(data, at)
            text, start, stop = single_spaced(LOWER[data], words)
            for i in range(end - first):
                a, b = words.first[i], words.first[i + 1]
                if b > a:
                    prints[first + i] = majority(shingle_hashes(text, start[a:b], stop[a:b], width))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], ["doc_id", "print"])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, print): the fingerprint as a signed long."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(functools.partial(_fingerprints, width=width), "doc_id long, print long")


def linked(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column print) that join the components of the link relation."""
    if radius % 2:
        raise ValueError("the radius must be even: both sides emit the variants within half of it")
    distinct = prints.select("print").distinct()
    flips = [sum(1 << i for i in at) for n in range(radius // 2 + 1) for at in combinations(range(64), n)]
    bits = F.array(*[F.lit(x if x < 1 << 63 else x - (1 << 64)).cast("long") for x in flips])
    emitted = distinct.select("print", F.explode(F.transform(bits, lambda x: F.col("print").bitwiseXOR(x))).alias("variant"))
    before = F.lag("print").over(Window.partitionBy("variant").orderBy("print"))
    pairs = emitted.select(F.col("print").alias("a"), before.alias("b")).filter(F.col("b").isNotNull())
    return pairs.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every document; component_id is the smallest doc_id reachable."""
    prints = written(fingerprints(docs, key, text, width), "prints")
    groups = components(linked(prints, radius)).withColumnRenamed("node", "print").withColumnRenamed("component", "root")
    smallest = prints.groupBy("print").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    # one row per distinct fingerprint from here: copies of a text have met already
    named = written(smallest.join(groups, "print", "left").withColumn("root", F.coalesce("root", "print")), "named")
    roots = named.groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("n"))
    ids = written(spread_join(named.withColumnRenamed("n", "copies"), written(roots, "roots"), "root", F.col("print"), named.count()), "classes")
    ids = ids.select("print", "component_id", F.col("copies").alias("n"))
    hexed = F.lower(F.lpad(F.hex("print"), 16, "0"))
    # a text's copies may be a third of all rows
    return spread_join(prints, ids, "print", F.col("doc_id"), prints.count()).select("doc_id", hexed.alias("fingerprint"), "component_id")
