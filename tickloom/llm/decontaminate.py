"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared in a normal form: ASCII letters and the Latin letters U+00C0 to U+00DE lower-cased, every run of
other ASCII characters than letters and digits made one space.  A document contains a test item if some stretch of
its normal form is within the item's error budget, ``ERROR_RATE`` of the item's length in bytes, of the item's.

An item with a budget of k edits is split into k + 1 pieces; k edits leave at least one piece untouched, so every
match shows as an exact hit of a piece.  Hits of all pieces are found in one pass by an Aho-Corasick automaton.  Around
each hit the item is verified by Myers' bit-parallel edit distance, on the union of the places its hits point to.

An item too short for any edit is found where its own words stand whole, one after another.

The test items are a stated query set: they are taken in blocks of at most ``BLOCK_BYTES``, one after another, and a
block's pieces go to all tasks.  With several blocks each one's result is written before the next block is read, so that
driver and tasks hold one block, whatever the size of the set.  What a block leaves behind is matches, or, where documents
are to go, SHA-256 digests of the texts that match: the documents themselves move once, after the last block.

Defined results: null and empty texts contain nothing; null items and items whose normal form is empty match nothing;
equal items with different ids all match; repeated documents match each for
itself; a null document id keeps its row; other columns are ignored; an empty table on either side gives no matches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import spread_join, written
from .textbytes import LOWER, blocks

ERROR_RATE = 0.06
BLOCK_BYTES = 4 << 20

_KEEP = np.array([i >= 0x80 or chr(i).isalnum() for i in range(256)])
_FOLD = np.where(_KEEP, LOWER, 0x20).astype(np.uint8)
_LATIN_CAPITAL = np.array([0x80 <= i <= 0x9E and i != 0x97 for i in range(256)])


def normal(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normal forms of the documents of a block, and their offsets; spaces at their ends are left out."""
    if not len(data):
        return data, offsets
    out = _FOLD[data]
    out[1:] += 0x20 * ((data[:-1] == 0xC3) & _LATIN_CAPITAL[data[1:]]).astype(np.uint8)
    space = out == 0x20
    begins = offsets[:-1][np.diff(offsets) > 0]
    ends = offsets[1:][np.diff(offsets) > 0] - 1
    drop = np.zeros(len(out), dtype=bool)
    drop[1:] = space[1:] & space[:-1]
    drop[begins] = space[begins]
    kept = np.concatenate([[0], np.cumsum(~drop)])
    out = out[~drop]
    at = kept[offsets]
    # at most one space is left at a document's end
    last = at[1:][np.diff(at) > 0] - 1
    trailing = last[out[last] == 0x20]
    if len(trailing):
        at = at - np.searchsorted(trailing, at)
        out = np.delete(out, trailing)
    return out, at


def normal_text(text: str | None) -> str:
    """The normal form of one text, a character for each byte."""
    data = np.frombuffer((text or "").encode(), dtype=np.uint8)
    return normal(data, np.array([0, len(data)]))[0].tobytes().decode("latin-1")


def masks(pattern: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << i
    return out


def best_distance(pattern_masks: dict[str, int], m: int, text: str) -> int:
    """Smallest edit distance of the pattern to any stretch of ``text`` (Myers, one big integer per column)."""
    full, high = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best = score
    get = pattern_masks.get
    for c in text:
        eq = get(c, 0)
        diagonal = (((eq & plus) + plus) ^ plus) | eq | minus
        up = minus | ~(diagonal | plus) & full
        down = plus & diagonal
        if up & high:
            score += 1
        elif down & high:
            score -= 1
            if score < best:
                best = score
        up = up << 1 & full
        down = down << 1 & full
        plus = down | ~((eq | minus) | up) & full
        minus = up & (eq | minus)
    return best


class Matcher:
    """Finds the items of a block in documents."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        import ahocorasick

        self.items = []
        places: dict[str, list[tuple[int, int]]] = {}
        for key, text in items:
            pattern = normal_text(text)
            m = len(pattern)
            if not m:
                continue
            budget = int(rate * m)
            cuts = [m * j // (budget + 1) for j in range(budget + 2)]
            for a, b in zip(cuts, cuts[1:]):
                places.setdefault(pattern[a:b], []).append((len(self.items), a))
            self.items.append((key, masks(pattern), m, budget))
        self.automaton = ahocorasick.Automaton()
        for piece, found in places.items():
            self.automaton.add_word(piece, (len(piece), found))
        self.automaton.make_automaton()

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int]]:
        """(row, item id, distance) for the documents of a block."""
        if not self.items or not len(data):
            return []
        form, at = normal(data, offsets)
        text = form.tobytes().decode("latin-1")
        bounds = at.tolist()
        guesses: dict[tuple[int, int], set[int]] = {}
        ends, hits = [], []
        for end, hit in self.automaton.iter(text):
            ends.append(end)
            hits.append(hit)
        rows = (np.searchsorted(at, np.array(ends, dtype=np.int64), side="right") - 1).tolist()
        for end, row, (size, found) in zip(ends, rows, hits):
            begin = end - size + 1
            if begin >= bounds[row]:  # else it crosses from one document to the next
                whole = (begin == bounds[row] or text[begin - 1] == " ") and (end + 1 == bounds[row + 1] or text[end + 1] == " ")
                for item, offset in found:
                    if whole or self.items[item][3]:
                        guesses.setdefault((row, item), set()).add(begin - offset)
        out = []
        for (row, item), starts in guesses.items():
            key, pattern_masks, m, budget = self.items[item]
            best, limit = budget + 1, bounds[row + 1]
            lo = hi = None
            for s in sorted(starts) + [None]:
                if lo is not None and (s is None or s - budget > hi):
                    best = min(best, best_distance(pattern_masks, m, text[lo:hi]))
                    lo = None
                if s is not None:
                    lo = max(bounds[row], s - budget) if lo is None else lo
                    hi = min(limit, s + m + budget)
            if best <= budget:
                out.append((row, key, best))
        return out


def _item_blocks(benchmark: DataFrame, key: str, text: str) -> Iterator[tuple[bool, list[tuple[int, str]]]]:
    """(whether there are several, (key, text) of the items) of each block."""
    items = benchmark.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text")).filter("text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    count = 1 + 2 * size // BLOCK_BYTES
    for i in range(count):
        part = items.filter(F.pmod(F.xxhash64("key", "text"), F.lit(count)) == i)
        yield count > 1, [(r.key, r.text) for r in part.collect()]  # about half of BLOCK_BYTES


def _matchers(benchmark: DataFrame, rate: float, key: str, text: str) -> Iterator[tuple[bool, Callable[[], Matcher]]]:
    for several, items in _item_blocks(benchmark, key, text):
        kept: list[Matcher] = []

        def matcher(items=items, kept=kept) -> Matcher:
            if not kept:
                kept.append(Matcher(items, rate))
            return kept[0]

        yield several, matcher


def matches(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, distance) for each document and each item that it contains."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    out = None
    for several, matcher in _matchers(benchmark, rate, item_key, item_text):

        def find(batches: Iterator[pa.RecordBatch], matcher=matcher) -> Iterator[pa.RecordBatch]:
            found = matcher()
            for batch in batches:
                hits = [(first + r, i, d) for first, _, data, at in blocks(batch.column(1)) for r, i, d in found(data, at)]
                row, item, distance = ([x[k] for x in hits] for k in range(3))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row, pa.int64())), pa.array(item, pa.int64()), pa.array(distance, pa.int32())],
                    ["doc_id", "item_id", "distance"],
                )

        part = rows.mapInArrow(find, "doc_id long, item_id long, distance int")
        part = written(part, "matches") if several else part
        out = part if out is None else out.unionByName(part)
    return out


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents that contain no item, with all their columns."""
    place = docs.columns.index(text)
    found = None
    for several, matcher in _matchers(benchmark, rate, item_key, item_text):

        def keep(batches: Iterator[pa.RecordBatch], matcher=matcher) -> Iterator[pa.RecordBatch]:
            find = matcher()
            for batch in batches:
                good = np.ones(batch.num_rows, dtype=bool)
                for first, _, data, at in blocks(batch.column(place)):
                    good[[first + r for r, _, _ in find(data, at)]] = False
                yield batch.filter(pa.array(good))

        def digests(batches: Iterator[pa.RecordBatch], matcher=matcher) -> Iterator[pa.RecordBatch]:
            find = matcher()
            for batch in batches:
                out = []
                for _, _, data, at in blocks(batch.column(0)):
                    out += [hashlib.sha256(data[at[r] : at[r + 1]]).digest() for r in {r for r, _, _ in find(data, at)}]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["__digest"])

        if not several:
            return docs.mapInArrow(keep, docs.schema)
        part = written(docs.select(text).mapInArrow(digests, "__digest binary").groupBy("__digest").agg(F.count(F.lit(1)).alias("n")), "contaminated")
        found = part if found is None else found.unionByName(part)
    # a text that many rows share is in each block's count with all of them
    texts = written(found.groupBy("__digest").agg(F.max("n").alias("n")), "contaminated")
    rows = docs.withColumn("__digest", F.unhex(F.sha2(F.col(text).cast("binary"), 256)))
    # rows of one text spread by their other columns
    salt = F.xxhash64(*[c for c, kind in docs.dtypes if c != text and not kind.startswith(("map", "struct", "array", "variant"))], F.lit(0))
    return spread_join(rows, texts, "__digest", salt, docs.count(), "left_anti").select(*docs.columns)
