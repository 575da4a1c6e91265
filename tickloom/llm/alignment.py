"""Alignment of two tokenizers by byte-owner arrays.

A text with a space before it is encoded by a byte-level vocabulary (A), the text itself by a piece model that adds the
space (B); both give the same bytes.  ``np.repeat`` writes the index of its owner over every byte of each token, once
for A and once for B.  Where the pair of owners changes, a new overlap of an A and a B token begins: a link.  Where both
owners change at once the tokens are cut into groups.

Links of id pairs are counted over the corpus.  A task gathers documents into units of ``UNIT_BYTES`` of text, each
with a dictionary of its distinct pairs and their counts, whatever the number of partitions; a document keeps its links
as places in that dictionary.  The dictionaries alone are summed by pair and compared with the best count of the B id,
and the counts go back to the units, so that texts and links are never shuffled as rows and a pair that stands in every
document is one row a unit.

Defined results: null and empty texts, and texts whose bytes either tokenizer does not give back, have no tokens: zeros
and no groups.  Strings of special tokens are ordinary text.  Null and repeated ids stay, each row by itself; all rows
count.  Other columns are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written
from .textbytes import blocks
from .tokens import Chunked, Encoder, gather

UNIT_BYTES = 4 << 20
#: Pairs of one row of a dictionary.
ENTRIES = 1 << 16
#: Bits of a pair that the B id takes.
B_BITS = 24

_SPACE = 0x20
_MARK = "▁"
UNITS = "unit long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary, base long, pairs array<long>, counts array<long>"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
GROUPS = "doc_id long, a array<int>, b array<int>, a_ends array<int>, b_ends array<int>"


@dataclass
class Table:
    """The bytes of every id, one after another, and where each begins (one more at the end)."""

    flat: np.ndarray
    at: np.ndarray

    @classmethod
    def of(cls, values: list[bytes]) -> Table:
        at = np.zeros(len(values) + 1, dtype=np.int64)
        np.cumsum([len(x) for x in values], out=at[1:])
        return cls(np.frombuffer(b"".join(values), np.uint8), at)

    def lengths(self, ids: np.ndarray) -> np.ndarray:
        return (self.at[1:] - self.at[:-1])[ids]

    def bytes(self, ids: np.ndarray) -> np.ndarray:
        return gather(self.flat, self.at, ids)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else the next one from 256 on."""
    own = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class PieceEncoder(Chunked):
    """A piece model without normalization, by chunks that begin at a space.

    No piece has its space mark after another character, so no merge crosses from one chunk into the next.
    """

    def __init__(self, model: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=model)
        n = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(n)]
        if any(_MARK in p.lstrip(_MARK) for p in pieces):
            raise ValueError("pieces that run over a space")
        super().__init__(n)
        fallback = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(_MARK, " ").encode() for i, p in enumerate(pieces)]
        self.table = Table.of(fallback)
        self.space = self.model.piece_to_id(_MARK)

    def _starts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = data == _SPACE
        cut[1:] &= data[:-1] != _SPACE
        cut[offsets[offsets < len(data)]] = True
        start = np.flatnonzero(cut)
        return start, np.searchsorted(start, offsets)

    def _chunks(self, raw: bytes, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # the model puts back the space that every chunk begins with, but for an empty rest
        texts = [raw[i + 1 : j].decode() for i, j in zip(start.tolist(), end.tolist())]
        found = [x if t else [self.space] for t, x in zip(texts, self.model.encode(texts, num_threads=1))]
        lengths = np.array([len(x) for x in found], dtype=np.int64)
        flat = np.fromiter((i for x in found for i in x), dtype=self.width, count=int(lengths.sum()))
        return flat, lengths


class Pair:
    """Both tokenizers with their tables of bytes and of decimal ids."""

    def __init__(self, vocabulary: str, model: str):
        self.a = Encoder(vocabulary, plain_specials=True)
        self.b = PieceEncoder(model)
        letters = byte_letters()
        names = {i: t for t, i in self.a.tokenizer.get_vocab(with_added_tokens=True).items()}
        self.a_table = Table.of([bytes(letters.get(c, 0) for c in names.get(i, "")) for i in range(self.a.size)])
        # an id in decimal and what follows it: a comma, the end of a side, or nothing
        decimals = lambda n, end: Table.of([f"{i}{s}".encode() for i in range(n) for s in (",", end, "")])
        a, b = decimals(self.a.size, "|"), decimals(self.b.size, ";")
        self.shown = Table(np.concatenate([a.flat, b.flat]), np.concatenate([a.at, b.at[1:] + a.at[-1]]))


@functools.lru_cache(maxsize=2)
def pair(vocabulary: str, model: str) -> Pair:
    """The worker's two tokenizers."""
    return Pair(vocabulary, model)


def spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every document with a space before it."""
    return np.insert(data, offsets[:-1], _SPACE), offsets + np.arange(len(offsets))


def _same(table: Table, ids: np.ndarray, at: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Of which documents the tokens join to the bytes."""
    made = table.bytes(ids)
    if len(made) == len(data) and np.array_equal(made, data):
        ends = np.concatenate([[0], np.cumsum(table.lengths(ids))])[at]
        return np.diff(ends) == np.diff(offsets)
    ends = np.concatenate([[0], np.cumsum(table.lengths(ids))])[at]
    return np.array([np.array_equal(made[i:j], data[p:q]) for i, j, p, q in zip(ends, ends[1:], offsets, offsets[1:])])


def _kept(values: np.ndarray, at: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of values of good documents, the other ones empty."""
    sizes = np.where(good, np.diff(at), 0)
    return values[np.repeat(good, np.diff(at))], np.concatenate([[0], np.cumsum(sizes)])


class Aligned:
    """Tokens of a block of documents, their links and groups."""

    def __init__(self, both: Pair, data: np.ndarray, offsets: np.ndarray):
        data, offsets = spaced(data, offsets)
        self.both = both
        a, a_at = both.a.block(data, offsets, closed=False)
        b, b_at = both.b.block(data, offsets, closed=False)
        good = _same(both.a_table, a, a_at, data, offsets) & _same(both.b.table, b, b_at, data, offsets) & (np.diff(offsets) > 1)
        _, offsets = _kept(data, offsets, good)
        self.a, self.a_at = _kept(a, a_at, good)
        self.b, self.b_at = _kept(b, b_at, good)
        a_size, b_size = both.a_table.lengths(self.a), both.b.table.lengths(self.b)
        a_start, b_start = np.cumsum(a_size) - a_size, np.cumsum(b_size) - b_size
        a_owner = np.repeat(np.arange(len(self.a), dtype=np.int32), a_size)
        b_owner = np.repeat(np.arange(len(self.b), dtype=np.int32), b_size)
        a_new, b_new = (np.zeros(len(a_owner), dtype=bool) for _ in range(2))
        a_new[a_start], b_new[b_start] = True, True
        links, cuts = np.flatnonzero(a_new | b_new), np.flatnonzero(a_new & b_new)
        #: A and B id of every link, and for each document its first link and group (one more at the end)
        self.pairs = self.a[a_owner[links]].astype(np.int64) << B_BITS | self.b[b_owner[links]]
        self.link_at, self.cut_at = np.searchsorted(links, offsets), np.searchsorted(cuts, offsets)
        #: first A and B token of every group, one more at the end
        self.a_cut, self.b_cut = np.append(a_owner[cuts], len(self.a)), np.append(b_owner[cuts], len(self.b))

    def shown(self) -> tuple[bytes, list[int]]:
        """The groups of all documents as text, and where each document begins (one more at the end)."""
        groups = len(self.a_cut) - 1
        a_group = np.repeat(np.arange(groups), np.diff(self.a_cut))
        b_group = np.repeat(np.arange(groups), np.diff(self.b_cut))
        a_place = np.arange(len(self.a)) + self.b_cut[a_group]
        b_place = np.arange(len(self.b)) + self.a_cut[b_group + 1]
        a_end, b_end = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        a_end[self.a_cut[1:] - 1] = 1
        b_end[self.b_cut[1:] - 1] = 1
        last = self.b_at[1:][np.diff(self.b_at) > 0] - 1
        b_end[last] = 2
        order = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        order[a_place] = 3 * self.a.astype(np.int64) + a_end
        order[b_place] = 3 * (self.b.astype(np.int64) + self.both.a.size) + b_end
        ends = np.concatenate([[0], np.cumsum(self.both.shown.lengths(order))])
        return self.both.shown.bytes(order).tobytes(), ends[self.a_at + self.b_at].tolist()

    def digests(self) -> list[str]:
        text, at = self.shown()
        view = memoryview(text)
        return [hashlib.sha256(view[i:j]).hexdigest() if j > i else "" for i, j in zip(at, at[1:])]


def _pack(places: np.ndarray) -> bytes:
    """Places in a dictionary, low bytes together, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(places.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpack(packed: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel()


class Unit:
    """Documents whose links share a dictionary."""

    def __init__(self):
        self.documents: list[tuple] = []
        self.pairs: list[np.ndarray] = []
        self.size = 0

    def add(self, ids: list, found: Aligned, size: int) -> None:
        counts = [np.diff(x).tolist() for x in (found.a_at, found.b_at, found.cut_at, found.link_at)]
        self.documents += zip(ids, *counts, found.digests())
        self.pairs.append(found.pairs)
        self.size += size

    def rows(self) -> pa.Table:
        unit = uuid.uuid4().int >> 65
        pairs, places, counts = np.unique(np.concatenate(self.pairs), return_inverse=True, return_counts=True)
        # frequent pairs have small places
        order = np.argsort(-counts, kind="stable")
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        places, at, rows = back[places], 0, []
        for key, a, b, groups, links, digest in self.documents:
            rows.append({"unit": unit, "doc_id": key, "n_a": a, "n_b": b, "n_groups": groups, "n_links": links, "groups_sha256": digest, "links": _pack(places[at : at + links])})
            at += links
        for k in range(0, len(order), ENTRIES):
            some = order[k : k + ENTRIES]
            rows.append({"unit": unit, "base": k, "pairs": pairs[some], "counts": counts[some]})
        return pa.Table.from_pylist(rows, _UNIT_SCHEMA)


_LONG, _MANY = pa.int64(), pa.list_(pa.int64())
_UNIT_SCHEMA = pa.schema(
    [(c, _LONG) for c in ("unit", "doc_id", "n_a", "n_b", "n_groups", "n_links")]
    + [("groups_sha256", pa.string()), ("links", pa.binary()), ("base", _LONG), ("pairs", _MANY), ("counts", _MANY)]
)


def _documents(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def _aligned(batches: Iterator[pa.RecordBatch], both: Pair) -> Iterator[tuple[list, Aligned, int]]:
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        for first, end, data, offsets in blocks(batch.column("text")):
            yield ids[first:end], Aligned(both, data, offsets), len(data)


def groups(docs: DataFrame, vocabulary: str, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The tokens of each document by both tokenizers and, for each group, the end of its A and B tokens."""

    def work(batches):
        for ids, x, _ in _aligned(batches, pair(vocabulary, model)):
            lists = lambda v, at: pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(v, pa.int32()))
            ends = lambda cut, at: cut[1:] - np.repeat(at[:-1], np.diff(x.cut_at))  # noqa: B023, E731
            columns = [lists(x.a, x.a_at), lists(x.b, x.b_at), lists(ends(x.a_cut, x.a_at), x.cut_at), lists(ends(x.b_cut, x.b_at), x.cut_at)]
            yield pa.record_batch([pa.array(ids, pa.int64()), *columns], names=["doc_id", "a", "b", "a_ends", "b_ends"])

    return _documents(docs, key, text).mapInArrow(work, GROUPS)


def _units(docs: DataFrame, vocabulary: str, model: str) -> DataFrame:
    def work(batches):
        unit = Unit()
        for ids, found, size in _aligned(batches, pair(vocabulary, model)):
            unit.add(ids, found, size)
            if unit.size >= UNIT_BYTES:
                yield from unit.rows().to_batches()
                unit = Unit()
        if unit.documents:
            yield from unit.rows().to_batches()

    return docs.mapInArrow(work, UNITS)


def _entries(units: DataFrame) -> DataFrame:
    """One row for each pair of each unit: unit, place in its dictionary, pair and count."""
    every = units.filter(F.col("pairs").isNotNull()).select("unit", "base", F.posexplode(F.arrays_zip("pairs", "counts")))
    return every.select("unit", (F.col("base") + F.col("pos")).alias("place"), F.col("col.pairs").alias("pair"), F.col("col.counts").alias("n"))


def pair_counts(units: DataFrame) -> DataFrame:
    """(pair, total, best): how many links each id pair has, and whether no pair of its B id has more."""
    totals = _entries(units).groupBy("pair").agg(F.sum("n").alias("total")).withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << B_BITS) - 1)))
    # one row for each id of the piece model; Spark sends it to all if it is small
    top = totals.groupBy("b").agg(F.max("total").alias("top"))
    return totals.join(top, "b").select("pair", "total", (F.col("total") == F.col("top")).alias("best"))


def alignment(docs: DataFrame, vocabulary: str, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of tokens, groups and links of each document, its links to best partners, and its groups as a digest."""
    units = written(_units(_documents(docs, key, text), vocabulary, model), "aligned")
    looked = _entries(units).select("unit", "place", "pair").join(pair_counts(units), "pair").select("unit", "place", "total", "best")
    documents = units.filter(F.col("pairs").isNull()).withColumnRenamed("unit", "of").drop("base", "pairs", "counts")

    def finish(own: pa.Table, found: pa.Table) -> pa.Table:
        place = found.column("place").to_numpy()
        total, best = np.zeros((2, len(place)), dtype=np.int64)
        total[place], best[place] = found.column("total").to_numpy(), found.column("best").to_numpy().astype(np.int64)
        count, good = [], []
        for packed in own.column("links"):
            at = _unpack(packed.as_py())
            count.append(int(total[at].sum()))
            good.append(int(best[at].sum()))
        columns = {c: own.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
        return pa.table(columns | {"n_best": pa.array(good, pa.int64()), "count_sum": pa.array(count, pa.int64()), "groups_sha256": own.column("groups_sha256")})

    return documents.groupBy("of").cogroup(looked.groupBy("unit")).applyInArrow(finish, RESULT)
