"""Vectorised word handling over Arrow string columns.

A word is a maximal run of bytes outside ``20 09-0D`` (hex).  All functions work on the UTF-8 bytes of a whole
block of documents at once.  Inside a block words are told apart by their bytes (a dictionary encoding); between tasks
they are compared by their bytes, or by the 128-bit XXH3 digest of them (``KEY``), made once for each distinct word of
a block.  Runs of words are compared by polynomials of these digests over the prime field of 2**31 - 1, in two lanes
where the words are compared afterwards (62 bits) and in four where they are not (124 bits).
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

#: Blocks of documents are cut near this many bytes; a longer document is a block by itself.
BLOCK_BYTES = 1 << 20

#: A 128-bit digest as two words.
KEY = np.dtype([("a", "<u8"), ("b", "<u8")])

_PRIME = (1 << 31) - 1
#: A base for each lane of a polynomial.
_BASES = (1_103_515_245, 1_664_525_333, 1_566_083_941, 1_812_433_253)


@functools.cache
def _libc() -> ctypes.CDLL:
    return ctypes.CDLL(None)


def release_memory() -> None:
    """Gives memory back that earlier tasks of this reused worker no longer need (malloc_trim where libc has it)."""
    pa.default_memory_pool().release_unused()
    if hasattr(_libc(), "malloc_trim"):
        _libc().malloc_trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (two xor-shift-multiply rounds)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _reduced(x: np.ndarray) -> np.ndarray:
    """Values modulo the prime, by two folds and one subtraction."""
    prime, shift = np.uint64(_PRIME), np.uint64(31)
    x = (x & prime) + (x >> shift)
    x = (x & prime) + (x >> shift)
    return x - prime * (x >= prime)


class _Powers:
    """Powers of a base modulo the prime and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.bases = base, pow(base, -1, _PRIME)
        self.powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.powers[0]) < n:
            k = len(self.powers[0])
            self.powers = [np.concatenate([x, _reduced(x * np.uint64(pow(b, k, _PRIME)))]) for x, b in zip(self.powers, self.bases)]
        return self.powers[0], self.powers[1]


_powers = [_Powers(b) for b in _BASES]


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a string column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    body = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[at[0] : at[-1]], at - at[0]


def blocks(column: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive runs of rows of about ``limit`` bytes."""
    release_memory()
    data, at = buffers(column)
    first, n = 0, len(at) - 1
    while first < n:
        end = max(first + 1, int(np.searchsorted(at, at[first] + limit, side="right")) - 1)
        yield first, end, data[at[first] : at[end]], at[first : end + 1] - at[first]
        first = end


@dataclass
class Words:
    """Words of a block: byte spans, and for each document the index of its first word (one more at the end)."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    def document(self) -> np.ndarray:
        """Row of each word's document in the block."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def find_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words of each document; words never cross a document's end."""
    inside = ~SPACE[data]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[cuts] = inside[cuts]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[cuts - 1] = inside[cuts - 1]
    start = np.flatnonzero(begins)
    return Words(start, np.flatnonzero(ends) + 1, np.searchsorted(start, offsets))


def single_spaced(data: np.ndarray, words: Words) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words of a block one space apart, and their spans there."""
    length = words.end - words.start
    end = np.cumsum(length + 1) - 1
    start = end - length
    out = np.full(int(end[-1]) if len(end) else 0, 0x20, dtype=np.uint8)
    inside = np.zeros(len(data) + 1, dtype=np.int8)
    inside[words.start] += 1
    inside[words.end] -= 1
    target = np.ones(len(out), dtype=bool)
    target[end[:-1]] = False
    # words of neighbouring documents may touch, so a span's end can be another's start
    out[target] = data[np.cumsum(inside[:-1]).astype(bool)]
    return out.tobytes(), start, end


def as_binary(body: np.ndarray, length: np.ndarray) -> pa.Array:
    """Consecutive byte strings of the given lengths as an Arrow column."""
    at = np.zeros(len(length) + 1, dtype=np.int64)
    np.cumsum(length, out=at[1:])
    return pa.Array.from_buffers(pa.large_binary(), len(length), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(body))])


def byte_strings(column: pa.LargeBinaryArray) -> list[bytes]:
    """The values of a column without nulls, sliced from its buffer, several times faster than to_pylist."""
    _, offsets, data = column.buffers()
    if not len(column):
        return []
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    body, ends = data.to_pybytes() if data is not None else b"", at.tolist()
    return [body[i:j] for i, j in zip(ends, ends[1:])]


def distinct_words(data: np.ndarray, words: Words) -> tuple[np.ndarray, pa.Array]:
    """For each word the number of its bytes among the distinct words, and these in the order they come."""
    found = as_binary(data[~SPACE[data]], words.end - words.start).dictionary_encode()
    return found.indices.to_numpy(), found.dictionary


def digests(values: list[bytes]) -> np.ndarray:
    """The 128-bit digest of each byte string."""
    digest = xxhash.xxh3_128_digest
    return np.frombuffer(b"".join([digest(x) for x in values]), dtype=KEY)


def word_keys(data: np.ndarray, words: Words) -> np.ndarray:
    """The digest of each word of a block."""
    which, distinct = distinct_words(data, words)
    return digests(byte_strings(distinct))[which]


class WordSums:
    """Prefix sums over word digests: the key of any run of words in constant time."""

    def __init__(self, keys: np.ndarray, lanes: int = 2):
        self.size = len(keys)
        parts = keys.view("<u4").reshape(-1, 4)
        self.totals = []
        for lane in range(lanes):
            up, _ = _powers[lane](self.size + 1)
            total = np.zeros(self.size + 1, dtype=np.uint64)
            np.cumsum(_reduced(_reduced(parts[:, lane].astype(np.uint64)) * up[: self.size]), out=total[1:])
            self.totals.append(total)

    def _run(self, lane: int, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The polynomial of words first..end-1, as if the run began at index 0."""
        _, down = _powers[lane](self.size + 1)
        return _reduced(_reduced(self.totals[lane][end] - self.totals[lane][first]) * down[first])

    @staticmethod
    def _packed(high: np.ndarray, low: np.ndarray, length: np.ndarray) -> np.ndarray:
        return mix((high << np.uint64(32) | low) ^ mix(length.astype(np.uint64)))

    def runs(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A 64-bit key of each run of words; runs of different lengths differ."""
        return self._packed(self._run(0, first, end), self._run(1, first, end), end - first)

    def wide_runs(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A KEY of each run of words, for which the sums need four lanes."""
        out = np.empty(len(first), dtype=KEY)
        out["a"] = self.runs(first, end)
        out["b"] = self._packed(self._run(2, first, end), self._run(3, first, end), end - first)
        return out

    def without_one(self, first: np.ndarray, end: np.ndarray, at: np.ndarray) -> np.ndarray:
        """A 64-bit key of each run first..end-1 after word ``at`` of it (an absolute index) is left out."""
        lanes = []
        for lane in (0, 1):
            head, tail = self._run(lane, first, at), self._run(lane, at + 1, end)
            up, _ = _powers[lane](self.size + 1)
            lanes.append(_reduced(head + _reduced(tail * up[at - first])))
        return self._packed(*lanes, end - first - 1)


def windows(first: np.ndarray, length: int) -> np.ndarray:
    """Indices of words at which a window of ``length`` words of one document starts."""
    room = np.maximum(np.diff(first) - length + 1, 0)
    begin = np.repeat(first[:-1] - np.concatenate([[0], np.cumsum(room)[:-1]]), room)
    return begin + np.arange(room.sum())
