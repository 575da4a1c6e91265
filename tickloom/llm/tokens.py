"""Token ids of whole texts through the tokenizers library, each distinct chunk of a block encoded once.

A byte-level vocabulary splits a text before it merges, always where a non-space character is followed by white
space and where a letter is followed by punctuation.  Texts are cut there, into words and runs of punctuation.  Distinct
chunks are joined to long texts for the library; the number of bytes that each id stands for gives the ids back to
the chunks.  The ids are those of the whole text: cuts next to white space outside ASCII are left out, and the
first and last chunks of documents, which may lack white space on one side, are encoded by themselves.  Chunks are told
apart by their bytes, in a block by a dictionary encoding and between blocks in a dict.
"""

from __future__ import annotations

import functools
import re

import numpy as np

from .textbytes import SPACE, as_binary, byte_strings

END_ID = 2
#: Bytes of a block that is encoded at once.
BLOCK_BYTES = 1 << 20
#: Chunks that a worker keeps between blocks, and the most bytes of one; others are encoded again where they come.
KEPT_CHUNKS = 250_000
KEPT_BYTES = 32
_JOINED_BYTES = 1 << 15

#: Bytes before the last of a white-space character outside ASCII: C2, and the middle bytes 80, 81 and 9A.
_BEFORE_WIDE_SPACE = np.zeros(256, dtype=bool)
_BEFORE_WIDE_SPACE[[0xC2, 0x80, 0x81, 0x9A]] = True
#: ASCII letters, ASCII punctuation, and second bytes (after C3) of the Latin letters U+00C0 to U+00FF.
_LETTER = np.array([chr(i).isalpha() and i < 128 for i in range(256)])
_MARK = np.array([0x20 < i < 0x7F and not chr(i).isalnum() for i in range(256)])
_LATIN_SECOND = np.array([0x80 <= i < 0xC0 and i not in (0x97, 0xB7) for i in range(256)])
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[0x1C:0x20] = True


def chunk_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of chunks, and for each document the index of its first chunk (one more at the end)."""
    n = len(data)
    cut = SPACE[data]
    cut[1:] &= ~SPACE[data[:-1]] & ~_SEPARATOR[data[:-1]]
    cut[2:] &= ~((data[1:-1] >= 0x80) & _BEFORE_WIDE_SPACE[data[:-2]])
    cut[1:] |= _LETTER[data[:-1]] & _MARK[data[1:]]
    cut[2:] |= (data[:-2] == 0xC3) & _LATIN_SECOND[data[1:-1]] & _MARK[data[2:]]
    cut[offsets[offsets < n]] = True
    start = np.flatnonzero(cut)
    return start, np.searchsorted(start, offsets)


class Chunked:
    """Encodes blocks of documents by their chunks; keeps the ids of frequent chunks between blocks."""

    def __init__(self, size: int):
        self.size = size
        self.width = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.number: dict[bytes, int] = {}
        self.ids, self.lengths = np.zeros(0, self.width), np.zeros(0, np.int64)

    def _starts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raise NotImplementedError

    def _chunks(self, raw: bytes, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raise NotImplementedError

    def block(self, data: np.ndarray, offsets: np.ndarray, closed: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents of a block, each closed by END_ID (if so), and where each begins (one more at the end)."""
        start, first = self._starts(data, offsets)
        end = np.append(start[1:], len(data))
        found = as_binary(data, end - start).dictionary_encode()
        which, chunks = found.indices.to_numpy(), byte_strings(found.dictionary)
        number = np.array([self.number.get(x, -1) for x in chunks], dtype=np.int64)
        kept = len(self.lengths)
        new = np.flatnonzero(number < 0)
        number[new] = kept + np.arange(len(new))
        # where each distinct chunk is first
        example = np.zeros(len(chunks), dtype=np.int64)
        example[which[::-1]] = np.arange(len(which))[::-1]
        ids, lengths = self._chunks(data.tobytes(), start[example[new]], end[example[new]])
        # chunk numbers: the kept ones, the new ones, and one for the end of a document
        flat = np.concatenate([self.ids, ids, np.array([END_ID], dtype=self.width)])
        sizes = np.concatenate([self.lengths, lengths, [1]])
        at = np.concatenate([[0], np.cumsum(sizes)])
        order = np.insert(number[which], first[1:], kept + len(new)) if closed else number[which]
        result = gather(flat, at, order)
        bounds = np.concatenate([[0], np.cumsum(sizes[order])])
        starts = np.append(first[:-1] + np.arange(len(first) - 1), len(order)) if closed else first
        if kept + len(new) <= KEPT_CHUNKS and len(ids) <= KEPT_CHUNKS:
            self.number |= {chunks[i]: kept + k for k, i in enumerate(new.tolist()) if len(chunks[i]) <= KEPT_BYTES}
            self.ids, self.lengths = flat[:-1], sizes[:-1]
        return result, bounds[starts]


class Encoder(Chunked):
    """A byte-level vocabulary of the tokenizers library."""

    def __init__(self, vocabulary: str, plain_specials: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.encode_special_tokens = plain_specials
        added = self.tokenizer.get_added_tokens_decoder().values()
        apart = [x for x in added if not (plain_specials and x.special)]
        if any(x.lstrip or x.rstrip or x.single_word for x in apart):
            raise ValueError("added tokens that depend on what stands beside them")
        longest = sorted((x.content.encode() for x in apart), key=len, reverse=True)
        self.apart = re.compile(b"|".join(map(re.escape, longest))) if longest else None
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        super().__init__(max(vocab.values()) + 1)
        self.byte_length = np.zeros(self.size, dtype=np.int64)
        for token, i in vocab.items():
            self.byte_length[i] = len(token)

    def _starts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        edges, at = [], 0
        raw = data.tobytes() if self.apart else b""
        while self.apart and (found := self.apart.search(raw, at)):
            a, b = found.span()
            # a match may not run from one document into the next
            inside = np.searchsorted(offsets, a, "right") == np.searchsorted(offsets, b, "left")
            edges += [a, b] if inside else []
            at = b if inside else a + 1
        if not edges:
            return chunk_starts(data, offsets)
        start, _ = chunk_starts(data, np.union1d(offsets, edges).astype(np.int64))
        a, b = np.array(edges[::2]), np.array(edges[1::2])
        last = np.maximum(np.searchsorted(a, start, "right") - 1, 0)
        start = start[(start <= a[last]) | (start >= b[last])]
        return start, np.searchsorted(start, offsets)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype=self.width) for x in found]

    def _chunks(self, raw: bytes, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks one after another, and the number of ids of each."""
        joined = SPACE[np.frombuffer(raw, np.uint8)[start]]
        last = np.frombuffer(raw, np.uint8)[end - 1]
        joined &= ~SPACE[last] & (last < 0x80) & ~_SEPARATOR[last]
        order = np.concatenate([np.flatnonzero(joined), np.flatnonzero(~joined)])
        a, b = start[order], end[order]
        k = int(joined.sum())
        ids, lengths = [], np.zeros(len(order), dtype=np.int64)
        if k:
            pieces = [raw[i:j] for i, j in zip(a[:k].tolist(), b[:k].tolist())]
            ends = np.cumsum(b[:k] - a[:k])
            cuts = np.flatnonzero(np.diff(ends // _JOINED_BYTES)) + 1
            bounds = [0, *cuts.tolist(), k]
            texts = [b"".join(pieces[i:j]).decode() for i, j in zip(bounds, bounds[1:])]
            ids += self._encode(texts)
            through = np.cumsum(self.byte_length[np.concatenate(ids)])
            lengths[:k] = np.diff(np.searchsorted(through, ends, side="right"), prepend=0)
            if int(through[-1]) != int(ends[-1]):
                raise ValueError("the vocabulary is not byte-level")
        if k < len(order):
            alone = self._encode([raw[i:j].decode() for i, j in zip(a[k:].tolist(), b[k:].tolist())])
            ids += alone
            lengths[k:] = [len(x) for x in alone]
        flat = np.concatenate(ids) if ids else np.zeros(0, self.width)
        at = np.concatenate([[0], np.cumsum(lengths)])
        back = np.empty(len(order), dtype=np.int64)
        back[order] = np.arange(len(order))
        return gather(flat, at, back), lengths[back]


def gather(flat: np.ndarray, at: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The runs flat[at[i]:at[i+1]] for each i of ``order``, one after another."""
    length = (at[1:] - at[:-1])[order]
    end = np.cumsum(length)
    if not len(end) or not end[-1]:
        return flat[:0]
    index = np.repeat(at[order] - (end - length), length)
    index += np.arange(end[-1])
    return flat[index]


@functools.lru_cache(maxsize=2)
def encoder(vocabulary: str, plain_specials: bool = False) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    return Encoder(vocabulary, plain_specials)
