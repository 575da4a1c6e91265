"""Line dedup by a deletion-neighbourhood join: lines within one word edit of an earlier line are removed.

A line is its sequence of words; white space does not count and blank lines are never compared.  Two lines match if
their words are at most ``edits`` insertions, deletions and replacements of a word apart, and these at most a share of
1 - ``similarity`` of the longer line's words (at 0.8, one edit from five words on).  A line is removed if an
earlier line (smaller document id, or same document and smaller line number) matches it; lines are judged on the input.
The bound is 0 or 1: the variants of two edits grow with the square of a line's words.

Equal lines are found by the 128-bit digest of their words.  For near matching every line emits all variants within
the edit bound: itself and the line without each of its words, as 64-bit keys with the place of the deletion.  Equal
variants are joined.  Lines of equal length can match if they agree after deleting the same place, a line can match a
longer one if it equals one of the longer's variants.  Of each set that agrees the earliest is known by a minimum, so
no pairs are made of lines that agree: each later line gets the words of the earliest, and the edit distance is
verified on the words of both.

Before that, a cheap and lossless filter: one edit leaves the first or the second half of the words untouched, so
only lines that share a half with a different line emit their deletion variants.

Defined results: a null text stays null and an empty one empty, both with no lines compared; documents with equal
ids are ordered by a hash of the text and null ids come last; repeated rows count as copies, whose lines are removed;
columns of the input are kept as they are but for the text; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import units
from .textbytes import KEY, Words, WordSums, digests, find_words, mix, single_spaced, word_keys

EXACT, HALF, VARIANT, WORDS = 0, 1, 2, 3
NO_LINE = np.uint64(0)
#: Beside a variant: the index of its line among all lines of the unit, and the place of the deletion (-1: none).
_BESIDE = np.dtype([("line", "<i4"), ("place", "<i4")])
#: What a unit is asked for: the words of ``line`` for the later line ``other`` of ``unit``.
_FETCH = np.dtype([("unit", "<i4"), ("other", "<i4"), ("line", "<i4")])
_PAIR = np.dtype([("line", "<i4"), ("text", "<i4")])


class _Lines:
    """The lines of a block of documents."""

    def __init__(self, first: int, data: np.ndarray, offsets: np.ndarray):
        breaks = np.flatnonzero(data == 0x0A)
        # a line starts at each document's start and after each break; empty documents have one empty line
        start = np.concatenate([offsets[:-1], breaks + 1])
        row = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, breaks, side="right") - 1])
        order = np.lexsort((start, row))
        self.start, self.row = start[order], row[order]
        last = np.append(self.row[1:] != self.row[:-1], True)
        follows = np.append(self.start[1:] - 1, 0)
        self.end = np.where(last, offsets[self.row + 1], follows)
        self.data = data
        self.document = first + self.row
        begin = np.searchsorted(self.row, self.row)
        self.number = np.arange(len(self.row)) - begin

    def __len__(self) -> int:
        return len(self.start)

    @functools.cached_property
    def spans(self) -> Words:
        return find_words(self.data, np.append(self.start, len(self.data)))

    @property
    def first(self) -> np.ndarray:
        return self.spans.first[:-1]

    @property
    def stop(self) -> np.ndarray:
        return self.spans.first[1:]

    @functools.cached_property
    def words(self) -> np.ndarray:
        return self.stop - self.first

    def line(self, i: int) -> list[bytes]:
        """The words of one line, without those of the others; bytes.split parts at the same six bytes as find_words."""
        return self.data[self.start[i] : self.end[i]].tobytes().split()

    @functools.cached_property
    def sums(self) -> WordSums:
        return WordSums(word_keys(self.data, self.spans))

    @functools.cached_property
    def plain(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """All words one space apart, and the span of each line there."""
        text, start, end = single_spaced(self.data, self.spans)
        ends = np.append(0, end)
        return text, np.append(start, len(text))[self.first], np.where(self.words, ends[self.stop], np.append(start, len(text))[self.first])

    def texts(self, which: np.ndarray) -> list[bytes]:
        text, a, b = self.plain
        return [text[i:j] for i, j in zip(a[which].tolist(), b[which].tolist())]

    @functools.cached_property
    def key(self) -> np.ndarray:
        """The digest of each line's words."""
        return digests(self.texts(np.arange(len(self.words))))

    def halves(self, which: np.ndarray) -> list[np.ndarray]:
        """Hashes of the halves by which a line can meet one of its length, one more word, or one fewer."""
        out = []
        a, b, n = self.first[which], self.stop[which], self.words[which]
        for base in (n, n - 1):
            half = base // 2
            tag = mix(base.astype(np.uint64))
            out.append(mix(self.sums.runs(a, a + half) + tag))
            out.append(mix(self.sums.runs(b - (base - half), b) ^ ~tag))
        return out


def _blocks(table: pa.Table) -> list[_Lines]:
    return [_Lines(first, data, at) for first, _, data, at in units.text_blocks(table)]


def _joined(parts: list[np.ndarray], dtype) -> np.ndarray:
    return np.concatenate([np.zeros(0, dtype), *parts]).astype(dtype)


def _bounds(here: list[_Lines]) -> np.ndarray:
    return np.cumsum([0, *map(len, here)])


def _within_one(a: list[bytes], b: list[bytes]) -> bool:
    """Whether two sequences of words are at most one insertion, deletion or replacement apart."""
    short, long = sorted((a, b), key=len)
    same = next((i for i, (x, y) in enumerate(zip(short, long)) if x != y), len(short))
    if len(long) == len(short):
        return short[same + 1 :] == long[same + 1 :]
    return len(long) == len(short) + 1 and short[same:] == long[same + 1 :]


class _Distinct:
    """The distinct lines of a unit: where each is first, by block and line."""

    def __init__(self, here: list[_Lines], least_words: int):
        words = _joined([x.words for x in here], np.int64)
        use = np.flatnonzero(words >= least_words)
        self.key, at = units.distinct(_joined([x.key for x in here], KEY)[use])
        self.at = use[at]
        self.bounds = _bounds(here)

    def by_block(self, chosen: np.ndarray):
        """(block, indices of lines in it, indices into the distinct lines) for a mask of the distinct lines."""
        at = self.at[chosen]
        block = np.searchsorted(self.bounds, at, side="right") - 1
        index = np.flatnonzero(chosen)
        for b in np.unique(block).tolist():
            yield b, at[block == b] - self.bounds[b], index[block == b]


def _half_keys(here: list[_Lines], lines: _Distinct) -> tuple[np.ndarray, np.ndarray]:
    """Keys of halves and the distinct line of each."""
    keys, owner = [], []
    for b, at, index in lines.by_block(np.ones(len(lines.key), dtype=bool)):
        found = here[b].halves(at)
        keys += found
        owner += [index] * len(found)
    return _joined(keys, np.uint64), _joined(owner, np.int64)


def _ask_lines(unit, table, _, buckets, near_words):
    here, ids = _blocks(table), units.ids_of(table)
    whole = _Distinct(here, 1)
    document = _joined([x.document for x in here], np.int64)[whole.at]
    asks = units.packed(unit, buckets, EXACT, whole.key, ids[document])
    if near_words:
        near = _Distinct(here, near_words - 1)
        keys, owner = _half_keys(here, near)
        found, at, counts = np.unique(keys, return_index=True, return_counts=True)
        # one line of this unit has the key: say which; several have: say that it is shared whoever else has it
        line = np.where(counts == 1, near.key["a"][owner[at]] if len(at) else NO_LINE, NO_LINE)
        asks += units.packed(unit, buckets, HALF, found, line)
    return asks


def _answer_lines(table):
    exact, half = units.Asked(table, EXACT, KEY), units.Asked(table, HALF)
    later = units.not_first(exact.keys, exact.array("a", np.int64), exact.unit)
    lines = half.array("a", np.uint64)
    order = np.lexsort((lines, half.keys))
    keys, lines = half.keys[order], lines[order]
    same = np.append(False, keys[1:] == keys[:-1])
    differs = (same & np.append(False, lines[1:] != lines[:-1])) | (lines == NO_LINE)
    group = np.cumsum(~same) - 1
    shared = np.zeros(int(group[-1]) + 1 if len(group) else 0, dtype=bool)
    shared[group[differs]] = True
    chosen = np.zeros(len(order), dtype=bool)
    chosen[order] = shared[group]
    return [exact.answers(EXACT, later, exact.keys), half.answers(HALF, chosen, half.keys)]


def _ask_variants(unit, table, replies, buckets, near_words):
    here, ids = _blocks(table), units.ids_of(table)
    near = _Distinct(here, near_words - 1)
    keys, owner = _half_keys(here, near)
    chosen = np.zeros(len(near.key), dtype=bool)
    chosen[owner[units.contains(keys, units.answered(replies, HALF))]] = True
    keys, line, document, places = [], [], [], []
    for b, at, _ in near.by_block(chosen):
        lines = here[b]
        long = np.flatnonzero(lines.words[at] >= near_words)
        n = lines.words[at[long]]
        first, stop = (np.repeat(x[at[long]], n) for x in (lines.first, lines.stop))
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        # each line itself, then the long ones without each of their words
        entry = np.concatenate([np.arange(len(at)), np.repeat(long, n)])
        keys += [lines.sums.runs(lines.first[at], lines.stop[at]), lines.sums.without_one(first, stop, first + place)]
        places += [np.full(len(at), -1), place]
        line.append((near.bounds[b] + at)[entry])
        document.append(ids[lines.document[at]][entry])
    beside = np.zeros(sum(map(len, keys)), dtype=_BESIDE)
    beside["line"], beside["place"] = (_joined(x, np.int64) for x in (line, places))
    return units.packed(unit, buckets, VARIANT, _joined(keys, np.uint64), _joined(document, np.int64), beside)


def _answer_variants(table):
    """To the unit of the earliest line that agrees with a later one: to send its words there."""
    got = units.Asked(table, VARIANT)
    if not len(got.keys):
        return [units.answer_table(np.zeros(0, np.int32), VARIANT, [])]
    document, beside = got.array("a", np.int64), got.array("b", _BESIDE)
    rank = np.empty(len(got.keys), dtype=np.int64)
    by_age = np.lexsort((beside["line"], got.unit, document))
    # entries of one line share a rank
    age = [x[by_age] for x in (document, got.unit, beside["line"])]
    rank[by_age] = np.cumsum(np.append(False, np.any([x[1:] != x[:-1] for x in age], axis=0)))
    entry = np.empty(rank.max() + 1, dtype=np.int64)
    entry[rank] = np.arange(len(rank))
    order = np.lexsort((rank, beside["place"], got.keys))
    keys, place, age = got.keys[order], beside["place"][order], rank[order]
    new_key = np.append(True, keys[1:] != keys[:-1])
    new_place = new_key | np.append(True, place[1:] != place[:-1])
    key_start, place_start = np.flatnonzero(new_key), np.flatnonzero(new_place)
    key_of, place_of = np.cumsum(new_key) - 1, np.cumsum(new_place) - 1
    never = np.iinfo(np.int64).max
    whole = place == -1
    first_whole = np.minimum.reduceat(np.where(whole, age, never), key_start)[key_of]
    first_short = np.minimum.reduceat(np.where(whole, never, age), key_start)[key_of]
    first_same = np.minimum.reduceat(age, place_start)[place_of]
    match = np.where(whole, first_short, np.minimum(first_whole, first_same))
    late = match < age
    pairs = np.unique(np.stack([match[late], age[late]], axis=1), axis=0)
    early, later = entry[pairs[:, 0]], entry[pairs[:, 1]]
    fetch = np.zeros(len(pairs), dtype=_FETCH)
    fetch["unit"], fetch["other"], fetch["line"] = got.unit[later], beside["line"][later], beside["line"][early]
    unit = got.unit[early]
    by = np.argsort(unit, kind="stable")
    found, at = np.unique(unit[by], return_index=True)
    return [units.answer_table(found, VARIANT, [x.tobytes() for x in np.split(fetch[by], at[1:])] if len(found) else [])]


def _send_words(table, replies):
    """To each unit with later lines: which of them go with which texts, each text once."""
    asked = units.answered_rows(replies, VARIANT, _FETCH)
    if not len(asked):
        return units.answer_table(np.zeros(0, np.int32), WORDS, [])
    here = _blocks(table)
    bounds = _bounds(here)
    out_units, values = np.unique(asked["unit"]), []
    for unit in out_units.tolist():
        part = asked[asked["unit"] == unit]
        lines, text = np.unique(part["line"], return_inverse=True)
        block = np.searchsorted(bounds, lines, side="right") - 1
        texts = [b" ".join(here[b].line(i)) for b, i in zip(block.tolist(), (lines - bounds[block]).tolist())]
        pairs = np.zeros(len(part), dtype=_PAIR)
        pairs["line"], pairs["text"] = part["other"], text
        values.append(len(pairs).to_bytes(8, "little") + pairs.tobytes() + b"\n".join(texts))
    return units.answer_table(out_units, WORDS, values)


def _near(here: list[_Lines], replies: pa.Table) -> np.ndarray:
    """Indices of lines that are within one word edit of the earlier lines whose words came."""
    bounds, out = _bounds(here), []
    for value in units.values_of(replies, WORDS):
        n = int.from_bytes(value[:8], "little")
        pairs = np.frombuffer(value, dtype=_PAIR, count=n, offset=8)
        texts = [x.split(b" ") for x in value[8 + n * _PAIR.itemsize :].split(b"\n")]
        block = np.searchsorted(bounds, pairs["line"], side="right") - 1
        for b, line, text in zip(block.tolist(), pairs["line"].tolist(), pairs["text"].tolist()):
            if _within_one(here[b].line(line - bounds[b]), texts[text]):
                out.append(line)
    return np.array(out, dtype=np.int64)


def _remove(table, replies):
    here = _blocks(table)
    whole = _Distinct(here, 1)
    keys = _joined([x.key for x in here], KEY)
    words = _joined([x.words for x in here], np.int64)
    drop = words > 0
    drop[whole.at] = False
    near = units.distinct(keys[_near(here, replies)])[0]
    drop |= (words > 0) & (units.contains(keys, units.answered(replies, EXACT, KEY)) | units.contains(keys, near))
    texts, total, removed, done = [], [], [], 0
    for lines in here:
        gone = drop[done : done + len(lines.words)]
        done += len(lines.words)
        raw = lines.data.tobytes()
        bounds = np.searchsorted(lines.row, np.arange(lines.row[-1] + 2))
        spans = list(zip(lines.start.tolist(), lines.end.tolist()))
        count = np.concatenate([[0], np.cumsum(gone)])
        compared = np.concatenate([[0], np.cumsum(lines.words > 0)])
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if count[b] == count[a]:
                texts.append(raw[spans[a][0] : spans[b - 1][1]])
            else:
                texts.append(b"\n".join(raw[i:j] for (i, j), x in zip(spans[a:b], gone[a:b].tolist()) if not x))
        total.append(np.diff(compared[bounds]))
        removed.append(np.diff(count[bounds]))
    missing = np.asarray(table.column("__text").combine_chunks().is_null())
    text = pa.array(texts, pa.binary(), mask=missing).cast(pa.string())
    n = [pa.array(_joined(x, np.int64)) for x in (total, removed)]
    return table.column("__id"), text, *n


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", edits: int = 1, similarity: float = 0.8) -> DataFrame:
    """The columns of ``docs`` with the text cleaned, and n_lines and n_removed (of lines with words).

    Columns of the input by these two names are replaced.
    """
    if edits not in (0, 1) or not 0 <= similarity < 1:
        raise ValueError("the edit bound is 0 or 1 words, the similarity in [0, 1)")
    # the fewest words of which one may differ
    near_words = max(1, math.ceil(round(1 / (1 - similarity), 9))) if edits else 0
    buckets = units.bucket_count(docs)
    kept = [c for c in docs.columns if c not in (key, text, "n_lines", "n_removed")]
    # columns beside the text travel as one struct, whatever their names
    beside = docs.select(key, text, F.struct(F.lit(0).alias("__0"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(kept)]).alias("__kept"))
    dealt = units.deal(beside, key, text, ["__kept"])
    ask_lines = functools.partial(_ask_lines, near_words=near_words)
    lines = units.answer(units.ask(dealt, None, ask_lines, buckets), _answer_lines)
    replies = lines.filter(F.col("kind") == EXACT)
    if edits:
        ask_variants = functools.partial(_ask_variants, near_words=near_words)
        variants = units.answer(units.ask(dealt, lines, ask_variants, buckets), _answer_variants)
        replies = replies.union(units.finish(dealt, variants, _send_words, units.ANSWER))

    def clean(table: pa.Table, found: pa.Table) -> pa.Table:
        if not table.num_rows:
            return table.select([]).append_column("key", pa.array([], pa.int64()))
        doc_id, cleaned, n, m = _remove(table, found)
        return pa.table({"key": doc_id, "text": cleaned, "kept": table.column("__kept"), "n_lines": n, "n_removed": m})

    schema = T.StructType(
        [
            T.StructField("key", T.LongType()),
            T.StructField("text", T.StringType()),
            T.StructField("kept", dealt.schema["__kept"].dataType),
            T.StructField("n_lines", T.LongType()),
            T.StructField("n_removed", T.LongType()),
        ]
    )
    done = units.finish(dealt, replies, clean, schema)
    named = {key: F.col("key").cast(docs.schema[key].dataType), text: F.col("text")}
    named |= {c: F.col("kept")[f"c{i}"] for i, c in enumerate(kept)}
    columns = [named[c].alias(c) for c in docs.columns if c in named]
    return done.select(*columns, F.col("n_lines").alias("n_lines"), F.col("n_removed").alias("n_removed"))
