"""Substring dedup: remove words covered by a window of words that also starts earlier.

A window is ``WINDOW`` consecutive words of one document, words being taken unchanged.  Every word covered by a window
whose word sequence also starts earlier (smaller id, or same document and earlier start) is removed; windows are
judged on the input.

Difference-cover anchors: only runs of ``ANCHOR`` words at positions in ``COVER`` modulo ``PERIOD`` are hashed and
compared over the corpus.  The cover holds a pair of positions for every difference, so two equal windows share an
anchor at the same place of both: ANCHOR = WINDOW - PERIOD + 1 words fit behind every shift.  Only around anchors that
occur twice are the matches extended: the whole windows there are compared by 124-bit keys of their words' digests.

Defined results: null and empty texts have no words and keep the empty text; documents with equal ids are ordered by
a hash of the text, null ids come last; repeated rows count as copies, the first is kept; other columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import units
from .textbytes import KEY, Words, WordSums, find_words, single_spaced, windows, word_keys

WINDOW = 20
PERIOD = 13
COVER = (0, 1, 3, 9)
ANCHOR = WINDOW - PERIOD + 1

_IN_COVER = np.isin(np.arange(PERIOD), COVER)


def _blocks(table: pa.Table, lanes: int = 4):
    """(first row, bytes, words, word sums) of each block of documents."""
    for first, _, data, at in units.text_blocks(table):
        words = find_words(data, at)
        yield first, data, words, WordSums(word_keys(data, words), lanes)


def _anchors(words: Words, sums: WordSums) -> tuple[np.ndarray, np.ndarray]:
    """Word indices and hashes of the anchors of a block; documents shorter than a window have none."""
    short = np.diff(words.first) < WINDOW
    place = windows(words.first, ANCHOR)
    document = np.searchsorted(words.first, place, side="right") - 1
    place = place[_IN_COVER[(place - words.first[document]) % PERIOD] & ~short[document]]
    return place, sums.runs(place, place + ANCHOR)


def _ask_anchors(unit, table, _, buckets):
    keys = [np.unique(_anchors(words, sums)[1]) for _, _, words, sums in _blocks(table, 2)]
    return units.packed(unit, buckets, 0, np.unique(np.concatenate([np.zeros(0, np.uint64), *keys])))


def _shared_anchors(table):
    got = units.Asked(table, 0)
    return [got.answers(0, units.repeated(got.keys), got.keys)]


def _ask_windows(unit, table, replies, buckets):
    shared, ids = units.answered(replies, 0), units.ids_of(table)
    here = [(first, words, sums, *_anchors(words, sums)) for first, _, words, sums in _blocks(table)]
    again = np.concatenate([np.zeros(0, np.uint64), *[x[4] for x in here]])
    values, counts = np.unique(again, return_counts=True)
    shared = np.union1d(shared, values[counts > 1])
    keys, documents = [np.zeros(0, KEY)], [np.zeros(0, np.int64)]
    for first, words, sums, place, hashes in here:
        marked = np.zeros(len(words) + 1, dtype=np.int64)
        marked[place[units.contains(hashes, shared)] + 1] = 1
        marked = np.cumsum(marked)
        start = windows(words.first, WINDOW)
        start = start[marked[start + PERIOD] > marked[start]]
        keys.append(sums.wide_runs(start, start + WINDOW))
        documents.append(first + np.searchsorted(words.first, start, side="right") - 1)
    found, at = units.distinct(np.concatenate(keys))
    return units.packed(unit, buckets, 0, found, ids[np.concatenate(documents)[at]])


def _later_windows(table):
    got = units.Asked(table, 0, KEY)
    return [got.answers(0, units.not_first(got.keys, got.array("a", np.int64), got.unit), got.keys)]


def _remove(table, replies):
    later = units.answered(replies, 0, KEY)
    here = []
    for _, data, words, sums in _blocks(table):
        start = windows(words.first, WINDOW)
        here.append((data, words, start, sums.wide_runs(start, start + WINDOW)))
    hashes = np.concatenate([np.zeros(0, KEY), *[x[3] for x in here]])
    drop = np.ones(len(hashes), dtype=bool)
    drop[units.distinct(hashes)[1]] = False
    drop |= units.contains(hashes, later)
    total, removed, texts, done = [], [], [], 0
    for data, words, start, own in here:
        cover = np.zeros(len(words) + 1, dtype=np.int64)
        dropped = start[drop[done : done + len(own)]]
        done += len(own)
        np.add.at(cover, dropped, 1)
        np.add.at(cover, dropped + WINDOW, -1)
        kept = np.cumsum(cover[:-1]) == 0
        before = np.concatenate([[0], np.cumsum(kept)])[words.first]
        rest = Words(words.start[kept], words.end[kept], before)
        raw, a, b = single_spaced(data, rest)
        total.append(np.diff(words.first))
        removed.append(np.diff(words.first) - np.diff(before))
        texts += [raw[a[i] : b[j - 1]] if j > i else b"" for i, j in zip(before[:-1].tolist(), before[1:].tolist())]
    n = [np.concatenate([np.zeros(0, np.int64), *x]) for x in (total, removed)]
    kept_text = pa.array(texts, pa.binary()).cast(pa.string())
    return pa.table({"doc_id": table.column("__id"), "n_words": pa.array(n[0]), "n_removed": pa.array(n[1]), "kept_text": kept_text})


def dedup_substrings(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_text (the kept words, one space apart)."""
    buckets = units.bucket_count(docs)
    dealt = units.deal(docs, key, text)
    shared = units.answer(units.ask(dealt, None, _ask_anchors, buckets), _shared_anchors)
    later = units.answer(units.ask(dealt, shared, _ask_windows, buckets), _later_windows)
    return units.finish(dealt, later, _remove, "doc_id long, n_words long, n_removed long, kept_text string")
