import json
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tickloom.llm import packing, tokenfiles, tokens
from tickloom.llm.textbytes import blocks
from tickloom.llm.tokens import END_ID, Encoder

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
CODER = Encoder(VOCABULARY)


def plain(text):
    t = Tokenizer.from_file(VOCABULARY) if not hasattr(plain, "t") else plain.t
    plain.t = t
    return t.encode(text or "", add_special_tokens=False).ids + [END_ID]


def through_blocks(texts, limit=1 << 20):
    out = []
    for _, _, data, at in blocks(pa.array(texts, pa.string()), limit):
        ids, bounds = CODER.block(data, at)
        out += [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t\x0b\x1c\x85\xa0 　aAé'sß.,;!#1中\U0001f600d<|>", max_size=40), max_size=6))
def test_ids_equal_whole_text_ids(texts):
    assert through_blocks(texts) == [plain(t) for t in texts]
    assert through_blocks(texts, 8) == [plain(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["<|endoftext|>", "<|endof", "text|>", "<s>", " ", "a", "\n", "!", "é", " word"]), max_size=9).map("".join), max_size=6))
def test_special_tokens_inside_texts(texts):
    assert through_blocks(texts) == [plain(t) for t in texts]
    ordinary, own = Encoder(VOCABULARY, True), Tokenizer.from_file(VOCABULARY)
    own.encode_special_tokens = True
    for _, _, data, at in blocks(pa.array(texts, pa.string())):
        ids, bounds = ordinary.block(data, at, False)
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [own.encode(t, add_special_tokens=False).ids for t in texts]


def test_files_and_packing_of_special_tokens(spark, tmp_path):
    texts = {i: t for i, t in enumerate(["<|endoftext|>", "a <|endoftext|> b", "x<|endoftext|><|endoftext|> <s>", "<|endoftext|", "pre<|endoftext|>fix"])}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    check_pack(packing.pack(df, VOCABULARY).collect(), texts)
    tokenfiles.write(df, str(tmp_path / "special"), VOCABULARY)
    rows = sorted(tokenfiles.digests(spark, str(tmp_path / "special")).collect(), key=lambda r: r.doc_id)
    assert [r.ids_crc32 for r in rows] == [zlib.crc32(np.array(plain(t), "<u4").tobytes()) for t in texts.values()]


@pytest.mark.parametrize("counts", [{}, {1024: 3}, {1: 5000}, {600: 10, 424: 10, 400: 9, 24: 3}, {s: s % 13 for s in range(1, 1025)}])
def test_plan_places_every_rank_once(counts):
    seen, fill, items = defaultdict(set), defaultdict(int), defaultdict(list)
    for s in packing.plan(counts):
        for rank in range(s.lo, s.hi):
            assert rank not in seen[s.length]
            seen[s.length].add(rank)
            n = rank - s.lo
            items[s.base + n // s.per_bin].append((s.offset + n % s.per_bin * s.length, s.length))
    assert {k: set(range(n)) for k, n in counts.items() if n} == dict(seen)
    for group in items.values():
        at = 0
        for offset, length in sorted(group):
            assert offset == at
            at += length
        assert at <= 1024
        assert sum(3 * length > 1024 for _, length in group) <= 2
    total = sum(k * n for k, n in counts.items())
    if len(counts) == 1024:
        assert len(items) <= 1.03 * total / 1024


def check_pack(rows, texts):
    got = defaultdict(list)
    sequences = defaultdict(list)
    for r in rows:
        got[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for key, text in texts.items():
        ids = plain(text)
        parts = sorted(got[key], key=lambda r: r.piece)
        assert [p.piece for p in parts] == list(range(len(parts)))
        assert [(p.start, p.length) for p in parts] == packing.cut(len(ids), 1024)
        for p in parts:
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes())
    for group in sequences.values():
        at = 0
        for p in sorted(group, key=lambda r: r.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024


def test_pack_documents(docs, empty_docs):
    rows = packing.pack(docs, VOCABULARY).collect()
    check_pack(rows, {r.doc_id: r.text for r in docs.collect()})
    assert packing.pack(empty_docs, VOCABULARY).count() == 0


def test_cut():
    assert packing.cut(1, 4) == [(0, 1)] and packing.cut(4, 4) == [(0, 4)]
    assert packing.cut(9, 4) == [(0, 1), (1, 4), (5, 4)]


def test_files_round_trip(spark, docs, empty_docs, tmp_path):
    folder = str(tmp_path / "out")
    manifest = tokenfiles.write(docs, folder, VOCABULARY)
    rows = sorted(tokenfiles.digests(spark, folder).collect(), key=lambda r: r.doc_id)
    start = 0
    for r, d in zip(rows, sorted(docs.collect(), key=lambda r: r.doc_id), strict=True):
        ids = plain(d.text)
        assert (r.doc_id, r.start, r.n_tokens) == (d.doc_id, start, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert manifest["total_ids"] == start and json.loads((tmp_path / "out/manifest.json").read_text()) == manifest
    tokenfiles.write(empty_docs, str(tmp_path / "none"), VOCABULARY)
    assert tokenfiles.digests(spark, str(tmp_path / "none")).count() == 0


def test_null_and_repeated_keys(spark, tmp_path):
    odd = spark.createDataFrame([(None, "b"), (5, "a"), (5, "a"), (None, None)], "doc_id long, text string")
    tokenfiles.write(odd, str(tmp_path / "odd"), VOCABULARY)
    rows = sorted(tokenfiles.digests(spark, str(tmp_path / "odd")).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, None, 5, 5] and [r.n_tokens for r in rows] == [1, 2, 2, 2]
    assert packing.pack(odd, VOCABULARY).count() == 4


def test_chunks_that_weak_hashes_confuse():
    from .conftest import twins

    texts = [f"one {''.join(x)} end" for x in twins(2048, "a", "b")] + [f"one {''.join(x)}, end" for x in twins(1024, "ab", "ba")]
    assert through_blocks(texts) == [plain(t) for t in texts]
    assert [through_blocks([t])[0] for t in texts] == [plain(t) for t in texts]


def test_an_id_on_many_rows_spreads_over_parts(spark, tmp_path):
    rows = [(None if i % 2 else 4, f"text number {i}") for i in range(400)]
    folder = str(tmp_path / "hot")
    manifest = tokenfiles.write(spark.createDataFrame(rows, "doc_id long, text string"), folder, VOCABULARY)
    assert len(manifest["parts"]) > 2 and max(p["docs"] for p in manifest["parts"]) < 200
    got = sorted(tokenfiles.digests(spark, folder).collect(), key=lambda r: r.start)
    want = sorted(rows, key=lambda r: (r[0] is not None, r[1]))
    assert [(r.doc_id, r.n_tokens) for r in got] == [(k, len(plain(t))) for k, t in want]


def test_an_idle_worker_keeps_no_encoder():
    """Spark keeps idle Python workers; a task of the packing leaves none of its encoder in them."""
    batch = pa.record_batch({"doc_id": [1, 2], "text": ["some words", None]})
    (got,) = packing._pieces(iter([batch]), VOCABULARY, 1024)
    assert got.column("length").to_pylist() == [len(plain("some words")), 1]
    assert tokens.encoder.cache_info().currsize == 0
