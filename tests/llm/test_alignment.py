import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tickloom.llm import alignment as A
from tickloom.llm.textbytes import blocks

VOCABULARY, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
PLAIN_A, PLAIN_B = Tokenizer.from_file(VOCABULARY), SentencePieceProcessor(model_file=MODEL)
PLAIN_A.encode_special_tokens = True
BOTH = A.Pair(VOCABULARY, MODEL)


def letters():
    """Byte by byte: a vocabulary encodes each single byte as one letter."""
    from tokenizers.pre_tokenizers import ByteLevel

    out = {c: b for b in range(128) for c in ByteLevel(add_prefix_space=False).pre_tokenize_str(chr(b))[0][0]}
    for i in range(128, 0x800):
        found = ByteLevel(add_prefix_space=False).pre_tokenize_str(chr(i))[0][0]
        out |= dict(zip(found, chr(i).encode(), strict=True))
    return out


LETTERS = letters()


def tokens(text):
    a, b = PLAIN_A.encode(" " + text, add_special_tokens=False), PLAIN_B.encode(text)
    a_bytes = [bytes(LETTERS.get(c, ord("?")) for c in t) for t in a.tokens]
    b_bytes = [bytes([int(p[3:5], 16)]) if PLAIN_B.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, PLAIN_B.encode(text, out_type=str))]
    whole = (" " + text).encode()
    return (list(zip(a.ids, a_bytes)), list(zip(b, b_bytes))) if text and b"".join(b_bytes) == whole else ([], [])


def plain(text):
    """(groups, links) token by token."""
    a, b = tokens(text or "")
    spans = []
    for side in (a, b):
        at, found = 0, []
        for i, x in side:
            found.append((i, at, at + len(x)))
            at += len(x)
        spans.append(found)
    links = [(p[0], q[0]) for p in spans[0] for q in spans[1] if p[1] < q[2] and q[1] < p[2]]
    both = sorted({p[2] for p in spans[0]} & {q[2] for q in spans[1]})
    groups = [([p[0] for p in spans[0] if low <= p[1] < high], [q[0] for q in spans[1] if low <= q[1] < high]) for low, high in zip([0, *both], both)]
    return len(a), len(b), groups, links


def expected(rows):
    found = [(k, plain(t)) for k, t in rows]
    counts = Counter(x for _, f in found for x in f[3])
    top = Counter()
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    out = []
    for k, (n_a, n_b, groups, links) in found:
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        best = sum(counts[x] == top[x[1]] for x in links)
        out.append((k, n_a, n_b, len(groups), len(links), best, sum(counts[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if n_a else ""))
    return sorted(out, key=repr)


def result(df):
    return sorted(map(tuple, A.alignment(df, VOCABULARY, MODEL).collect()), key=repr)


def test_alignment_equals_plain_loops(docs, empty_docs):
    short = docs.filter(F.length("text") < 4000)
    assert result(short) == expected([(r.doc_id, r.text) for r in short.collect()])
    assert result(empty_docs) == []


def test_odd_texts_small_units_and_clashing_columns(spark, monkeypatch):
    monkeypatch.setattr(A, "UNIT_BYTES", 40)
    monkeypatch.setattr(A, "ENTRIES", 3)
    texts = [None, "", " ", "  ", "a ", " a  b\n c", "▁x", "<|endoftext|> <s> <0x0A>", "x y\x1f　z \U0001f600\U0001f600", "the the the", "naïve café — 東京", "\t\n", "a\x00b", "word " * 30]
    rows = [(i % 9 or None, t) for i, t in enumerate(texts * 2)]
    df = spark.createDataFrame([(k, t, 1, "x") for k, t in rows], "doc_id long, text string, unit int, pairs string").repartition(3)
    assert result(df) == expected(rows)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t\x85\xa0　▁aAé'sß.,!1中\U0001f600<|>\x00", max_size=40), max_size=6))
def test_tokens_equal_the_libraries(texts):
    for limit in (8, 1 << 20):
        for first, end, data, at in blocks(pa.array(texts, pa.string()), limit):
            found = A.Aligned(BOTH, data, at)
            for i, text in enumerate(texts[first:end]):
                a, b = tokens(text)
                assert found.a[found.a_at[i] : found.a_at[i + 1]].tolist() == [x for x, _ in a]
                assert found.b[found.b_at[i] : found.b_at[i + 1]].tolist() == [x for x, _ in b]


def test_groups_as_spans(spark):
    text = "Unbelievable, naïve cross-tokenizer alignment works; 東京 too."
    df = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    rows = sorted(A.groups(df, VOCABULARY, MODEL).collect(), key=lambda r: r.doc_id)
    _, _, groups, _ = plain(text)
    cut = lambda ids, ends: [list(ids[i:j]) for i, j in zip([0, *ends], ends)]
    assert list(zip(cut(rows[0].a, rows[0].a_ends), cut(rows[0].b, rows[0].b_ends))) == groups
    assert (rows[1].a, rows[1].b, rows[1].a_ends) == ([], [], [])


def test_places_survive_packing():
    places = np.random.default_rng(1).integers(0, 1 << 20, 1000)
    assert A._unpack(A._pack(places)).tolist() == places.tolist() and len(A._unpack(A._pack(places[:0]))) == 0
