import math
import re
import string
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tickloom.llm import language
from tickloom.llm.language import CLASS_WORDS, CLASSES, STATE, Model, learn, score_documents

from .conftest import twins

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def tokens(text):
    return [*WORD.findall((text or "").translate(LOW)), None]


def brute(rows):
    counts = Counter()
    for key, text in rows:
        if zlib.crc32(str(key).encode()) % 7 != 2:
            counts.update(tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = {}
    for key, text in rows:
        t = tokens(text)
        out[key] = (zlib.crc32(str(key).encode()) % 7 == 2, len(t), sum(x in counts for x in t), n, sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in t))
    return out


def test_base_against_brute_force_and_model_beats_it(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    rows = {r.doc_id: r for r in score_documents(docs).collect()}
    for k, (held, n, known, total, base) in want.items():
        r = rows[k]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert abs(r.base_score - base) < 1e-6 * (1 + abs(base))
    held = [r for r in rows.values() if r.held_out]
    gain = 1 - sum(r.score for r in held) / sum(r.base_score for r in held)
    print("held-out gain", gain)
    assert gain > 0.03
    assert all(r.score <= 0 for r in rows.values())


def small_model():
    rng = np.random.default_rng(2)
    p = rng.random(300)
    model = Model([f"w{i}".encode() for i in range(298)], p / p.sum())
    model.w = {k: v + 0.3 * rng.standard_normal(v.shape) for k, v in model.w.items()}
    return model, rng


def test_probabilities_sum_to_one():
    model, rng = small_model()
    h = rng.standard_normal((1, STATE))
    every = np.arange(CLASSES * CLASS_WORDS)
    assert abs(np.exp(model.output(np.repeat(h, len(every), 0), every)).sum() - 1) < 1e-9


def test_gradients_equal_finite_differences():
    model, rng = small_model()
    x = rng.integers(0, 300, (5, 4))
    fresh = rng.random((5, 4)) < 0.3
    h = rng.standard_normal((4, STATE))
    _, found, _ = model.gradients(x, fresh, h)
    for name, value in model.w.items():
        flat, grad = value.reshape(-1), found[name].reshape(-1)
        for i in np.argsort(-np.abs(grad))[:5]:
            old, eps = flat[i], 1e-5
            flat[i] = old + eps
            up = model.gradients(x, fresh, h)[0]
            flat[i] = old - eps
            down = model.gradients(x, fresh, h)[0]
            flat[i] = old
            assert abs((up - down) / (2 * eps) - grad[i]) < 1e-4 * (1 + abs(grad[i])), (name, i)


def test_state_is_carried_through_whole_documents():
    model, rng = small_model()
    sizes = [1, 100, 3, 0, 65, 33, 32]
    first = np.concatenate([[0], np.cumsum(sizes)])
    ids = rng.integers(0, 300, first[-1])
    got = model.score(ids, first)
    for k, (a, b) in enumerate(zip(first, first[1:])):
        h, total = np.zeros((1, STATE)), 0.0
        for t in range(a, b):
            total += float(model.output(h, ids[t : t + 1])[0])
            h, _ = model.step(h, ids[t : t + 1])
        assert abs(got[k] - total) < 1e-3 * (1 + abs(total))


def test_odd_tables(spark, docs, empty_docs):
    assert score_documents(empty_docs).count() == 0
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    for r in score_documents(docs).collect():
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:4] and abs(r.base_score - want[r.doc_id][4]) < 1e-6 * (1 + abs(r.base_score))
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    rows = score_documents(spark.createDataFrame([(held, "a b"), (held, None)], "doc_id long, text string")).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows) == [(1, 0, 0, 0.0), (3, 0, 0, 0.0)]
    mixed = score_documents(spark.createDataFrame([(None, "a b"), (None, "a"), (1, "")], "doc_id long, text string")).collect()
    assert len(mixed) == 3 and {r.train_tokens for r in mixed} == {5}  # id 1 is held out


def test_every_training_token_is_learned_from(spark):
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 50, n)) for n in (3, 700, 0, 5000, 40)]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").repartition(2)
    model = Model([], np.full(10, 0.1))
    before = model.flat()
    assert learn(rows, model) == sum(len(tokens(t)) for t in texts)
    assert np.isfinite(model.flat()).all() and not np.allclose(before, model.flat())


def test_words_that_weak_hashes_confuse(spark):
    x, y = ("".join(w) for w in twins(2048, "a", "b"))
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2]
    rows = [(i, x if i % 2 else f"{x} b") for i in range(20) if i not in held] + [(held[0], y), (held[1], f"{x} {y} B")]
    got = score_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute(rows)
    for r in got:
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][1:4] and abs(r.base_score - want[r.doc_id][4]) < 1e-6 * (1 + abs(r.base_score))


def test_clashing_columns_and_repeated_rows(spark):
    rows = [(1, "a b", [1], "x", 0.5)] * 3 + [(None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, words array<int>, unit string, score double")
    got = score_documents(df).collect()
    assert sorted(r.n_tokens for r in got) == [1, 3, 3, 3] and all(math.isfinite(r.score) for r in got)


def test_without_training_rows_words_cost_their_symbol(spark):
    rows = [(i, "foo bar") for i in range(200)]
    held = spark.createDataFrame(rows, "doc_id long, text string").filter(language.held_out("doc_id"))
    more = held.withColumn("text", F.concat("text", F.lit(" foo bar")))
    a, b = language.score_documents(held).first(), language.score_documents(more).first()
    assert (a.n_tokens, b.n_tokens, a.train_tokens, a.n_known) == (3, 5, 0, 0)
    # each of the words costs the same share of the symbols
    assert b.score < a.score < -0.3 and abs((b.score - a.score) / 2 - a.score / 3) < 0.2
