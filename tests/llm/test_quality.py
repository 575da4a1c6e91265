import zlib

import numpy as np

from tickloom.llm import quality
from tickloom.llm.quality import Network, chunks, score, train


def test_chunks_cover_every_byte():
    for n in (0, 1, 255, 256, 257, 448, 449, 1000):
        data = (np.arange(n) % 250 + 1).astype(np.uint8)
        x, count = chunks(data, np.array([0, n]))
        assert count.tolist() == [len(x)] and len(x) >= 1
        seen = np.zeros(n, bool)
        for i, row in enumerate(x):
            part = data[i * quality.STEP : i * quality.STEP + quality.CHUNK]
            assert row[: len(part)].tolist() == part.tolist() and not row[len(part) :].any()
            seen[i * quality.STEP : i * quality.STEP + quality.CHUNK] = True
        assert seen.all()


def test_gradients_equal_finite_differences():
    rng = np.random.default_rng(0)
    net = Network(rng)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    x = rng.integers(1, 255, (5, quality.CHUNK)).astype(np.uint8)
    count, label, weight = np.array([2, 1, 2]), np.array([1, 0, 1]), np.array([1.0, 2.0, 0.5])

    def loss():
        p, _ = net.combine(net.pooled(net.filters(x)[0], count).astype(np.float64))
        return -(weight * (label * np.log(p) + (1 - label) * np.log(1 - p))).sum() / weight.sum()

    got = net.gradients(x, count, label, weight)
    for name, value in net.w.items():
        flat, grad = value.reshape(-1), np.asarray(got[name]).reshape(-1)
        for i in np.argsort(-np.abs(grad))[:4]:
            old, eps = flat[i], 1e-5
            flat[i] = old + eps
            up = loss()
            flat[i] = old - eps
            down = loss()
            flat[i] = old
            assert abs((up - down) / (2 * eps) - grad[i]) < 2e-3 + 0.05 * abs(grad[i]), (name, i)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    network = train(docs, labels)
    rows = {r.doc_id: r for r in score(docs, network).collect()}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 3 == 1) for k, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())
    held = [k for k in truth if rows[k].held_out]
    right = {y: [rows[k].predicted == y for k in held if truth[k] == y] for y in (0, 1)}
    assert np.mean(right[1]) > 0.95 and np.mean(right[0]) > 0.8


def test_odd_inputs(spark, docs, empty_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert train(docs, none) == 0.5
    one = spark.createDataFrame([(0, 1, None), (3, 1, None), (6, 1, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    assert train(docs, one) == 1.0
    network = Network(np.random.default_rng(1))
    assert score(empty_docs, network).count() == 0
    rows = score(docs, network).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    kept = quality.keep_good(docs, network)
    assert kept.schema == docs.schema and kept.count() == sum(r.predicted for r in rows)


def test_sample_is_bounded_before_it_is_collected(spark, monkeypatch):
    """An id on many rows gives one text, and what is learned from keeps within its bounds."""
    learned = []
    monkeypatch.setattr(Network, "learn", lambda self, texts, labels, rng: learned.append((texts, labels.tolist())))
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 3 != 1]
    labels = spark.createDataFrame([(i, i % 2, "a", 0) for i in ids] + [(ids[0], ids[0] % 2, "b", 1), (None, 1, None, None)], "doc_id long, quality int, text string, toxic int")
    docs = spark.createDataFrame([(ids[0], f"text {i % 3}") for i in range(60)] + [(i, "x" * (100 * i)) for i in ids[1:]] + [(None, "n"), (ids[1], None)], "doc_id long, text string")
    train(docs, labels)
    monkeypatch.setattr(quality, "SAMPLE_BYTES", 9000)
    train(docs, labels)
    monkeypatch.setattr(quality, "LONGEST", 500)
    train(docs, labels)
    (all_, kinds), (some, _), (short, _) = learned
    assert len(all_) == len(ids) == len(kinds) and len(some) < len(all_) and sum(map(len, some)) <= 9000
    assert some == all_[: len(some)] and max(map(len, short)) <= 500


def test_null_ids_repeats_and_clashing_columns(spark):
    rows = [(None, "a b", 1, True), (None, "a b", 1, True), (3, None, 2, None), (3, "", 2, None)]
    got = score(spark.createDataFrame(rows, "doc_id long, text string, score int, held_out boolean"), Network(np.random.default_rng(2))).collect()
    assert len(got) == 4 and len({r.score for r in got}) == 2 and not any(r.held_out for r in got if r.doc_id is None)
