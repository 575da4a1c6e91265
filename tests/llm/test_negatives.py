import math
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm import negatives as N

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.DoubleType())),
        T.StructField("label", T.IntegerType()),
        T.StructField("rank", T.StringType()),
    ]
)


def plain(rows, low=30, high=90, positives=5, negatives=10, every=100):
    good = {(k, tuple(v), c) for k, v, c, _ in rows if None not in (k, v, c) and v and all(x is not None and math.isfinite(x) for x in v)}
    good = sorted((k, [math.floor(256 * x) for x in v], c) for k, v, c in good)
    out = []
    for n, (k, v, c) in enumerate(good):
        if k % every:
            continue
        score = lambda w: min(max(sum(a * b for a, b in zip(v, w)), -(1 << 63)), (1 << 63) - 1)  # noqa: B023, E731
        found = [(score(w), i, d) for m, (i, w, d) in enumerate(good) if m != n and len(w) == len(v)]
        found.sort(key=lambda r: (-r[0], r[1]))
        for s, i, _ in [r for r in found if r[2] == c][:positives]:
            inside = [r for r in found if r[2] != c and low * s <= 100 * r[0] <= high * s]
            out += [(k, i, rank, r[1], s, r[0]) for rank, r in enumerate(inside[:negatives], 1)]
    return sorted(out)


def mined(spark, rows, parts=3, **more):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return sorted(map(tuple, N.hard_negatives(df, F.col("vec_id") % 100 == 0, **more).collect()))


def clustered(n, d=24, seed=1, labels=4):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(labels, d))
    label = rng.integers(0, labels, n)
    v = (middle[label] + 1.5 * rng.normal(size=(n, d))) / 8
    return [(i, v[i].tolist(), int(label[i]), "x") for i in range(n)]


@pytest.mark.parametrize("d", [3, 24, 160])
def test_equal_plain_loops(spark, d):
    rows = clustered(700, d)
    assert mined(spark, rows) == plain(rows) != []


def test_small_blocks_and_steps(spark, monkeypatch):
    monkeypatch.setattr(N, "ANCHOR_BYTES", 300)
    rows = clustered(900)
    assert mined(spark, rows, positives=2, negatives=3, low=10, high=120) == plain(rows, 10, 120, 2, 3)


def test_ties_nulls_copies_and_other_lengths(spark):
    rng = random.Random(3)
    rows = [(i, [float(rng.randint(0, 2)) / 64 for _ in range(6)], i % 3, None) for i in range(500)]
    rows += rows[:150] + [(200, None, 1, None), (None, [1.0] * 6, 1, None), (300, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1, None), (301, [1.0, float("nan"), 1.0, 1.0, 1.0, 1.0], 1, None)]
    rows += [(302, [float("inf")] * 6, 2, None), (400, [0.5] * 6, None, None), (403, [], 1, None)]
    rows += [(1000 + 50 * i, [0.1 * i, -0.2, 0.3], i % 2, None) for i in range(20)]
    assert mined(spark, rows) == plain(rows) != []


def test_a_hot_vector_and_a_hot_label(spark):
    rows = [(i, [0.25, 0.5, -0.125, 0.75] if i % 3 else [0.25, 0.5, i / 3000, 0.5], 0 if i % 2 else i % 5, None) for i in range(1, 1500)]
    assert mined(spark, rows) == plain(rows) != []


def test_scores_of_any_size(spark):
    rows = [(100 * i, [1e6 * (i + 1), -3e5, 2.5], i % 2, None) for i in range(12)] + [(7 + i, [10.0 ** (30 + i), 1.0, 2.0], i % 2, None) for i in range(6)]
    assert mined(spark, rows) == plain(rows) != []


def test_empty_and_lonely(spark):
    assert mined(spark, []) == [] and mined(spark, [(100, [1.0, 2.0], 1, None), (7, [1.0, 2.0], 2, None)]) == []
    assert mined(spark, [(101, [1.0], 1, None)]) == []


def test_bounds_hold_and_discard():
    rng = np.random.default_rng(5)
    whole = np.floor(256 * (rng.normal(size=(400, 64)) * 0.9 ** np.arange(64)))
    basis = N.axes(whole / 256)
    ids = np.arange(400)
    x = N.Turned.of(whole, basis, ids, ids, ids % 3, ids)
    exact = whole @ whole.T
    need = np.sort(exact, axis=1)[:, -10]
    pairs = [p for p in N.close(x, x, ids, ids, need, np.full(400, np.inf), False)]
    found = {(i, j): s for a, b, c in pairs for i, j, s in zip(a.tolist(), b.tolist(), c.tolist())}
    assert all(found[i, j] == exact[i, j] for i in range(400) for j in np.flatnonzero(exact[i] >= need[i]).tolist())
    assert len(found) < 400 * 400 / 4


def test_memory_is_bounded_where_most_rows_fit_the_windows():
    rng = np.random.default_rng(2)
    n, d = 1500, 64
    v = (0.5 + 0.5 * rng.random((n, 1))) * (rng.normal(size=d) + 0.1 * rng.normal(size=(n, d)))
    label = rng.integers(0, 3, n)
    table = pa.table({"id": np.arange(n), "label": pa.array([str(c) for c in label]), "v": pa.array(v.tolist(), pa.list_(pa.float64())), "row": np.arange(n)})
    whole = np.floor(256 * v)
    block, scores = N.Block(table, {d: N.axes(whole / 256)}), (whole @ whole.T).astype(np.int64)
    same = np.where((label[:, None] == label) & ~np.eye(n, dtype=bool), scores, -1)
    chosen = np.ma.array(-np.sort(-same, axis=1)[:, :2])
    tracemalloc.start()
    best = block.negatives(iter(table.to_batches()), chosen, 3, 30, 90)
    best.settle()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 250e6
    group, score, ids, _ = best.kept
    for a in range(0, n, 100):
        for p in range(2):
            fit = np.flatnonzero((label != label[a]) & (30 * chosen[a, p] <= 100 * scores[a]) & (100 * scores[a] <= 90 * chosen[a, p]))
            fit = fit[np.lexsort((fit, -scores[a][fit]))][:3]
            assert len(fit) and fit.tolist() == ids[group == 2 * a + p].tolist() and scores[a][fit].tolist() == score[group == 2 * a + p].tolist()


def test_any_row_of_an_id_makes_it_an_anchor(spark):
    rows = [r[:3] + ("no",) for r in clustered(60)]
    more = rows + [(7, None, 1, "yes"), (8, rows[8][1], rows[8][2], "yes"), rows[9]]
    got = N.hard_negatives(spark.createDataFrame(more, SCHEMA), F.col("rank") == "yes", positives=2, negatives=3).collect()
    assert sorted(map(tuple, got)) == [r for r in plain(rows, every=1, positives=2, negatives=3) if r[0] in (7, 8)] != []
