import numpy as np

from tickloom.llm import vectors
from tickloom.llm.vectors import near_duplicates


def planted(seed=0, n=700, dim=16):
    """Random directions, dense groups around some of them, a chain, and copies."""
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, dim))
    dense = base[3] + 0.1 * rng.standard_normal((150, dim))
    pairs = base[10:60] * rng.uniform(0.5, 3, (50, 1)) + 0.15 * rng.standard_normal((50, dim))
    angle = np.arange(12) * 0.4
    chain = np.zeros((12, dim))
    chain[:, 0], chain[:, 1] = np.cos(angle), np.sin(angle)
    x = np.concatenate([base, dense, pairs, chain, base[:30], dense[:5], dense[:1], dense[:1]])
    return x[rng.permutation(len(x))].astype(np.float32)


def brute(x):
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    hit = u @ u.T >= 0.9
    np.fill_diagonal(hit, False)
    label = np.arange(len(x))
    while True:
        new = np.minimum(label, np.where(hit, label[None, :], len(x)).min(1))
        if (new == label).all():
            return hit.sum(1), label
        label = new


def frame(spark, x, start=5):
    rows = [(start + 2 * i, [float(a) for a in v], i % 3) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)


def check(rows, x):
    """No false link, the audited recall near the true one, components and kept rows as links say."""
    links, label = brute(x)
    rows = sorted(rows, key=lambda r: r.vec_id)
    assert [r.vec_id for r in rows] == [5 + 2 * i for i in range(len(x))]
    assert all(r.n_links <= n for r, n in zip(rows, links))
    share = np.mean([r.n_links / n for r, n in zip(rows, links) if n])
    recall = {r.recall for r in rows}
    assert len(recall) == 1 and min(recall) >= vectors.LEAST_RECALL and abs(share - min(recall)) < 0.02 and share >= 0.97
    same = np.mean([r.component_id == 5 + 2 * c for r, c in zip(rows, label)])
    assert same > 0.97 and all(r.kept == (r.vec_id == r.component_id) for r in rows)


def test_against_brute_force(spark):
    x = planted()
    check(near_duplicates(frame(spark, x)).collect(), x)


def test_several_shards_and_parts(spark, monkeypatch):
    monkeypatch.setattr(vectors, "SHARD_TARGET", 150)
    x = planted(4)
    check(near_duplicates(frame(spark, x)).collect(), x)
    monkeypatch.setattr(vectors, "SHARD_LIMIT", 200)
    monkeypatch.setattr(vectors, "SHARD_TARGET", 2000)
    check(near_duplicates(frame(spark, x)).collect(), x)


def test_low_recall_is_seen_and_mended(spark, monkeypatch):
    """A search that finds nothing is audited as such, and the exact steps find every link."""
    none = lambda *a: (np.zeros(0, np.int64), np.zeros(0, np.int64))
    monkeypatch.setattr(vectors, "search", none)
    monkeypatch.setattr(vectors, "SHARD_TARGET", 150)
    seen, audit = [], vectors.audit
    monkeypatch.setattr(vectors, "audit", lambda *a: seen.append(audit(*a)) or seen[-1])
    x = planted(6)
    table = vectors.written(vectors.packed(vectors.nodes(frame(spark, x), "vec_id", "embedding")[1]), "nodes")
    empty = spark.createDataFrame([], "node long, links long")
    assert vectors.audit(table, empty) == 0.0
    links, edges = vectors.link(table, vectors.fit(table), 64, True)
    assert vectors.audit(table, links) == 1.0 and {r.node: r.links for r in links.collect()}
    got = {r.node: r.links for r in links.collect()}
    want, _ = brute(x)
    first = {r.node: (r.first, r.copies) for r in table.collect()}
    assert all(got.get(k, 0) + n - 1 == want[(i - 5) // 2] for k, (i, n) in first.items())


def test_search_walks_a_path_and_widens():
    """A chain of near vectors is followed from one end, and a range larger than the beam comes whole."""
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.standard_normal((50, 8)), np.ones((1, 8)) + 0.05 * rng.standard_normal((200, 8))])
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    row, node = vectors.search(x, vectors.build(x.astype(float), 0), np.array([0]), np.array([-1, 3]), x[[120, 3]], 0.9)
    assert set(node[row == 0].tolist()) == set(np.flatnonzero(x @ x[120] >= 0.9).tolist()) and 3 in node[row == 1]


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [1.0, None]), (9, [1.0, 0.0, 0.0]), (10, [-1.0, -0.0]), (11, [-1.0, 0.0]), (None, [1.0, 0.0]), (2, [2.0, 0.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, node string")
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in near_duplicates(df).collect())
    want = [("1", 2, "1", True), ("2", 2, "1", False), ("2", 2, "1", False), ("10", 1, "10", True), ("11", 1, "10", False), ("None", 0, "None", True)]
    want += [(str(i), 0, str(i), True) for i in (3, 4, 5, 6, 7, 8, 9)]
    assert got == sorted(want)
    assert near_duplicates(df.limit(0)).count() == 0


def test_vectors_of_one_hash_stay_apart(spark):
    """XXH64 of both is the same, their cosine is next to nothing."""
    rows = [(1, [1.0, 0.0]), (2, [3.5, 5.808188475432675e182])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert df.selectExpr("xxhash64(embedding) AS h").distinct().count() == 1
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in near_duplicates(df).collect()) == [(1, 0, 1), (2, 0, 2)]


def test_a_batch_meets_centroids_in_blocks():
    near = np.random.default_rng(3).standard_normal((50, 40))
    assert (vectors._nearest(near, 5) == np.argsort(-near, axis=1)[:, :5]).all()
