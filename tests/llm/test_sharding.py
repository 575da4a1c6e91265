import zlib
from collections import Counter, defaultdict

import numpy as np

from tickloom.llm.sharding import Tree, assign, draw


def test_law_slots_and_sizes(docs):
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = assign(docs, 24).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    slots = defaultdict(list)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert r.size == len(raw) + 8 and r.text_crc32 == zlib.crc32(raw) and r.law == "key"
        assert 0 <= r.shard < 24 and r.grown_shard in (r.shard, 24)
        slots[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def plain_shard(tree, key):
    """One key by plain loops: the earliest attempt of any region that ends at a shard."""
    key, best = np.array([key]), (float("inf"), None)
    for g, weight in enumerate(tree.region):
        time, attempt = 0.0, 0
        while True:
            time += draw(key, 3 * g, attempt, weight)[0]
            racks = [(draw(key, 3 * (3 * g + r) + 1, attempt, tree.rack[g, r])[0], r) for r in range(3)]
            rack = min(racks)[1]
            place = min((draw(key, 3 * (12 * g + 4 * rack + s) + 2, attempt, tree.place[g, rack, s])[0], 12 * g + 4 * rack + s) for s in range(4))[1]
            if place < tree.shards:
                best = min(best, (time, place))
                break
            attempt += 1
    return best[1]


KEYS = np.random.default_rng(5).integers(0, 2**63, 12000).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def test_placement_against_plain_loops():
    uneven = [1 + (i * 7 % 5) for i in range(30)]
    for shards, weights in ((1, None), (5, None), (24, None), (25, uneven), (29, uneven)):
        tree = Tree(shards, weights)
        assert tree.shard(KEYS[:300]).tolist() == [plain_shard(tree, k) for k in KEYS[:300]]


def test_growth_moves_only_into_the_new_shard():
    uneven = [1 + (i * 7 % 5) for i in range(40)]
    for weights in (None, uneven):
        before = Tree(1, weights).shard(KEYS)
        for n in range(2, 40):
            after = Tree(n, weights).shard(KEYS)
            assert set(after[after != before].tolist()) <= {n - 1}
            before = after
        share = np.bincount(before, minlength=39) / len(KEYS)
        want = np.array(weights[:39] if weights else [1] * 39) / sum(weights[:39] if weights else [1] * 39)
        assert np.abs(share - want).max() < 4 * np.sqrt(want.max() / len(KEYS))


def test_a_changed_weight_moves_documents_of_its_subtree_only():
    before, after = Tree(36).shard(KEYS), Tree(36, [1.0] * 17 + [4.0]).shard(KEYS)
    moved = before != after
    # shard 17 is in region 1, rack 4: what moves comes to region 1, and inside it only rack 4 wins from others
    assert moved.any() and (after[moved] // 12 == 1).all()
    inside = moved & (before // 12 == 1)
    assert (after[inside] // 4 == 4).all() and (after[inside & (before // 4 == 4)] == 17).all()


def test_work_is_one_path(monkeypatch):
    from tickloom.llm import sharding

    calls = []
    monkeypatch.setattr(sharding, "draw", lambda k, *a: calls.append(len(k)) or draw(k, *a))
    Tree(1200).shard(KEYS[:1000])
    assert sum(calls) == 1000 * (100 + 3 + 4)


def test_nulls_repeats_clashes_and_empty(spark, empty_docs):
    assert assign(empty_docs).count() == 0
    odd = spark.createDataFrame([(None, "a", 1, "x"), (None, "a", 1, "x"), (7, None, 2, "y"), (7, None, 2, "y")], "doc_id long, text string, shard int, size string")
    rows = assign(odd).collect()
    assert len(rows) == 4 and len({r.shard for r in rows if r.doc_id is None}) == 1
    assert {r.size for r in rows if r.doc_id == 7} == {8}


def test_texts_are_read_once(docs):
    files = assign(docs).inputFiles()
    assert files and all("/placed-" in f for f in files)
