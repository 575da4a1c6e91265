"""The pipeline's near-dedup stage against brute-force Jaccard over five-word shingles."""

import random
import string

import corpus_pipeline

from .conftest import DOCS, corpus
from .test_simhash import WORD

LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingles(text):
    words = WORD.findall((text or "").translate(LOW))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def components(texts):
    sets, label = [shingles(t) for t in texts], list(range(len(texts)))
    near = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if 5 * len(a & b) >= 4 * len(a | b)]
    changed = True
    while changed:
        changed = False
        for i, j in near:
            if label[i] != label[j]:
                label[i] = label[j] = min(label[i], label[j])
                changed = True
    return label, near


def check(spark, rows):
    """One row of each component stays, the one with the smallest id, null ids last."""
    label, near = components([r[1] for r in rows])
    groups = {}
    for row, name in zip(rows, label):
        groups.setdefault(name, []).append(row)
    got = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, DOCS).repartition(3), "").collect()]
    owner = {}
    for row, name in zip(rows, label):
        owner.setdefault((row[0], row[1]), set()).add(name)
    assert sorted(min(owner[x]) for x in got) == sorted(groups)
    for x in got:
        ids = [r[0] for r in groups[min(owner[x])]]
        assert x[0] == min((i for i in ids if i is not None), default=None)
    return near, got


def test_near_copies_against_brute_force(spark):
    rng = random.Random(5)
    rows, words = corpus(), [f"w{i}" for i in range(900)]
    for i in range(60):
        base = [rng.choice(words) for _ in range(rng.randint(30, 400))]
        for k in range(3):
            text = list(base)
            for _ in range(rng.randint(1, max(1, len(text) // (40 if k else 60)))):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((1000 + 10 * i + k, " ".join(text), "en", "s", 0))
    near, got = check(spark, rows)
    assert len(near) > 80 and len(got) < len(rows) - 40


def test_repeated_and_missing_ids(spark):
    """Only rows of one component compete, whatever their ids; rows without an id take part."""
    rng = random.Random(6)
    text = lambda: " ".join(f"w{rng.randrange(900)}" for _ in range(80))
    copy, lost = text(), text()
    rows = [(3, copy), (7, copy), (7, text()), (7, text()), (None, lost), (None, lost), (None, lost + " more"), (None, text()), (9, None), (None, "")]
    check(spark, [(k, t, "en", "s", 0) for k, t in rows])
    many = [(i, " ".join([*lost.split(), f"x{i}"]), "en", "s", 0) for i in range(120)]
    _, got = check(spark, many)
    assert len(got) == 1


def test_texts_of_one_hash_stay_apart(spark):
    rows = [(1, "red green blue x", "en", "s", 0), (2, "od5eVFO3Z%wK\\*Jr", "en", "s", 0)]
    df = spark.createDataFrame(rows, DOCS)
    assert df.selectExpr("xxhash64(text) AS h").distinct().count() == 1
    assert len(check(spark, rows)[1]) == 2


def test_links_between_many_texts_that_share_their_keys(spark):
    """300 texts share most of their shingles without being near copies; of these, 30 pairs are."""
    rng = random.Random(7)
    base = [f"w{rng.randrange(900)}" for _ in range(400)]
    own = lambda n: [f"x{rng.randrange(10**9)}" for _ in range(n)]
    texts = [base + own(52) for _ in range(240)]
    for _ in range(30):
        tail = own(5)
        texts += [base + tail + own(47) for _ in range(2)]
    near, got = check(spark, [(i, " ".join(x), "en", "s", 0) for i, x in enumerate(texts)])
    assert len(near) == 30 and len(got) == 270
