import random
import re

from tickloom.llm.decontaminate import ERROR_RATE, best_distance, masks, matches, normal_text, remove_contaminated

from .conftest import sentence


def stretch_distance(p, t):
    """Smallest edit distance of p to a stretch of t, by the plain table."""
    row = [0] * (len(t) + 1)
    for i, x in enumerate(p, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(t, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return min(row)


def test_myers_equals_the_table():
    rng = random.Random(5)
    for _ in range(300):
        p = "".join(rng.choice("abc") for _ in range(rng.randint(1, 70)))
        t = "".join(rng.choice("abcd") for _ in range(rng.randint(0, 90)))
        assert best_distance(masks(p), len(p), t) == stretch_distance(p, t)


def test_normal_form():
    assert normal_text("  A b--C!!\n\tÉé ") == "a b c éé".encode().decode("latin-1")
    assert normal_text(None) == "" and normal_text("?!") == ""


def world():
    rng = random.Random(11)
    items = [(i, sentence(rng, rng.randint(8, 40))) for i in range(12)] + [(20, None), (21, "short"), (22, ""), (23, "Of!"), (24, "the of is")]
    docs = []
    for i in range(80):
        text = sentence(rng, rng.randint(0, 60))
        if i % 2:
            body = items[rng.randrange(12)][1]
            for _ in range(rng.choice([0, 1, 2, 4, 6, 9, 14])):
                j = rng.randrange(len(body))
                body = rng.choice([body[:j] + body[j + 1 :], body[:j] + "q" + body[j + 1 :], body[:j] + "z" + body[j:]])
            body = rng.choice([body, body.upper(), re.sub(r" ", "###\n", body)])
            text = f"{text} {body} {sentence(rng, 5)}" if rng.random() < 0.7 else body
        docs.append((i, text))
    return docs + [(100, None), (101, ""), (102, " ".join(t for _, t in items if t)), (103, "x, short y"), (104, "shorter unshort")], items


def test_against_brute_force(spark):
    docs, items = world()
    want = {}
    for d, text in docs:
        for i, item in items:
            p, t = normal_text(item), normal_text(text)
            budget = int(ERROR_RATE * len(p))
            if not budget:
                if p and f" {p} " in f" {t} ":
                    want[d, i] = 0
            elif (n := stretch_distance(p, t)) <= budget:
                want[d, i] = n
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.distance for r in matches(frame, bench).collect()}
    assert got == want and len(want) > 30 and max(want.values()) >= 4
    kept = {r.doc_id for r in remove_contaminated(frame, bench).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in want}


def test_empty_sides(spark, docs, empty_docs):
    bench = spark.createDataFrame([(1, "the river stone and bright window paper")], "item_id long, text string")
    assert matches(empty_docs, bench).count() == 0
    assert matches(docs, bench.limit(0)).count() == 0
    assert remove_contaminated(docs, bench.limit(0)).count() == docs.count()


def test_blocks_of_items_nulls_repeats_and_clashes(spark, monkeypatch):
    from tickloom.llm import decontaminate

    docs, items = world()
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame([(d, t, "x", None) for d, t in docs] + [(None, docs[3][1], "y", 1)] * 2, "doc_id long, text string, item_id string, distance int")
    rows = lambda: sorted(str((r.doc_id, r.item_id, r.distance)) for r in matches(frame, bench).collect())
    kept = lambda: sorted(str(r) for r in remove_contaminated(frame, bench).collect())
    one = rows(), kept()
    assert any(x.startswith("(None") for x in one[0]) == any(x.startswith("(3,") for x in one[0])
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 600)
    assert (rows(), kept()) == one


def test_removal_over_blocks_moves_a_hot_text_in_parts(spark, monkeypatch):
    from tickloom.llm import decontaminate

    docs, items = world()
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(d, t, i, [i]) for i, (d, t) in enumerate(docs)] + [(1000 + i, f"see {items[3][1]} here", i, None) for i in range(300)]
    rows += [(2000 + i, "a clean text that many rows share", i % 2, None) for i in range(300)] + [(7, None, None, None)] * 20
    frame = spark.createDataFrame(rows, "doc_id long, text string, n long, other array<int>").repartition(5)
    kept = lambda: sorted(map(repr, remove_contaminated(frame, bench).collect()))
    whole = kept()
    assert 320 < len(whole) < len(rows) - 300
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 600)
    assert kept() == whole and remove_contaminated(frame, bench).columns == frame.columns
    assert remove_contaminated(frame.limit(0), bench).count() == 0
