import hashlib
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from tickloom.llm import fingerprints as P



def signed(n):
    return n - (1 << 64) if n >> 63 else n


def h64(text):
    return xxhash.xxh64_intdigest(text.encode(), seed=42)


def pair(a, b):
    """Spark's hash of two longs: the second is hashed with the first one's hash as the seed."""
    one = xxhash.xxh64_intdigest(a.to_bytes(8, "little", signed=True), seed=42)
    return xxhash.xxh64_intdigest(b.to_bytes(8, "little", signed=True), seed=one)


def plain_anchors(text):
    """{key: first place}, window by window."""
    out = {}
    for i in range(len(text) - P.K + 1):
        inner = [signed(h64(text[i + j : i + j + P.S])) for j in range(P.K - P.S + 1)]
        if min(inner[0], inner[-1]) == min(inner):
            out.setdefault(pair(inner[0], inner[-1]) & 0x7FFFFFFF, i)
    return out


def plain_print(text):
    found = plain_anchors(text) or {h64(text) & 0x7FFFFFFF: 0}
    return sorted(found.items())[: P.SIZE]


def plain_likeness(a, b):
    x, y = dict(a), dict(b)
    least = sorted(set(x) | set(y))[: P.SIZE]
    common = set(x) & set(y)
    jaccard = sum(k in common for k in least) / len(least)
    places = sorted((x[k], y[k]) for k in common)
    rising = sum(i == 0 or places[i][1] > places[i - 1][1] for i in range(len(places)))
    return 2 * jaccard / (1 + jaccard) * rising / max(1, len(common))


def shown(found):
    return " ".join(f"{k:08x}:{i:x}" for k, i in found)


def expected(rows):
    """Rows of (id, text) in the order of edits: id with none first, then the hash of the text."""
    rows = sorted(((k, t or "") for k, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, signed(h64(r[1])), r[1].encode()))
    out = []
    for i, (k, text) in enumerate(rows):
        following, n = rows[(i + 1) % len(rows)][1], len(text) // 4
        edited = text[: len(text) - n] + following[:n]
        a, b, c = plain_print(text), plain_print(edited), plain_print(following)
        out.append((k, len(text), hashlib.sha256(edited.encode()).hexdigest(), shown(a), shown(b), round(plain_likeness(a, b), 12), round(plain_likeness(a, c), 12)))
    return out


def result(df):
    order = lambda r: (r[0] is not None, *map(repr, r))
    return sorted(((*r[:5], round(r[5], 12), round(r[6], 12)) for r in df.collect()), key=order)


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, *map(repr, r)))


def test_edits_equal_plain_loops(docs, empty_docs):
    assert result(P.edits(docs)) == in_order(expected([(r.doc_id, r.text) for r in docs.collect()]))
    assert P.edits(empty_docs).count() == 0


def test_null_and_repeated_ids_clashing_columns_and_one_document(spark):
    long = "sixty four letters of prose that go on and on, over and over again; "
    rows = [(None, long), (None, long), (None, None), (7, "a"), (7, "a"), (7, "a"), (7, long * 3), (9, "\U0001f600x" * 40), (8, "")]
    df = spark.createDataFrame([(k, t, 1, "x") for k, t in rows], "doc_id long, text string, hash int, next string")
    assert result(P.edits(df)) == in_order(expected(rows))
    assert result(P.edits(df.limit(1))) == in_order(expected(rows[:1]))


def test_short_texts_with_and_without_anchors(spark):
    rng = random.Random(8)
    rows = [(i, "".join(rng.choice("abcd ") for _ in range(rng.randint(0, 32)))) for i in range(300)]
    assert sum(not plain_anchors(t) and len(t) >= P.K for _, t in rows) > 3
    assert result(P.edits(spark.createDataFrame(rows, "doc_id long, text string"))) == in_order(expected(rows))


def test_long_texts_are_the_sum_of_their_segments(spark, monkeypatch):
    rng = random.Random(4)
    text = "".join(rng.choice("abcdefghij klmnop é") for _ in range(3000))
    df = spark.createDataFrame([(1, text), (2, text[:800] + "x" + text[801:])], "doc_id long, text string")
    whole = result(P.edits(df))
    monkeypatch.setattr(P, "SEGMENT", 100)
    assert result(P.edits(df)) == whole == in_order(expected([(1, text), (2, text[:800] + "x" + text[801:])]))


def test_a_text_of_megabytes(spark):
    words = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(400_000)), lambda i: F.hex(F.xxhash64(i) % 100_000)), " ")
    df = spark.range(1).select(F.col("id").alias("doc_id"), words.alias("text"))
    row = P.edits(df).collect()[0]
    assert row.n_chars > 3_000_000 and 0.6 < row.near_edited < 1 and row.near_next == 1.0


def test_hot_ids_spread_over_ranges(spark):
    rows = spark.range(4000).select(F.lit(5).cast("long").alias("id"), F.concat(F.lit("text "), "id").alias("text")).withColumn("hash", F.xxhash64("text"))
    found = P.with_next(rows, rows, ["text"]).withColumn("task", F.spark_partition_id())
    got = {r.text: r.next_text for r in found.collect()}
    at, seen = "text 0", 0
    while seen < 4000:
        at, seen = got[at], seen + 1
        if at == "text 0":
            break
    assert seen == 4000
    assert max(r["count"] for r in found.groupBy("task").count().collect()) < 3000


def test_no_python_in_the_plan(spark, docs):
    plan = P.edits(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


@pytest.mark.parametrize("edit", ["insert", "swap"])
def test_anchors_ignore_where_a_passage_stands(spark, edit):
    rng = random.Random(2)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(400))
    other = "some new words in front " + passage if edit == "insert" else passage[200:] + passage[:200]
    df = spark.createDataFrame([(passage, other)], "a string, b string")
    a, b = df.select(P.fingerprint(F.col("a")), P.fingerprint(F.col("b"))).first()
    assert {x >> 32 for x in b} & {x >> 32 for x in a} and df.select(P.likeness(P.fingerprint(F.col("a")), P.fingerprint(F.col("b")))).first()[0] > 0.7
