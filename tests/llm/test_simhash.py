import re
import string

import xxhash

from tickloom.llm.simhash import near_duplicates

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_print(text):
    low = (text or "").translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
    words = WORD.findall(low)
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    prints = {k: brute_print(t) for k, t in rows}
    label = {k: k for k in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if label[b] < label[a] and (prints[a] ^ prints[b]).bit_count() <= 2:
                    label[a], changed = label[b], True
    return {k: (f"{prints[k]:016x}", label[k]) for k in prints}


def test_against_brute_force(docs):
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in near_duplicates(docs).collect()} == want
    assert len({c for _, c in want.values()}) < len(want)


def test_components_by_planted_prints(spark):
    """A chain of prints two bits apart is one component; three bits apart is not linked."""
    from tickloom.llm.shared import components
    from tickloom.llm.simhash import linked

    chain = [0b0, 0b11, 0b1111, 0b111111, 1 << 20 | 0b111000000, -1]
    edges = linked(spark.createDataFrame([(x,) for x in chain], "print long"))
    assert {r.node: r.component for r in components(edges).collect()} == {0: 0, 3: 0, 15: 0, 63: 0}


def test_long_paths_and_hubs(spark):
    from tickloom.llm.shared import components

    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5000)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert set(got.values()) == {0, 1000, 5000} and len(got) == 301 + 200 + 1


def test_empty_and_repeated(spark, empty_docs):
    assert near_duplicates(empty_docs).count() == 0
    rows = near_duplicates(spark.createDataFrame([(1, "a b"), (1, "a b"), (2, "A  B")], "doc_id long, text string")).collect()
    assert len(rows) == 3 and {r.component_id for r in rows} == {1}


def test_null_ids_and_clashing_columns(spark):
    rows = [(None, "a b", 1, "x"), (4, "a b", 2, "y"), (None, "quite another text of words", 3, "z"), (9, None, 4, None)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, print int, root string")).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in got) == [("4", "4"), ("9", "9"), ("None", "4"), ("None", "None")]


def test_a_key_with_half_of_the_rows_is_spread(spark):
    from pyspark.sql import functions as F

    from tickloom.llm.shared import spread_join

    rows = spark.range(4000).select(F.when(F.col("id") < 2000, 7).when(F.col("id") < 2500, None).otherwise(F.col("id")).alias("k"), "id")
    values = rows.filter("k is not null").groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        joined = spread_join(rows, values, "k", F.col("id"), 4000, "left")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert max(sizes) < 900 and sum(sizes) == 4000
        got = joined.collect()
        assert {(r.k, r.v) for r in got if r.k == 7 or r.k is None} == {(7, 1999), (None, None)}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
