"""Helpers that the operators share: the shared folder, gapless numbers and connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..staging import shared_path, written

__all__ = ["components", "gapless", "partitions", "shared_path", "spread_join", "written"]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def gapless(df: DataFrame, group: str, order: list[Column], salt: Column, out: str) -> DataFrame:
    """Number the rows of each group from 0 without gaps, whatever share of the rows a group holds.

    Rows of a group are dealt to buckets by ``salt``; a row's number is the size of the buckets before its own plus
    its place inside the bucket, so that no group meets in one task.  Only the bucket counts, which are partial sums,
    are ordered over a whole group.
    """
    buckets = 4 * partitions(df.sparkSession)
    rows = df.withColumn("__bucket", F.pmod(F.xxhash64(salt), F.lit(buckets)).cast("int"))
    counts = rows.groupBy(group, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(group, "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy(group, "__bucket").orderBy(*order)
    numbered = rows.withColumn("__at", F.row_number().over(inside).cast("long") - 1)
    joined = numbered.join(bases, [group, "__bucket"])
    return joined.withColumn(out, F.col("__base") + F.col("__at")).drop("__bucket", "__base", "__at")


def spread_join(rows: DataFrame, values: DataFrame, key: str, salt: Column, total: int, how: str = "inner") -> DataFrame:
    """``rows`` joined with the one row of ``values`` for their key, whatever share of the rows a key holds.

    ``values`` has a column n, how many rows its key has of about ``total``.  Rows of a key with more than half a
    partition's share are dealt to parts by ``salt``, and its value is repeated for each part; so are rows without a
    key.  n is dropped.
    """
    count = partitions(rows.sparkSession)
    share = max(1, total // (2 * count))
    parted = values.withColumn("__parts", F.when(F.col("n") > share, F.ceil(F.col("n") / share)).otherwise(1).cast("int"))
    # bounded: at most 2 * count keys have more than a share
    hot = F.broadcast(parted.filter("__parts > 1").select(key, F.col("__parts").alias("__of")))
    of = F.when(F.col(key).isNull(), count).otherwise(F.coalesce("__of", F.lit(1)))
    dealt = rows.join(hot, key, "left").withColumn("__part", F.pmod(F.xxhash64(salt), of).cast("int")).drop("__of")
    repeated = parted.withColumn("__part", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1))).drop("__parts", "n")
    return dealt.join(repeated, [key, "__part"], how).drop("__part")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b), component being the smallest node reachable.

    Large-star and small-star steps in turn, which need a number of rounds logarithmic in the number of nodes.  Each
    step joins the edges with one row per node (the smallest neighbour, a partial minimum), a hub's edges in parts, and
    writes its edges to the shared folder.  Self edges are allowed.
    """
    nodes = edges.select(F.col("a").alias("node")).union(edges.select(F.col("b").alias("node"))).distinct()
    now = written(
        edges.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    state = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    other = F.xxhash64("b")
    seen = state(now)
    for _ in range(rounds):
        if not seen[0]:
            break
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count_if(F.col("b") > F.col("a")).alias("n")), "least")
        large = spread_join(both.filter(F.col("b") > F.col("a")), least.filter("n > 0"), "a", other, seen[0])
        large = large.select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.filter(F.col("a") != F.col("b")).distinct(), "large")
        low = written(large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")), "low")
        small = spread_join(large, low, "a", other, seen[0]).select(F.col("b").alias("a"), F.col("m").alias("b")).filter(F.col("a") != F.col("b"))
        now = written(small.union(low.select("a", F.col("m").alias("b"))).distinct(), "edges")
        last, seen = seen, state(now)
        if last == seen:
            break
    else:
        raise RuntimeError("components did not settle")
    return nodes.join(now.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "node"), "node", "left").select(
        "node", F.coalesce("m", "node").alias("component")
    )
