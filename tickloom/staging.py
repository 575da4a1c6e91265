"""Tables written between steps, in the folder that driver and executors share."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from .params import KEYS


@functools.cache
def _local_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="spark-shared-")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder that driver and executors share (spark.checkpoint.dir).

    Only where that setting is missing, as in local tests, a temporary folder takes its place.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = _local_folder()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def bucketed(df: DataFrame, name: str, order: tuple[str, ...] = (), keys: tuple[str, ...] = KEYS) -> DataFrame:
    """The same rows from a table in the shared folder that is bucketed by ``keys`` and sorted by ``order`` in each bucket.

    Windows, groupings and joins by these keys then read it without an exchange.  There are as many buckets as shuffle
    partitions, so that they meet the results of exchanges as they are.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    table = re.sub(r"\W", "_", path.rpartition("/")[2])
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.repartition(count, *keys).write.format("parquet").bucketBy(count, *keys).sortBy(*keys, *order)
    writer.option("path", path).saveAsTable(table)
    return spark.table(table)


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows from a table written to the shared folder: lineage ends here, and lost executors lose nothing."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
