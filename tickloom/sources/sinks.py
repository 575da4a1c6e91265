"""Sinks: partitioned tables by symbol and day, replaced, appended to or removed by partition."""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import exprs as X
from ..params import KEYS, LOCAL_SHIFT_HOURS


def replace_days(df: DataFrame, path: str) -> None:
    """Overwrites only the (symbol, trading_date) partitions that ``df`` has; commits as a whole."""
    df.repartition(*KEYS).sortWithinPartitions(*KEYS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*KEYS).parquet(path)


def _delete(uri: str) -> None:
    store, path = fs.FileSystem.from_uri(uri)
    if store.get_file_info(path).type == fs.FileType.Directory:
        store.delete_dir(path)


def listed(spark: SparkSession, path: str) -> DataFrame:
    """The files of a table partitioned by symbol and day: path, keys, size and mtime, by listing, without reading a row."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, symbol string, trading_date date, size long, mtime timestamp")
    # names of folders are escaped, and the listing escapes them once more
    plain = lambda c: F.url_decode(F.url_decode(F.regexp_replace(c, r"\+", "%252B")))
    value = lambda c: F.nullif(plain(F.regexp_extract("path", f"/{c}=([^/]*)/", 1)), F.lit("__HIVE_DEFAULT_PARTITION__"))
    return files.select("path", value("symbol").alias("symbol"), value("trading_date").cast("date").alias("trading_date"), F.col("length").alias("size"), F.col("modificationTime").alias("mtime"))


def remove_days(spark: SparkSession, path: str, gone: DataFrame) -> None:
    """Deletes the partitions of days whose input vanished; their folders are found by listing."""
    days = gone.select(*KEYS).distinct()
    folders = listed(spark, path).join(days, list(KEYS), "left_semi").select(F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("f")).distinct()
    with ThreadPoolExecutor(16) as pool:
        list(pool.map(_delete, (r.f for r in folders.toLocalIterator())))


#: Lines of one file of a batch, about.
FILE_LINES = 100_000


def append_lines(records: DataFrame, root: str, command: str, batch: int) -> None:
    """Writes a batch's records of one command as lines to root/SYMBOL/command/year/date-batch-part.json.

    The place is that which the feed's readers look for, the time of arrival is local.  Files of one symbol beyond
    ``FILE_LINES`` are several, so that no task gathers all lines of a busy one; a repeated batch replaces its files.
    """
    rows = records.count()
    if not rows:
        return
    local = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()) + F.expr(f"INTERVAL {LOCAL_SHIFT_HOURS} HOURS")
    head = {"ts": F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), "command": F.lit(command), "symbol": X.clean_symbol(F.col("symbol"))}
    rest = [c for c in records.columns if c not in head]
    lines = records.select(*[v.alias(k) for k, v in head.items()], *rest)
    text = lines.select("symbol", "ts", F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    part = F.pmod(F.xxhash64("value"), F.lit(-(-rows // FILE_LINES)))
    day = F.substring("ts", 1, 10)
    path = F.concat_ws("/", "symbol", F.lit(command.lower()), F.substring("ts", 1, 4), F.concat(day, F.lit(f"-{batch:09d}-"), part.cast("string"), F.lit(".json")))
    files = text.select(path.alias("path"), "value").groupBy("path").agg(F.array_join(F.array_sort(F.collect_list("value")), "\n").alias("value"))
    write_bundles(files, root).write.format("noop").mode("overwrite").save()


def append_stream(records: DataFrame, path: str, checkpoint: str, seconds: int | None = 5) -> StreamingQuery:
    """Appends decoded records by symbol, year and wall-clock day; without ``seconds`` it ends when all input is read."""
    dated = records.withColumn("ts", F.current_timestamp()).withColumns({"year": F.year("ts"), "date": F.to_date("ts")})
    writer = dated.writeStream.format("json").partitionBy("symbol", "year", "date").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=f"{seconds} seconds") if seconds else writer.trigger(availableNow=True)).start()


def bundles(df: DataFrame, order: str = "frame_no") -> DataFrame:
    """One JSON text per row for export, in frame order within each day."""
    return df.repartition(*KEYS).sortWithinPartitions(*KEYS, order).select(*KEYS, F.to_json(F.struct("*")).alias("value"))


def day_bundles(df: DataFrame, folder: str, order: str = "frame_no") -> DataFrame:
    """One JSON text per day: keys, frame_count and its rows in order; with the export path symbol/folder/year/date.json.

    A day's rows meet in one task, which holds a few times their text.
    """
    rest = [c for c in df.columns if c not in KEYS]
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("__o"), F.struct(*rest).alias("x")))), lambda r: r["x"])
    days = df.groupBy(*KEYS).agg(ordered.alias("frames"), F.count(F.lit(1)).alias("frame_count"))
    date = F.col("trading_date").cast("string")
    path = F.concat_ws("/", X.clean_symbol(F.col("symbol")), F.lit(folder), F.substring(date, 1, 4), F.concat(date, F.lit(".json")))
    return days.select(*KEYS, path.alias("path"), F.to_json(F.struct("symbol", date.alias("trading_date"), "frame_count", "frames")).alias("value"))


def write_bundles(bundles: DataFrame, root: str) -> DataFrame:
    """Writes each text to its path below ``root``, under a name of the attempt that is then renamed; returns the paths."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            for path, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                target = f"{base}/{path}"
                store.create_dir(target.rpartition("/")[0])
                with store.open_output_stream(f"{target}.{attempt}.tmp") as out:
                    out.write(value.encode())
                store.move(f"{target}.{attempt}.tmp", target)
            yield batch.select(["path"])

    return bundles.select("path", "value").mapInArrow(put, "path string")


def replace_daily(df: DataFrame, path: str) -> None:
    """Daily records by date: overwrites only the dates that ``df`` has."""
    df.repartition("date").sortWithinPartitions("date", "symbol").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)
