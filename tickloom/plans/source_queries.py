"""Queries of the sources, the incremental surface and the stateful stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import align
from ..params import KEYS
from ..sources import decode, history, json_text, readers, sinks
from ..staging import shared_path
from ..streaming import incremental, memory_book
from . import bindings as B
from . import oracle as O

_EV = {"ev": O.MARKET["ev"]}


def src01_lenient_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of every shape: one object, an array with a stray number, lines after a mark, objects in a row, none."""
    k = F.col("k")
    one, two = (F.to_json(F.struct(x.alias("k"))) for x in (k, k + 1))
    text = (
        F.when(k % 10 == 0, "").when(k % 4 == 0, one).when(k % 4 == 1, F.concat(F.lit("["), one, F.lit(", 5, "), two, F.lit("]")))
        .when(k % 4 == 2, F.concat(F.lit("\ufeff"), one, F.lit("\n\n"), two)).otherwise(F.concat(F.regexp_replace(one, ":", ":\n  "), two))
    )
    texts = B.events(spark, sf_dir).select(F.col("seq").alias("event_id"), text.alias("text"))
    return json_text.lenient_json(texts, "text", "k long").withColumn("pos", F.col("pos").cast("long"))


def src11_src13_decode_and_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positional last-price records to named columns, routed to the socket's symbol."""
    e = B.events(spark, sf_dir).filter("event_type = 'view'")
    values = [F.to_json(F.array(F.col("symbol"))), F.lit("2024-01-01T00:00:00+00:00")]
    record = F.concat(F.lit('["'), F.col("symbol"), F.lit('", "2024-01-01T00:00:00+00:00", '), F.concat_ws(", ", "value", "k", "k", F.lit("null"), F.lit("0"), "k", F.lit("0"), F.col("k") * 3), F.lit("]"))
    records = e.select("seq", F.lit("UpdateLastPrices").alias("command"), record.alias("record"), (F.col("k") % 10).alias("d"))
    found = decode.decode(records, "UpdateLastPrices")
    routed = decode.route(found, F.concat(F.lit("s"), F.col("d").cast("string")))
    return B.rounded(routed.select("seq", "symbol", "last_price", "last_volume", "deal_value", "active_buy_volume", "active_sell_volume"))


def src14_fetch_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month ranges from each customer's first order to a fixed day."""
    o = B.table(spark, sf_dir, "orders")
    universe = o.groupBy(F.col("o_custkey").alias("share_code")).agg(F.min("o_orderdate").cast("date").alias("ipo_date"))
    return B.rounded(readers.fetch_months(universe, "1998-06-15"))


def src14_history_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily files of each order priority read back by symbol and month: all of them, and one's days between bounds."""
    root = shared_path(spark, "history")
    bars = B.order_bars(spark, sf_dir)
    date = F.col("date").cast("string")
    path = F.concat_ws("/", "symbol", F.lit(history.GROUP), F.substring(date, 1, 4), F.concat(date, F.lit(".json")))
    record = F.to_json(F.struct(F.concat(date, F.lit("T00:00:00")).alias("date"), "symbol", F.col("low").alias("priceLow"), F.col("volume").alias("totalVolume")))
    sinks.write_bundles(bars.select(path.alias("path"), record.alias("value")), root).write.format("noop").mode("overwrite").save()
    universe = bars.groupBy(F.col("symbol").alias("share_code")).agg(F.min("date").alias("ipo_date"))
    every = history.read_history(universe, root, "1998-06-15")
    some = history.read_history(universe.filter("share_code = '1-URGENT'"), root, "1996-02-20", "1995-03-10")
    both = every.withColumn("bounded", F.lit(False)).unionByName(some.withColumn("bounded", F.lit(True)))
    return B.rounded(both.select("bounded", "symbol", "trading_date", "asked_first", "asked_last", F.col("priceLow").cast("double").alias("low"), F.col("totalVolume").cast("double").alias("volume")))


def _manifests(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    e = B.events(spark, sf_dir).select(*KEYS, F.concat(F.lit("f"), (F.col("k") % 4).cast("string")).alias("path"), F.col("seq").alias("mtime"), F.col("k").alias("size"), "seq")
    return incremental.manifest(e.filter("seq % 50 <> 0")), incremental.manifest(e.filter("seq % 37 <> 0 and not (symbol = 'S3' and seq % 2 = 0 and trading_date < date'2024-01-03')"))


_FILES = _EV | {
    "src": "SELECT symbol, trading_date, 'f' || CAST(k % 4 AS VARCHAR) AS path, seq, k FROM ev",
    "m0": "SELECT path, symbol, trading_date, max(k) AS s, max(seq) AS m FROM src WHERE seq % 50 <> 0 GROUP BY ALL",
    "m1": "SELECT path, symbol, trading_date, max(k) AS s, max(seq) AS m FROM src WHERE seq % 37 <> 0 AND NOT (symbol = 'S3' AND seq % 2 = 0 AND trading_date < DATE '2024-01-03') GROUP BY ALL",
}


def sm02_dirty_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.rounded(incremental.dirty_days(*_manifests(spark, sf_dir)))


def snk03_sm03_removed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, now = _manifests(spark, sf_dir)
    return B.rounded(incremental.removed_days(before, now.filter("symbol <> 'S4'")))


def sm07_memory_book_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deep book by the stateful stream over all rows; equal to the batch form."""
    line = align.timeline(B.snapshots(spark, sf_dir), B.books(spark, sf_dir), B.trades(spark, sf_dir))
    source, out, state = (shared_path(spark, f"stream-{x}") for x in ("in", "out", "state"))
    line.repartition(1 + spark.sparkContext.defaultParallelism, *KEYS).write.parquet(source)
    memory_book.use_rocksdb(spark)
    stream = memory_book.memory_book(spark.readStream.schema(line.schema).parquet(source), B.MEMORY)
    query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()
    return B.rounded(spark.read.schema(stream.schema).parquet(out))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (src01_lenient_json, src11_src13_decode_and_route, src14_fetch_months, src14_history_source, sm02_dirty_days, snk03_sm03_removed_days, sm07_memory_book_stream)}


_STREAM = (["price", "last_observed_volume", "max_observed_volume", "executed_volume_at_price", "wall_suspicion_score"], ["symbol", "trading_date", "frame_no", "side", "state", "reappeared_count", "stale_age_ms"])


def oracle_sql() -> dict[str, str]:
    return {
        "src01_lenient_json": O.sql(_EV, "SELECT seq AS event_id, CAST(p AS BIGINT) AS pos, k + p AS k FROM ev, (VALUES (0), (1)) t(p) WHERE k % 10 <> 0 AND (p = 0 OR k % 4 <> 0)"),
        "src11_src13_decode_and_route": O.sql(
            _EV,
            """SELECT seq, symbol, round(value, 6) + 0.0 AS last_price, CAST(k AS DOUBLE) AS last_volume, CAST(NULL AS DOUBLE) AS deal_value, CAST(k AS DOUBLE) AS active_buy_volume, CAST(2 * k AS DOUBLE) AS active_sell_volume
            FROM ev WHERE event_type = 'view' AND symbol = 'S' || CAST(k % 10 AS VARCHAR)""",
        ),
        "src14_fetch_months": """SELECT share_code, CAST(greatest(m, ipo_date) AS VARCHAR) AS first, CAST(least(last_day(m), DATE '1998-06-15') AS VARCHAR) AS last FROM (
            SELECT share_code, ipo_date, CAST(unnest(generate_series(date_trunc('month', ipo_date)::TIMESTAMP, TIMESTAMP '1998-06-01', INTERVAL 1 MONTH)) AS DATE) AS m
            FROM (SELECT o_custkey AS share_code, CAST(min(o_orderdate) AS DATE) AS ipo_date FROM orders GROUP BY ALL) WHERE ipo_date <= DATE '1998-06-15')""",
        "src14_history_source": f"""WITH bars AS (SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS d, min(o_totalprice) AS low, CASE WHEN day(max(CAST(o_orderdate AS DATE))) <> 23 THEN count(*) * 100.0::DOUBLE END AS volume FROM orders GROUP BY ALL),
            listed AS (SELECT symbol, min(d) AS ipo FROM bars GROUP BY ALL),
            asked AS (SELECT *, false AS bounded, ipo AS a, DATE '1998-06-15' AS b FROM listed UNION ALL
                SELECT *, true, greatest(ipo, DATE '1995-03-10'), DATE '1996-02-20' FROM listed WHERE symbol = '1-URGENT')
            SELECT bounded, symbol, CAST(d AS VARCHAR) AS trading_date, CAST(greatest(a, CAST(date_trunc('month', d) AS DATE)) AS VARCHAR) AS asked_first,
            CAST(least(b, last_day(d)) AS VARCHAR) AS asked_last, round(low, 6) + 0.0 AS low, volume FROM bars JOIN asked USING (symbol) WHERE d BETWEEN a AND b""",
        "sm02_dirty_days": O.sql(
            _FILES, "SELECT DISTINCT symbol, CAST(trading_date AS VARCHAR) AS trading_date FROM m0 FULL JOIN m1 USING (path, symbol, trading_date) WHERE m0.s IS DISTINCT FROM m1.s OR m0.m IS DISTINCT FROM m1.m"
        ),
        "snk03_sm03_removed_days": O.sql(_FILES, "SELECT DISTINCT symbol, CAST(trading_date AS VARCHAR) AS trading_date FROM m0 WHERE (symbol, trading_date) NOT IN (SELECT (symbol, trading_date) FROM m1 WHERE symbol <> 'S4')"),
        "sm07_memory_book_stream": O.sql(O.MARKET | O.DEEP, "SELECT " + O.columns(*_STREAM) + " FROM deep"),
    }
