"""Queries of the composed plans, the run surface, sources and sinks through files, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import align, deep_book, features, normalize, rules
from ..operators.normalize import DAILY_FIELDS
from ..params import KEYS
from ..sources import decode, json_text, readers, sinks
from ..staging import shared_path, written
from ..streaming import incremental, live_feed, manifests
from . import bindings as B
from . import layer2, layer3, pipeline
from . import oracle as O
from .queries import _MEMORY, FRAME, NAMES, RULES, WINDOWS_MS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
_DAY = "CAST(trading_date AS VARCHAR) AS trading_date"


def query(sql: str, places: int = 6):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: B.rounded(f(spark, sf_dir), places)
        SQL[f.__name__] = sql
        return f

    return add


def _market(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return B.snapshots(spark, sf_dir), B.books(spark, sf_dir), B.trades(spark, sf_dir)


def _validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, b, t = _market(spark, sf_dir)
    return rules.validation_status(rules.rule_results(B.daily(spark, sf_dir), s, b, t), b, t)


# ---- degraded flags and status ---------------------------------------------------------------------------------

_AGE = "- 0.20::DOUBLE * least(1, stale_age_ms / 18000000.0::DOUBLE)"
_FLAGGED = _AGE + " - CASE WHEN book_total_depth_unusable THEN 0.08::DOUBLE ELSE 0 END - CASE WHEN trade_side_nullable THEN 0.04::DOUBLE ELSE 0 END"
_DEEP = O.MARKET | RULES | O.DEEP | {"deep": O.DEEP["deep"].replace(_AGE, _FLAGGED).replace("FROM deep0", "FROM deep0 LEFT JOIN flags USING (symbol, trading_date)")}


@query(O.sql(_DEEP, "SELECT " + O.columns(*_MEMORY) + " FROM deep"))
def l2p4_st06_deep_book_with_flags(spark, sf_dir):
    """The deep book with the degraded flags of the rules: unusable reported depth and trades without a side."""
    levels = pipeline.frames_with_memory(*_market(spark, sf_dir), B.WINDOWS, B.MEMORY, _validation(spark, sf_dir))[1]
    return levels.select(*_MEMORY[1], *_MEMORY[0])


_STATUS = {
    "verdict": """SELECT r.symbol, r.trading_date, CASE WHEN fails > 0 THEN 'fail' WHEN warns > 0 OR book_total_depth_unusable OR trade_side_nullable THEN 'degraded' ELSE 'pass' END AS status,
        CAST(book_total_depth_unusable AS INT) + CAST(trade_side_nullable AS INT) AS flag_count FROM (SELECT symbol, trading_date, count(*) FILTER (status = 'fail') AS fails,
        count(*) FILTER (status = 'warn') AS warns FROM results GROUP BY ALL) r JOIN flags USING (symbol, trading_date)"""
}
_JUDGED = (O.MARKET | RULES | _STATUS | O.ALL) | {
    "q2": O.STORE["q2"].replace("least(1, 1 - 0.20", "least(1, 1 - CASE status WHEN 'fail' THEN 0.35::DOUBLE WHEN 'degraded' THEN 0.15::DOUBLE ELSE 0 END - 0.10::DOUBLE * least(flag_count, 3) - 0.20", 1).replace(
        "FROM q1", "FROM q1 JOIN verdict USING (symbol, trading_date)"
    )
}
_SCORED = ["feature_confidence", "data_quality_score"]


@query(O.sql(_JUDGED, "SELECT " + O.columns(_SCORED, FRAME, places=9) + " FROM quality"), places=9)
def dq14_quality_with_status_and_flags(spark, sf_dir):
    """Feature confidence with the penalties for the day's validation status and degraded flags."""
    args = (B.daily(spark, sf_dir), B.event_bars(spark, sf_dir), B.WINDOWS, B.MEMORY, NAMES, WINDOWS_MS)
    return pipeline.feature_frames(*_market(spark, sf_dir), *args, validation=_validation(spark, sf_dir)).select(*FRAME, *_SCORED)


@query(
    O.sql(
        O.MARKET | O.DEEP,
        f"""SELECT {_DAY}, symbol, frame_count, coalesce(walls, 0) AS frames_with_wall_candidates FROM (SELECT symbol, trading_date, count(*) AS frame_count FROM frames GROUP BY ALL) f
        LEFT JOIN (SELECT symbol, trading_date, count(DISTINCT frame_no) AS walls FROM deep WHERE state = 'SUSPECTED_FAKE_WALL' GROUP BY ALL) w USING (symbol, trading_date)""",
    )
)
def ag14_frames_with_wall_candidates(spark, sf_dir):
    return deep_book.day_summary(*pipeline.frames_with_memory(*_market(spark, sf_dir), B.WINDOWS, B.MEMORY))


@query(
    O.sql(
        O.MARKET,
        f"""SELECT {_DAY}, symbol, frame_no, seq, event_us AS deep_us FROM frames WHERE (symbol, trading_date) NOT IN (SELECT (symbol, trading_date) FROM frames WHERE seq % 29 = 0) AND symbol <> 'S5'""",
    )
)
def l3p0_jn07_joined_frames(spark, sf_dir):
    """Two frame tables as one: a day with a lost frame goes to quarantine, a symbol that only one has is left out."""
    frames = align.align(*_market(spark, sf_dir), B.WINDOWS).select(*FRAME, "event_us", "seq")
    deep = frames.filter("seq % 29 <> 0 and symbol <> 'S5'").select(*FRAME, "event_us", F.col("event_us").alias("deep_us"))
    return features.joined_frames(frames, deep)[0].select(*FRAME, "seq", "deep_us")


# ---- the feed's files ------------------------------------------------------------------------------------------


def _iso(us: Column) -> Column:
    """Microseconds as ISO text in UTC."""
    moment = F.timestamp_micros(us)
    return F.concat(F.date_format(F.to_utc_timestamp(moment, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))


def _feed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(symbol, trading_date, group, seq, value): every record of the market as a line of the feed."""
    time = [_iso(F.col("event_us")).alias("event_time"), _iso(F.col("ingested_us")).alias("ts")]
    text = lambda df, *names: F.to_json(F.struct(*time, *[F.col(n) if "levels" in n else F.col(n).cast("string").alias(n.removeprefix("reported_")) for n in names]))
    s, b, t = _market(spark, sf_dir)
    d = B.daily(spark, sf_dir)
    bar = F.to_json(F.struct(F.col("trading_date").cast("string").alias("date"), *[F.col(v).alias(k) for k, v in DAILY_FIELDS.items() if v in d.columns]))
    numbers = ("last_price", "deal_volume", "deal_value", "active_buy_volume", "active_sell_volume")
    parts = [
        d.select(*KEYS, F.lit("historical_price").alias("group"), F.lit(0).cast("long").alias("seq"), bar.alias("value")),
        s.select(*KEYS, F.lit("updatelastprices").alias("group"), "seq", text(s, *numbers).alias("value")),
        b.select(*KEYS, F.lit("updateorderbooks").alias("group"), "seq", text(b, "reported_total_bid_volume", "reported_total_ask_volume", "bid_levels", "ask_levels").alias("value")),
        t.select(*KEYS, F.lit("updatetrades").alias("group"), "seq", text(t, "trade_id", "price", "volume", "side").alias("value")),
    ]
    return B.union(parts)


def _write_feed(spark: SparkSession, sf_dir: str) -> str:
    """The market as files root/SYMBOL/group/year/date.json, one object a line in the order of the events."""
    root = shared_path(spark, "feed")
    date = F.col("trading_date").cast("string")
    lines = F.transform(F.array_sort(F.collect_list(F.struct("seq", "value"))), lambda x: x["value"])
    files = _feed_rows(spark, sf_dir).groupBy(*KEYS, "group").agg(F.concat(F.concat_ws("\n", lines), F.lit("\n{broken\n")).alias("value"))
    path = F.concat_ws("/", F.lower("symbol"), "group", F.substring(date, 1, 4), F.concat(date, F.lit(".json")))
    sinks.write_bundles(files.select(path.alias("path"), "value"), root).write.format("noop").mode("overwrite").save()
    return root


@query(
    O.sql(
        O.MARKET,
        f"""SELECT {_DAY}, symbol, CASE event_type WHEN 'view' THEN 'snapshots' WHEN 'click' THEN 'books' ELSE 'trades' END AS name, count(*) AS records FROM ev WHERE symbol IN ('S1', 'S2') GROUP BY ALL
        UNION ALL SELECT {_DAY}, symbol, 'daily', 1 FROM dly WHERE symbol IN ('S1', 'S2')""",
    )
)
def l2p0_src04_read_raw(spark, sf_dir):
    """The four groups of two symbols from the feed's files, by file; each file's broken line is left out."""
    raw, _ = layer2.read_raw(spark, _write_feed(spark, sf_dir), " s1,S2,")
    return B.union([df.groupBy("symbol", F.col("file_date").alias("trading_date")).agg(F.count(F.lit(1)).alias("records")).withColumn("name", F.lit(n)) for n, df in raw.items()])


_IN_SESSION = "((local_us % 86400000000 >= 32400000000 AND local_us % 86400000000 < 41400000000) OR local_us % 86400000000 BETWEEN 46800000000 AND 53100000000)"
_SESSION = {"ev": f"SELECT * FROM ({O.MARKET['ev']}) WHERE {_IN_SESSION}"}
_FROM_FILES = O.MARKET | _SESSION | RULES | O.DEEP | {"deep": _DEEP["deep"]}


@query(O.sql(_FROM_FILES, "SELECT " + O.columns(*_MEMORY) + " FROM deep"))
def l2_files_to_deep_book(spark, sf_dir):
    """The feed's files read, normalized, gated by session, validated, aligned, and the remembered levels with flags."""
    found = layer2.run(spark, _write_feed(spark, sf_dir), None, B.WINDOWS, B.MEMORY)
    return found.levels.select(*_MEMORY[1], *_MEMORY[0])


_DAILY = [
    "price_open", "price_high", "price_low", "price_close", "total_volume",
    "deal_volume", "putthrough_volume", "putthrough_value", "buy_foreign_quantity", "sell_foreign_quantity",
    "prop_net_deal_value", "prop_net_pt_value", "prop_net_value", "unit",
]


@query(O.sql(O.MARKET, "SELECT " + O.columns(_DAILY, ["symbol", "trading_date"]) + " FROM dly"))
def fn16_normalize_daily(spark, sf_dir):
    """Daily records from files to bars: the feed's names, numbers as text."""
    raw, _ = layer2.read_raw(spark, _write_feed(spark, sf_dir))
    return normalize.normalize_daily(raw["daily"]).select(*KEYS, *_DAILY)


_CHAIN = {
    "chain": """SELECT seq, CASE WHEN k % 6 = 0 THEN CAST(trading_date AS VARCHAR) END AS local_day, CASE WHEN k % 6 = 1 THEN '2023-05-06' END AS event_day, CASE WHEN k % 4 = 2 THEN '2023-01-02' END AS trading_day,
        CASE WHEN k % 6 = 3 THEN '2023-02-03' END AS ingest_day, CASE WHEN k % 6 = 4 THEN '2023-03-04' END AS own_day, CASE WHEN k % 7 <> 0 THEN '2023-04-05' END AS file_day FROM ev"""
}


@query(
    O.sql(
        {"ev": O.MARKET["ev"]} | _CHAIN,
        """SELECT * FROM (SELECT seq, 'trade' AS source, coalesce(local_day, trading_day, event_day, ingest_day, file_day) AS trading_date FROM chain
        UNION ALL SELECT seq, 'book', coalesce(local_day, event_day, ingest_day, own_day, file_day) FROM chain
        UNION ALL SELECT seq, 'daily', coalesce(own_day, trading_day, file_day) FROM chain) WHERE trading_date IS NOT NULL""",
    )
)
def fn04_flt02_trading_date_chains(spark, sf_dir):
    """A record's day by the fallbacks of its source; records without any are left out."""
    k, text = F.col("k"), F.lit
    raw = B.events(spark, sf_dir).select(
        "seq",
        F.lit("A").alias("symbol"),
        F.when(k % 6 == 0, _iso(F.col("event_us"))).when(k % 6 == 1, "2023-05-06 at noon").alias("event_time"),
        F.when(k % 4 == 2, text("2023-01-02")).alias("trading_date"),
        F.when(k % 6 == 3, text("2023-02-03T00:00:00")).alias("ts"),
        F.when(k % 6 == 4, text("2023-03-04")).alias("date"),
        F.when(k % 7 != 0, text("2023-04-05")).alias("file_date"),
    ).withColumns({"bid_levels": F.lit(None).cast("array<struct<price:string,volume:string>>"), "ask_levels": F.lit(None).cast("array<struct<price:string,volume:string>>")})
    numbered = raw.withColumn("priceOpen", F.col("seq"))
    parts = {
        "trade": normalize.normalize_trades(raw, keep=("seq",)),
        "book": normalize.normalize_books(raw, keep=("seq",)),
        "daily": normalize.normalize_daily(numbered).withColumn("seq", F.col("price_open").cast("long")),
    }
    return B.union([df.select("seq", F.lit(n).alias("source"), "trading_date") for n, df in parts.items()])


@query(
    O.sql(
        {"ev": O.MARKET["ev"]},
        f"""SELECT symbol, {_DAY}, CASE k % 2 WHEN 0 THEN 'bid' ELSE 'ask' END AS side, CASE k % 2 WHEN 0 THEN list_reverse_sort(list(round(value, 2))) ELSE list_sort(list(round(value, 2))) END AS prices
        FROM ev GROUP BY symbol, trading_date, k % 2""",
    )
)
def fn33_sort_prices(spark, sf_dir):
    e = B.events(spark, sf_dir).withColumn("side", F.when(F.col("k") % 2 == 0, "bid").otherwise("ask"))
    return e.groupBy(*KEYS, "side").agg(F.collect_list(F.round("value", 2)).alias("p")).select(*KEYS, "side", X.sort_prices(F.col("p"), F.col("side")).alias("prices"))


@query("""SELECT event_id, event_type, 'U' || CAST(user_id AS VARCHAR) AS symbol FROM events""")
def src01_split_files(spark, sf_dir):
    """Files that Spark may split anywhere: a user's events as an indented list, or printed one after another."""
    root = shared_path(spark, "split-feed")
    events = B.table(spark, sf_dir, "events").select("user_id", F.struct(F.col("event_id").alias("trade_id"), F.col("event_type").alias("side")).alias("x"))
    users = events.groupBy("user_id").agg(F.collect_list("x").alias("x"))
    printed = F.array_join(F.transform("x", lambda x: F.to_json(x, {"pretty": "true"})), "\n")
    value = F.when(F.col("user_id") % 2 == 0, F.to_json("x", {"pretty": "true"})).otherwise(printed)
    path = F.concat(F.lit("U"), F.col("user_id").cast("string"), F.lit("/updatetrades/2024-01-02.json"))
    sinks.write_bundles(users.select(path.alias("path"), value.alias("value")), root).write.format("noop").mode("overwrite").save()
    found, _ = readers.split_broken(readers.read_lenient(spark, root, "updatetrades", whole=False))
    return found.select(F.col("trade_id").cast("long").alias("event_id"), F.col("side").alias("event_type"), "symbol")


@query("""SELECT event_id, event_type, CAST(user_id AS BIGINT) AS user_id FROM events""")
def src03_read_objects(spark, sf_dir):
    """One object a file, read strictly: a file for each user with all of that user's events."""
    root = shared_path(spark, "objects")
    users = B.table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_list(F.struct("event_id", "event_type")).alias("events"))
    files = users.select(F.concat(F.col("user_id").cast("string"), F.lit(".json")).alias("path"), F.concat(F.lit("\ufeff"), F.to_json(F.struct("user_id", "events"))).alias("value"))
    sinks.write_bundles(files, root).write.format("noop").mode("overwrite").save()
    found = readers.read_objects(spark, [root], "user_id long, events array<struct<event_id: long, event_type: string>>")
    return found.select("user_id", F.explode("events").alias("x")).select("x.event_id", "x.event_type", "user_id")


@query("""SELECT CAST(o_custkey AS VARCHAR) AS share_code, CAST(min(CAST(o_orderdate AS DATE)) AS VARCHAR) AS ipo_date FROM orders GROUP BY ALL""")
def src16_read_universe(spark, sf_dir):
    path = shared_path(spark, "universe")
    o = B.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").cast("date").alias("d"))
    o.select(F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit(","), F.col("d").cast("string")).alias("value")).write.text(path)
    return readers.read_universe(spark, path)


# ---- binary frames and decoders --------------------------------------------------------------------------------


def _packed_text(text: Column) -> Column:
    raw = F.encode(text, "utf-8")
    return F.concat(F.unhex(F.lit("DA")), F.unhex(F.lpad(F.hex(F.octet_length(raw)), 4, "0")), raw)


def _packed_int(value: Column) -> Column:
    return F.concat(F.unhex(F.lit("D3")), F.unhex(F.lpad(F.hex(value.cast("long")), 16, "0")))


def _packed_list(*items: Column) -> Column:
    return F.concat(F.unhex(F.lit(f"DC{len(items):04X}")), *items)


@query(
    O.sql(
        O.MARKET,
        """SELECT seq, symbol, seq AS trade_id, CAST(k AS DOUBLE) AS price, CAST(k * 10 AS DOUBLE) AS volume, CASE event_type WHEN 'purchase' THEN 'B' WHEN 'error' THEN 'S' ELSE 'x' END AS side, '2024-01-02' AS trading_date
        FROM ev WHERE event_type IN ('purchase', 'error', 'signup')""",
    )
)
def src09_src10_src12_frames_to_trades(spark, sf_dir):
    """MessagePack frames of trades, some behind a broken byte, opened, and decoded by position."""
    e = B.events(spark, sf_dir).filter("event_type in ('purchase', 'error', 'signup')")
    text = lambda v: _packed_text(F.lit(v) if isinstance(v, str) else v)
    side = F.when(F.col("event_type") == "purchase", "B").when(F.col("event_type") == "error", "S").otherwise("x")
    record = _packed_list(_packed_int(F.col("seq")), text("2024-01-02T02:15:00+00:00"), _packed_int(F.col("k")), _packed_int(F.col("k") * 10), text(side), text("2024-01-02T00:00:00"))
    frame = _packed_list(_packed_int(F.lit(1)), text("UpdateTrades"), _packed_list(text(F.col("symbol")), _packed_list(record)))
    whole = F.when(F.col("k") % 5 == 0, F.concat(F.unhex(F.lit("C1")), frame)).otherwise(frame)
    found = decode.decode(decode.open_frames(e.select("seq", whole.alias("frame"))), "UpdateTrades")
    return found.select("seq", "symbol", "trade_id", "price", "volume", "side", "trading_date")


@query(
    O.sql(
        O.MARKET,
        """SELECT seq, 'UpdateRefPrices' AS command, symbol, CAST(k AS DOUBLE) AS a, value + 0.0 AS b, 'open' AS c FROM ev UNION ALL SELECT seq, 'UpdateOrderBooks', symbol, CAST(k AS DOUBLE), CAST(k AS DOUBLE), '2' FROM ev
        UNION ALL SELECT seq, 'UpdateForeignerStats', symbol, CAST(k AS DOUBLE), CAST(NULL AS DOUBLE), NULL FROM ev UNION ALL SELECT seq, 'UpdateSymbols', symbol, CAST(k AS DOUBLE), 1.0::DOUBLE, 'HSX' FROM ev""",
    )
)
def src12_other_decoders(spark, sf_dir):
    """Reference prices, order books, foreign statistics and symbols by position: some fields of each."""
    e = B.events(spark, sf_dir)
    k, v = F.col("k").cast("string"), F.col("value").cast("string")
    one = lambda *items: F.concat(F.lit("["), F.concat_ws(", ", F.concat(F.lit('"'), F.col("symbol"), F.lit('"')), *[F.lit(i) if isinstance(i, str) else i for i in items]), F.lit("]"))
    level = F.concat(F.lit("[["), k, F.lit(", 5], [1, 2]]"))
    at = '"2024-01-01T00:00:00Z"'
    records = {
        "UpdateRefPrices": (one(at, k, v, "null", "1", "2", "3", '"open"', '"2024-01-01"'), F.col("reference_price"), F.col("ceiling_price"), F.col("market_status")),
        "UpdateOrderBooks": (one(at, k, "7", level, "[]"), F.col("total_bid_volume"), F.col("bid_levels")[0]["price"], F.size("bid_levels").cast("string")),
        "UpdateForeignerStats": (one(at, k, "null", "null", "4", "5"), F.col("currentForeignRoom"), F.col("buy_volume"), F.lit(None).cast("string")),
        "UpdateSymbols": (one('"stock"', '"name"', '"HSX"', "true", '"100"', "null", "null", "null", k), F.col("multiplier"), F.col("is_active").cast("double"), F.col("exchange")),
    }
    parts = []
    for command, (record, a, b, c) in records.items():
        found = decode.decode(e.select("seq", F.lit(command).alias("command"), record.alias("record")), command)
        parts.append(found.select("seq", "command", "symbol", a.cast("double").alias("a"), b.cast("double").alias("b"), c.alias("c")))
    return B.union(parts)


@query(
    O.sql(
        O.MARKET,
        """SELECT 'UpdateTrades' AS command, symbol, CAST(seq AS VARCHAR) AS key, CAST(k AS DOUBLE) AS price FROM ev WHERE event_type IN ('purchase', 'error', 'signup')
        UNION ALL SELECT 'UpdateLastPrices', symbol, CAST(k AS VARCHAR), CAST(k + 1 AS DOUBLE) FROM ev WHERE event_type = 'view'""",
    )
)
def snk01_src09_live_feed(spark, sf_dir):
    """Frames of two commands as a stream in two runs, decoded, appended to the feed's files and read back from them."""
    source, out, state = (shared_path(spark, f"live-{x}") for x in ("in", "out", "state"))
    e = B.events(spark, sf_dir).filter("event_type in ('purchase', 'error', 'signup', 'view')")
    text = lambda v: _packed_text(F.lit(v) if isinstance(v, str) else v)
    at, none = text("2024-01-02T02:15:00+00:00"), F.unhex(F.lit("C0"))
    trade = _packed_list(_packed_int(F.col("seq")), at, _packed_int(F.col("k")), _packed_int(F.lit(10)), text("B"), text("2024-01-02T00:00:00"))
    price = _packed_list(text(F.col("symbol")), at, _packed_int(F.col("k") + 1), _packed_int(F.lit(5)), _packed_int(F.col("k")), *[none] * 5)
    call = lambda command, body: _packed_list(_packed_int(F.lit(1)), text(command), body)
    is_price = F.col("event_type") == "view"
    frame = F.when(is_price, call("UpdateLastPrices", _packed_list(_packed_list(price)))).otherwise(call("UpdateTrades", _packed_list(text(F.col("symbol")), _packed_list(trade))))
    frames = e.select("seq", frame.alias("frame"))
    for part in ("seq % 3 <> 0", "seq % 3 = 0"):
        frames.filter(part).select("frame").write.mode("append").parquet(source)
        live_feed.append_feed(spark.readStream.schema("frame binary").parquet(source), out, state, seconds=None).awaitTermination()
    trades, _ = readers.split_broken(readers.read_lines(spark, out, "updatetrades"))
    prices, _ = readers.split_broken(readers.read_lines(spark, out, "updatelastprices"))
    shown = lambda df, key, value: df.select("command", "symbol", F.col(key).cast("double").cast("long").cast("string").alias("key"), F.col(value).cast("double").alias("price"))
    return shown(trades, "trade_id", "price").unionByName(shown(prices, "deal_volume", "last_price"))


@query(O.sql({"ev": O.MARKET["ev"]}, "SELECT seq, CASE WHEN k % 3 = 0 THEN 2 ELSE 1 END AS good, CASE WHEN k % 3 = 2 THEN 0 WHEN k % 5 = 0 THEN 2 ELSE 1 END AS bad FROM ev"))
def src02_broken_json_in_quarantine(spark, sf_dir):
    """Texts of which some stretches are broken: the records around them are read, the stretches are kept."""
    k = F.col("k")
    third = F.when(k % 3 == 0, '\n{"k": 3}\n{"k": oops}').when(k % 3 == 1, '\n{"k": nope').otherwise("")
    text = F.concat(F.when((k % 5 == 0) & (k % 3 != 2), '{"k" 1}\n').otherwise(""), F.lit('{"k": 2}'), third)
    found = json_text.lenient_json(B.events(spark, sf_dir).select("seq", text.alias("text")), "text", "k long", broken=True)
    return found.groupBy("seq").agg(F.count("k").alias("good"), F.count("broken_record").alias("bad"))


# ---- run surface and sinks -------------------------------------------------------------------------------------


@query(
    O.sql(
        O.MARKET,
        f"""SELECT DISTINCT symbol, {_DAY} FROM (SELECT symbol, trading_date FROM snap WHERE seq % 7 = 0 UNION ALL SELECT symbol, trading_date FROM book WHERE seq % 11 = 0 UNION ALL SELECT symbol, trading_date FROM trade)
        WHERE symbol <> 'S9'""",
    )
)
def sm05_dirty_days_of_three_inputs(spark, sf_dir):
    """Snapshots and books of which some files changed, trades seen for the first time; of all, the dirty days."""

    def files(df):
        rows = df.filter("symbol <> 'S9'").select(*KEYS, F.col("seq").cast("string").alias("path"), F.col("seq").alias("size"), F.col("event_us").alias("mtime"), "seq")
        return rows, incremental.manifest(rows)

    (s, s1), (b, b1), (_, t1) = (files(df) for df in _market(spark, sf_dir))
    before = lambda rows, n: incremental.manifest(rows.withColumn("size", F.when(F.col("seq") % n == 0, -1).otherwise(F.col("size"))))
    return incremental.dirty_union([(before(s, 7), s1), (before(b, 11), b1), (None, t1)])


@query(
    O.sql(
        {"ev": O.MARKET["ev"]} | {"d": "SELECT symbol, trading_date, bool_or(k = 13) AS bad, bool_and(symbol = 'S3') AS gone FROM ev GROUP BY ALL"},
        """SELECT count(*) AS dirty, count(*) FILTER (NOT gone AND NOT bad) AS built, count(*) FILTER (gone) AS removed, count(*) FILTER (NOT gone AND bad) AS failed,
        (SELECT count(*) FROM ev JOIN d USING (symbol, trading_date) WHERE NOT gone AND NOT bad) AS rows FROM d""",
    )
)
def sm06_run_once(spark, sf_dir):
    """All days are dirty: those with a record that can't be built fail alone, those without records are removed."""
    e = B.events(spark, sf_dir)
    out = shared_path(spark, "days")

    def build(records: DataFrame) -> DataFrame:
        value = F.when(F.col("k") == 13, F.raise_error(F.lit("a record that can't be built"))).otherwise(F.col("value"))
        return records.select(*KEYS, "seq", value.cast("double").alias("value"))

    run = incremental.run_once(e.select(*KEYS), e.filter("symbol <> 'S3'"), build, lambda df: sinks.replace_days(df, out))
    counts = run.counts() | {"rows": spark.read.parquet(out).count()}
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{c} long" for c in counts))


@query(
    O.sql(
        {"ev": O.MARKET["ev"]} | {"d": "SELECT symbol, trading_date, count(*) AS n, CAST(sum(k) AS BIGINT) AS total, bool_or(k = 13) AS bad, bool_and(symbol = 'S3') AS gone FROM ev GROUP BY ALL"},
        f"""SELECT symbol, {_DAY}, CASE WHEN bad THEN 'a record of 13' END AS error, CASE WHEN bad THEN 0 ELSE n END AS n, CASE WHEN bad THEN 0 ELSE total END AS total,
        (SELECT count(*) || ',' || count(*) FILTER (NOT gone AND NOT bad) || ',' || count(*) FILTER (gone) || ',' || count(*) FILTER (NOT gone AND bad) FROM d) AS run FROM d WHERE NOT gone""",
    )
)
def sm06_errors_as_data(spark, sf_dir):
    """Every day with its totals, or zeros and its error, from one build of all days; days without records are removed."""
    e = B.events(spark, sf_dir)
    out = shared_path(spark, "days")

    def build(records: DataFrame) -> DataFrame:
        wrong = F.max(F.when(F.col("k") == 13, "a record of 13"))
        return records.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("total"), wrong.alias("error"))

    run = incremental.run_once(e.select(*KEYS), e.filter("symbol <> 'S3'"), build, lambda df: sinks.replace_days(df, out))
    failed = spark.createDataFrame(run.errors, "symbol string, trading_date string, error string").withColumn("trading_date", F.col("trading_date").cast("date"))
    # every day may have failed, and then no file tells the columns
    every = spark.read.schema("n long, total long, symbol string, trading_date date").parquet(out).unionByName(failed, allowMissingColumns=True)
    return every.fillna(0, ["n", "total"]).withColumn("run", F.lit(",".join(str(n) for n in run.counts().values())))


@query(O.sql({"ev": O.MARKET["ev"]}, f"SELECT symbol, {_DAY}, count(*) AS n, sum(k) AS total FROM ev GROUP BY ALL"))
def sm01_sm04_sm08_recompute_stream(spark, sf_dir):
    """Records arriving in two lots; late ones rebuild their whole day."""
    source, out, state = (shared_path(spark, f"recompute-{x}") for x in ("in", "out", "state"))
    e = B.events(spark, sf_dir).select(*KEYS, "seq", "k")
    build = lambda records: records.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("total"))
    for part in ("seq % 3 <> 0", "seq % 3 = 0"):
        e.filter(part).write.mode("append").parquet(source)
        arrivals = spark.readStream.schema(e.schema).parquet(source)
        incremental.recompute_stream(arrivals, lambda: spark.read.parquet(source), build, lambda df: sinks.replace_days(df, out), state, None).awaitTermination()
    return spark.read.parquet(out)


_CHANGED = "(symbol = 'S1' OR (symbol = 'S3' AND trading_date < DATE '2024-01-08'))"
_GONE = "(symbol = 'S2' AND trading_date < DATE '2024-01-05')"


@query(
    O.sql(
        {"ev": O.MARKET["ev"]} | {"d": f"SELECT symbol, trading_date, {_CHANGED} AS changed, {_GONE} AS gone, count(*) AS n, sum(k) AS total FROM ev GROUP BY ALL"},
        f"""SELECT symbol, {_DAY}, n, CASE WHEN changed THEN total + n ELSE total END AS total, '1:' || (SELECT count(*) FROM d) || ',' || (SELECT count(*) FROM d) || ',0 2:'
        || (SELECT count(*) FILTER (changed OR gone) || ',' || count(*) FILTER (changed AND NOT gone) || ',' || count(*) FILTER (gone) FROM d) || ' 2:'
        || (SELECT count(*) FILTER (changed OR gone) || ',' || count(*) FILTER (changed AND NOT gone) || ',' || count(*) FILTER (gone) FROM d) || ' 3:0,0,0' AS runs FROM d WHERE NOT gone""",
    )
)
def sm02_sm03_sm08_kept_manifest(spark, sf_dir):
    """A table of which days change and go between runs, the second one repeated: totals by day, and dirty, built, removed."""
    source, out, kept = (shared_path(spark, f"kept-{x}") for x in ("in", "out", "manifest"))
    e = B.events(spark, sf_dir).select(*KEYS, "seq", "k")
    build = lambda records: records.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("total"))
    runs = []

    def run(batch: int) -> None:
        now, records = manifests.of_tables(spark, [source]), readers.read_days(spark, source)
        found = manifests.run_batch(manifests.Kept(spark, kept), batch, now, records, build, lambda df: sinks.replace_days(df, out), lambda gone: sinks.remove_days(spark, out, gone))
        runs.append(f"{batch}:{found.dirty},{found.built},{found.removed}")

    sinks.replace_days(e, source)
    run(1)
    sinks.replace_days(e.filter(_CHANGED).withColumn("k", F.col("k") + 1), source)
    sinks.remove_days(spark, source, e.filter(_GONE))
    for batch in (2, 2, 3):
        run(batch)
    return readers.read_days(spark, out).withColumn("runs", F.lit(" ".join(runs)))


_PACKED = ["mid_price", "cum_volume", "vwap_intraday", "rv_6h", "price_to_ma20", "feature_confidence", "data_quality_score"]


@query(O.sql(O.ALL, "SELECT " + O.columns(_PACKED, FRAME, places=9) + f" FROM quality WHERE NOT {_GONE}"), places=9)
def l3_run_from_stored_tables(spark, sf_dir):
    """Packages after two runs over stored layer-2 tables: in between days changed, went, and lost a frame.

    Days of S1 are stored in part first; some of S2 go; days of S3 lose a deep frame and keep the packages that they have.
    """
    source, out, kept = (shared_path(spark, f"layer3-{x}") for x in ("in", "out", "manifest"))
    frames, levels = pipeline.frames_with_memory(*_market(spark, sf_dir), B.WINDOWS, B.MEMORY)
    plan = layer3.Layer3(B.daily(spark, sf_dir), B.event_bars(spark, sf_dir), B.WINDOWS, B.MEMORY, NAMES, WINDOWS_MS)
    early = "symbol <> 'S1' OR frame_no <= 1"
    layer3.store(frames.filter(early), levels.filter(early), source)
    plan.run(spark, source, out, kept, 1)
    layer3.store(frames.filter("symbol = 'S1'"), levels.filter("symbol = 'S1'"), source)
    for table in (layer3.FRAMES, layer3.DEEP):
        sinks.remove_days(spark, f"{source}/{table}", frames.filter(_GONE))
    deep = written(readers.read_days(spark, f"{source}/{layer3.DEEP}").filter("symbol = 'S3' AND frame_no <> 1"), "lost")
    sinks.replace_days(deep, f"{source}/{layer3.DEEP}")
    plan.run(spark, source, out, kept, 2)
    packed = readers.read_days(spark, out)
    places = {c: f.name for f in packed.schema if f.name not in (*FRAME,) for c in f.dataType.names}
    return packed.select(*FRAME, *[F.col(places[c])[c].alias(c) for c in _PACKED])


@query(O.sql({"ev": O.MARKET["ev"]}, f"SELECT symbol, {_DAY}, seq, CASE WHEN trading_date < DATE '2024-01-05' THEN k + 1 ELSE k END AS k FROM ev"))
def snk02_replace_days(spark, sf_dir):
    """All days written, then some replaced: the others stay."""
    path = shared_path(spark, "replaced")
    e = B.events(spark, sf_dir).select(*KEYS, "seq", "k")
    sinks.replace_days(e, path)
    sinks.replace_days(e.filter("trading_date < date'2024-01-05'").withColumn("k", F.col("k") + 1), path)
    return spark.read.parquet(path)


@query(O.sql({"ev": O.MARKET["ev"]}, "SELECT symbol, seq, k FROM ev"))
def snk01_append_stream(spark, sf_dir):
    """Records appended by a stream, by symbol, year and day of arrival."""
    source, out, state = (shared_path(spark, f"append-{x}") for x in ("in", "out", "state"))
    e = B.events(spark, sf_dir).select("symbol", "seq", "k")
    e.write.parquet(source)
    sinks.append_stream(spark.readStream.schema(e.schema).parquet(source), out, state, None).awaitTermination()
    return spark.read.schema("symbol string, seq long, k long").json(out).select("symbol", "seq", "k")


@query(
    O.sql(
        O.MARKET,
        f"SELECT symbol, {_DAY}, symbol || '/bundle/' || CAST(year(trading_date) AS VARCHAR) || '/' || CAST(trading_date AS VARCHAR) || '.json' AS path, count(*) AS frame_count, sum(frame_no * seq) AS weighted FROM frames GROUP BY ALL",
    )
)
def snk04_day_bundles(spark, sf_dir):
    """A JSON bundle for each day at its path, written and read back strictly; frames are in order."""
    root = shared_path(spark, "bundles")
    frames = align.align(*_market(spark, sf_dir), B.WINDOWS).select(*FRAME, "seq")
    sinks.write_bundles(sinks.day_bundles(frames, "bundle"), root).write.format("noop").mode("overwrite").save()
    found = readers.read_objects(spark, [f"{root}/*/*/*/"], "symbol string, trading_date string, frame_count long, frames array<struct<frame_no: long, seq: long>>")
    weighted = F.aggregate(F.transform("frames", lambda x, i: (i + 1) * x["seq"]), F.lit(0).cast("long"), lambda s, x: s + x)
    return found.select("symbol", "trading_date", F.regexp_extract("path", r"([^/]+/bundle/.*)$", 1).alias("path"), "frame_count", weighted.alias("weighted"))


@query(O.sql(O.MARKET, "SELECT symbol, CAST(trading_date AS VARCHAR) AS date, round(price_close, 6) + 0.0 AS price_close FROM dly"))
def snk05_daily_by_date(spark, sf_dir):
    path = shared_path(spark, "daily")
    sinks.replace_daily(B.daily(spark, sf_dir).select("symbol", F.col("trading_date").alias("date"), "price_close"), path)
    return spark.read.parquet(path)


@query(O.sql(O.MARKET, f"SELECT symbol, {_DAY}, seq, row_number() OVER (PARTITION BY symbol, trading_date ORDER BY event_us, seq) AS source_sequence FROM ev"))
def wn12_number_records(spark, sf_dir):
    return normalize.number_records(B.events(spark, sf_dir).withColumn("id", F.col("seq")).drop("seq"), ["event_us", "id"]).select(*KEYS, F.col("id").alias("seq"), F.col("seq").alias("source_sequence"))
