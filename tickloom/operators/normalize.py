"""Raw records to typed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import exprs as X

#: Raw daily field and its normalized name.
DAILY_FIELDS = {
    "priceOpen": "price_open",
    "priceHigh": "price_high",
    "priceLow": "price_low",
    "priceClose": "price_close",
    "priceBasic": "price_basic",
    "priceAverage": "price_average",
    "totalVolume": "total_volume",
    "dealVolume": "deal_volume",
    "putthroughVolume": "putthrough_volume",
    "totalValue": "total_value",
    "putthroughValue": "putthrough_value",
    "buyForeignQuantity": "buy_foreign_quantity",
    "buyForeignValue": "buy_foreign_value",
    "sellForeignQuantity": "sell_foreign_quantity",
    "sellForeignValue": "sell_foreign_value",
    "buyCount": "buy_count",
    "buyQuantity": "buy_quantity",
    "sellCount": "sell_count",
    "sellQuantity": "sell_quantity",
    "adjRatio": "adj_ratio",
    "currentForeignRoom": "current_foreign_room",
    "propTradingNetDealValue": "prop_net_deal_value",
    "propTradingNetPTValue": "prop_net_pt_value",
    "propTradingNetValue": "prop_net_value",
    "unit": "unit",
}


def _have(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def normalize_daily(raw: DataFrame) -> DataFrame:
    """Daily bars: snake-case doubles; the date is the record's, else its trading date, else the file's name."""
    date = F.coalesce(*[X.date_text(_have(raw, c).cast("string")) for c in ("date", "trading_date", "file_date")])
    values = [X.to_float(_have(raw, a)).alias(b) for a, b in DAILY_FIELDS.items()]
    return raw.select(X.clean_symbol(_have(raw, "symbol")).alias("symbol"), date.alias("trading_date"), *values).filter("trading_date is not null")


def _time_block(raw: DataFrame) -> list[Column]:
    event, ingest = X.parse_event_time(_have(raw, "event_time").cast("string")), _have(raw, "ts").cast("string")
    return [
        event.alias("event_ts"),
        X.micros(event).alias("event_us"),
        X.to_local(event).alias("event_ts_local"),
        X.parse_ingest_time(ingest).alias("ingested_ts"),
        X.micros(X.parse_ingest_time(ingest)).alias("ingested_us"),
        X.ingest_zone_source(ingest).alias("ingested_tz_source"),
    ]


def trading_date(raw: DataFrame, source: str) -> Column:
    """The record's day: local event date first; the fallbacks differ by source."""
    event = X.parse_event_time(_have(raw, "event_time").cast("string"))
    text = lambda c: X.date_text(_have(raw, c).cast("string"))
    rest = ("trading_date", "event_time", "ts", "file_date") if source == "trade" else ("event_time", "ts", "date", "file_date")
    return F.coalesce(X.to_local(event).cast("date"), *[text(c) for c in rest])


def _base(raw: DataFrame, source: str) -> list[Column]:
    return [X.clean_symbol(_have(raw, "symbol")).alias("symbol"), trading_date(raw, source).alias("trading_date"), *_time_block(raw)]


def number_records(df: DataFrame, position: list[str]) -> DataFrame:
    """seq, the source sequence: the record's place in its file order within symbol and day."""
    w = Window.partitionBy("symbol", "trading_date").orderBy(*[F.col(c) for c in position])
    return df.withColumn("seq", F.row_number().over(w).cast("long"))


def _dated(records: DataFrame) -> DataFrame:
    """Records with a day; where broken records are kept, these too."""
    return records.filter("trading_date is not null" + (" or broken_record is not null" if "broken_record" in records.columns else ""))


def normalize_snapshots(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    fields = ["last_price", "last_volume", "deal_volume", "deal_value", "active_buy_volume", "active_sell_volume", "total_buy_sale_volume"]
    return _dated(raw.select(*_base(raw, "snapshot"), *[X.to_float(_have(raw, c)).alias(c) for c in fields], *keep))


def normalize_books(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    out = raw.select(
        *_base(raw, "book"),
        X.to_float(_have(raw, "total_bid_volume")).alias("reported_total_bid_volume"),
        X.to_float(_have(raw, "total_ask_volume")).alias("reported_total_ask_volume"),
        X.levels(F.col("bid_levels")).alias("bid_levels"),
        X.levels(F.col("ask_levels")).alias("ask_levels"),
        *keep,
    )
    return _dated(out)


def normalize_trades(raw: DataFrame, keep: tuple[str, ...] = (), distinct_ids: bool = False, position: tuple[str, ...] = ()) -> DataFrame:
    """Trade ticks; with ``distinct_ids`` the first of each trade id in a day stays, by event and ingest time and then
    by the columns ``position`` (among the kept ones); trades without an id all stay."""
    out = raw.select(
        *_base(raw, "trade"),
        X.to_int(_have(raw, "trade_id")).alias("trade_id"),
        X.to_float(_have(raw, "price")).alias("price"),
        X.to_float(_have(raw, "volume")).alias("volume"),
        X.clean_side(_have(raw, "side")).alias("side"),
        *keep,
    )
    out = _dated(out)
    if not distinct_ids:
        return out
    w = Window.partitionBy("symbol", "trading_date", "trade_id").orderBy("event_us", "ingested_us", *position)
    first = out.filter("trade_id is not null").withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")
    return first.unionByName(out.filter("trade_id is null"))


def session_only(df: DataFrame) -> DataFrame:
    """Records inside the intake session; a missing time is outside."""
    return df.filter(X.in_intake_session(X.time_of_day(X.micros(F.col("event_ts_local")))))
