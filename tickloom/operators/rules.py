"""Data-quality rules as one long table, with status, counters and flags by symbol and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import exprs as X
from ..params import KEYS, Session, Tolerances

#: Rules in their reporting order, with their scope.
RULES = {
    "price_high_gte_price_low": "daily",
    "total_volume_matches_components": "daily",
    "average_price_consistency": "daily",
    "prop_net_value_consistency": "daily",
    "deal_volume_equals_active_buy_plus_sell": "intraday_last_price",
    "book_has_exactly_3_levels_each_side": "orderbook",
    "reported_total_depth_usable": "orderbook",
    "trade_tick_basic_integrity": "trade",
    "eod_deal_volume_matches_daily": "cross_source",
    "eod_close_matches_daily_close": "cross_source",
    "eod_deal_value_matches_daily_deal_value": "cross_source",
}
EXAMPLES = 5


def _single(ok: Column, *needed: Column) -> Column:
    """pass, fail, or skip where an input is missing."""
    missing = needed[0].isNull()
    for c in needed[1:]:
        missing |= c.isNull()
    return F.when(missing, "skip").when(ok, "pass").otherwise("fail")


def daily_rules(daily: DataFrame, tolerance: Tolerances = Tolerances()) -> DataFrame:
    """The four daily rules for each bar, long."""
    c = F.col
    expected_average = X.safe_div(X.safe_div(c("total_value") - c("putthrough_value"), c("deal_volume")), c("unit"))
    rules = {
        "price_high_gte_price_low": _single(c("price_high") >= c("price_low"), c("price_high"), c("price_low")),
        "total_volume_matches_components": _single(
            X.approx_equal(c("total_volume"), c("deal_volume") + c("putthrough_volume"), tolerance.volume), c("total_volume"), c("deal_volume"), c("putthrough_volume")
        ),
        "average_price_consistency": _single(X.approx_equal(c("price_average"), expected_average, tolerance.average_price), c("price_average"), expected_average),
        "prop_net_value_consistency": _single(
            X.approx_equal(c("prop_net_value"), c("prop_net_deal_value") + c("prop_net_pt_value"), tolerance.volume), c("prop_net_value"), c("prop_net_deal_value"), c("prop_net_pt_value")
        ),
    }
    pairs = F.array(*[F.struct(F.lit(k).alias("rule_id"), v.alias("status")) for k, v in rules.items()])
    rows = daily.select(*KEYS, F.explode(pairs).alias("x")).select(*KEYS, "x.*")
    return rows.select("*", (c("status") != "skip").cast("long").alias("checked_count"), (c("status") == "pass").cast("long").alias("pass_count"), (c("status") == "fail").cast("long").alias("fail_count"))


def _counted(checked: Column, failed: Column) -> list[Column]:
    return [checked.alias("checked_count"), (checked - failed).alias("pass_count"), failed.alias("fail_count")]


def volume_balance(snapshots: DataFrame, tolerance: Tolerances = Tolerances()) -> DataFrame:
    """Deal volume against active buy plus sell, record by record; records with a null are not checked."""
    known = F.col("deal_volume").isNotNull() & F.col("active_buy_volume").isNotNull() & F.col("active_sell_volume").isNotNull()
    gap = F.abs(F.col("deal_volume") - F.col("active_buy_volume") - F.col("active_sell_volume"))
    out = snapshots.groupBy(*KEYS).agg(*_counted(F.count_if(known), F.count_if(known & (gap > tolerance.volume))), F.max(F.when(known, gap)).alias("max_abs_diff"))
    return _labelled(out, "deal_volume_equals_active_buy_plus_sell")


def _labelled(counts: DataFrame, rule: str, bad: str = "fail") -> DataFrame:
    status = F.when(F.col("checked_count") == 0, "skip").when(F.col("fail_count") > 0, bad).otherwise("pass")
    return counts.withColumn("rule_id", F.lit(rule)).withColumn("status", status)


def balance_examples(snapshots: DataFrame, tolerance: Tolerances = Tolerances(), order: str = "seq") -> DataFrame:
    """The first failing records of each day, in record order."""
    gap = F.abs(F.col("deal_volume") - F.col("active_buy_volume") - F.col("active_sell_volume"))
    w = Window.partitionBy(*KEYS).orderBy(order)
    return snapshots.withColumn("abs_diff", gap).filter(gap > tolerance.volume).withColumn("nth", F.row_number().over(w)).filter(F.col("nth") <= EXAMPLES).select(*KEYS, order, "nth", "abs_diff")


def book_shape(books: DataFrame) -> DataFrame:
    wrong = (F.size(F.coalesce("bid_levels", F.array())) != 3) | (F.size(F.coalesce("ask_levels", F.array())) != 3)
    out = books.groupBy(*KEYS).agg(*_counted(F.count(F.lit(1)), F.count_if(wrong)))
    return _labelled(out, "book_has_exactly_3_levels_each_side")


def depth_usable(books: DataFrame) -> DataFrame:
    """Warns if every snapshot's reported totals are missing or zero; with the share that is."""
    empty = (F.coalesce("reported_total_bid_volume", F.lit(0.0)) == 0) & (F.coalesce("reported_total_ask_volume", F.lit(0.0)) == 0)
    out = books.groupBy(*KEYS).agg(*_counted(F.count(F.lit(1)), F.count_if(empty)), F.avg(empty.cast("double")).alias("unusable_ratio"))
    status = F.when(F.col("pass_count") == 0, "warn").otherwise("pass")
    return out.withColumn("rule_id", F.lit("reported_total_depth_usable")).withColumn("status", status)


def trade_integrity(trades: DataFrame) -> DataFrame:
    """Id, price, volume and side of every tick, with a counter for each defect."""
    bad = {
        "missing_id": F.col("trade_id").isNull(),
        "bad_price": ~F.coalesce(F.col("price") > 0, F.lit(False)),
        "bad_volume": ~F.coalesce(F.col("volume") > 0, F.lit(False)),
        "bad_side": ~F.coalesce(F.col("side").isin("B", "S"), F.lit(True)),
    }
    any_bad = bad["missing_id"] | bad["bad_price"] | bad["bad_volume"] | bad["bad_side"]
    out = trades.groupBy(*KEYS).agg(
        *_counted(F.count(F.lit(1)), F.count_if(any_bad)), *[F.count_if(v).alias(k) for k, v in bad.items()], F.count_if(F.col("side").isNull()).alias("null_side")
    )
    return _labelled(out, "trade_tick_basic_integrity")


def end_of_day(snapshots: DataFrame, daily: DataFrame, session: Session = Session(), tolerance: Tolerances = Tolerances()) -> DataFrame:
    """The day's last snapshot against its daily bar; warns if that snapshot is not near the close."""
    order = F.struct("event_us", "ingested_us", "seq")
    last = snapshots.groupBy(*KEYS).agg(F.max_by(F.struct("local_us", "deal_volume", "last_price", "deal_value"), order).alias("s"))
    both = last.join(daily.withColumn("__d", F.lit(True)), list(KEYS), "full_outer")
    gap = F.floor(F.lit(session.close) / 1_000_000) - F.floor(X.time_of_day(F.col("s.local_us")) / 1_000_000)
    covered = F.coalesce((gap >= 0) & (gap <= session.coverage_gap_seconds), F.lit(False))
    absent = F.col("__d").isNull() | F.col("s").isNull()

    def rule(actual: Column, expected: Column, bound: float) -> Column:
        return F.when(absent, "skip").when(~covered, "warn").otherwise(_single(X.approx_equal(actual, expected, bound), actual, expected))

    rules = {
        "eod_deal_volume_matches_daily": rule(F.col("s.deal_volume"), F.col("deal_volume"), tolerance.volume),
        "eod_close_matches_daily_close": rule(F.col("s.last_price"), F.col("price_close"), tolerance.close),
        "eod_deal_value_matches_daily_deal_value": rule(F.col("s.deal_value"), F.col("total_value") - F.col("putthrough_value"), tolerance.value),
    }
    pairs = F.array(*[F.struct(F.lit(k).alias("rule_id"), v.alias("status")) for k, v in rules.items()])
    rows = both.select(*KEYS, gap.alias("close_gap_seconds"), F.explode(pairs).alias("x")).select(*KEYS, "close_gap_seconds", "x.*")
    checked = F.col("status").isin("pass", "fail").cast("long")
    return rows.select("*", checked.alias("checked_count"), (F.col("status") == "pass").cast("long").alias("pass_count"), (F.col("status") == "fail").cast("long").alias("fail_count"))


def rule_results(daily: DataFrame, snapshots: DataFrame, books: DataFrame, trades: DataFrame) -> DataFrame:
    """All rules of all days; rules without input are reported as skipped."""
    columns = [*KEYS, "rule_id", "status", "checked_count", "pass_count", "fail_count"]
    parts = [daily_rules(daily), volume_balance(snapshots), book_shape(books), depth_usable(books), trade_integrity(trades), end_of_day(snapshots, daily)]
    found = parts[0].select(columns)
    for part in parts[1:]:
        found = found.unionByName(part.select(columns))
    table = F.array(*[F.struct(F.lit(i).alias("rule_no"), F.lit(k).alias("rule_id"), F.lit(v).alias("scope")) for i, (k, v) in enumerate(RULES.items(), 1)])
    every = found.select(*KEYS).distinct().select(*KEYS, F.explode(table).alias("x")).select(*KEYS, "x.*")
    out = every.join(found, [*KEYS, "rule_id"], "left")
    return out.fillna({"status": "skip", "checked_count": 0, "pass_count": 0, "fail_count": 0})


def validation_status(results: DataFrame, books: DataFrame, trades: DataFrame) -> DataFrame:
    """Per day: overall status, counts by status, failing and warning rules, status by scope, degraded flags."""
    unusable = depth_usable(books).select(*KEYS, (F.col("status") == "warn").alias("book_total_depth_unusable"))
    nullable = trades.groupBy(*KEYS).agg((F.count_if(F.col("side").isNull()) > 0).alias("trade_side_nullable"))
    named = lambda s: F.transform(F.array_sort(F.collect_list(F.when(F.col("status") == s, F.struct("rule_no", "rule_id")))), lambda x: x["rule_id"])
    counts = results.groupBy(*KEYS).agg(
        *[F.count_if(F.col("status") == s).alias(f"{s}_count") for s in ("pass", "fail", "warn", "skip")],
        named("fail").alias("failing_rules"),
        named("warn").alias("warning_rules"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.concat_ws(".", "scope", "rule_id").alias("rule"), "status")))).alias("status_by_rule"),
    )
    out = counts.join(unusable, list(KEYS), "left").join(nullable, list(KEYS), "left").fillna(False, ["book_total_depth_unusable", "trade_side_nullable"])
    degraded = (F.col("warn_count") > 0) | F.col("book_total_depth_unusable") | F.col("trade_side_nullable")
    return out.withColumn("validation_status", F.when(F.col("fail_count") > 0, "fail").when(degraded, "degraded").otherwise("pass"))
