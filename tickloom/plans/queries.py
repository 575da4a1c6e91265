"""One query for each operator, over the whole test tables, with its meaning in SQL beside it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import align, daily, deep_book, features, intake, normalize, rules
from ..params import KEYS
from . import bindings as B
from . import oracle as O
from . import pipeline

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
FRAME = ["symbol", "trading_date", "frame_no"]
NAMES, WINDOWS_MS = ("2h", "6h", "2h", "6h"), (7_200_000, 21_600_000)


def query(sql: str | None = None, places: int = 6):
    """Registers a query by its function's name; what it returns is rounded to ``places`` for comparison."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: B.rounded(f(spark, sf_dir), places)
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _market(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return B.snapshots(spark, sf_dir), B.books(spark, sf_dir), B.trades(spark, sf_dir)


def _frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(*_market(spark, sf_dir), B.WINDOWS)


def _levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.frames_with_memory(*_market(spark, sf_dir), B.WINDOWS, B.MEMORY)[1]


def _state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.market_state(*_market(spark, sf_dir), B.daily(spark, sf_dir), B.WINDOWS, B.MEMORY)


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    days, bars = B.daily(spark, sf_dir), B.event_bars(spark, sf_dir)
    return pipeline.feature_frames(*_market(spark, sf_dir), days, bars, B.WINDOWS, B.MEMORY, NAMES, WINDOWS_MS)


# ---- alignment -------------------------------------------------------------------------------------------------

_FLOW = [f"{kind}_{h}h" for h in (2, 6, 24) for kind in ("volume_sum", "signed_volume")]
_FLOW_COUNTS = [f"{kind}_{h}h" for h in (2, 6, 24) for kind in ("trade_count", "null_side_count")]


@query(
    O.sql(
        O.MARKET,
        "SELECT " + O.columns(["best_bid", "best_ask", "mid_price", "spread", "imbalance_l3", "last_trade_price", "signed_volume_2h"], [*FRAME, "book_age_ms"]) + """ FROM (
        SELECT f.symbol, f.trading_date, f.frame_no, round(base - 0.1::DOUBLE, 6) AS best_bid, round(base + 0.1::DOUBLE, 6) AS best_ask,
            (round(base - 0.1::DOUBLE, 6) + round(base + 0.1::DOUBLE, 6)) / 2 AS mid_price, round(base + 0.1::DOUBLE, 6) - round(base - 0.1::DOUBLE, 6) AS spread,
            CASE WHEN base IS NOT NULL THEN 0.0::DOUBLE END AS imbalance_l3, last_trade_price, signed_volume_2h, floor((f.event_us - book_us) / 1000) AS book_age_ms
        FROM frames f JOIN fb USING (symbol, trading_date, frame_no) JOIN ft USING (symbol, trading_date, frame_no) JOIN flow USING (symbol, trading_date, frame_no))""",
    )
)
def flagship_book_and_flow(spark, sf_dir):
    """Per frame: as-of mid, spread and imbalance of the book, the last trade, and trailing signed volume."""
    f = _frames(spark, sf_dir)
    bid, ask = (X.usable_levels(F.col(f"book_asof.{s}_levels")) for s in ("bid", "ask"))
    f = f.withColumns({"bid": bid, "ask": ask})
    b, a = X.best(F.col("bid"), "price"), X.best(F.col("ask"), "price")
    deep = X.imbalance(X.depth(F.col("bid"), 3), X.depth(F.col("ask"), 3))
    return f.select(
        *FRAME, "book_age_ms", b.alias("best_bid"), a.alias("best_ask"), ((b + a) / 2).alias("mid_price"), (a - b).alias("spread"),
        deep.alias("imbalance_l3"), F.col("trade_asof.price").alias("last_trade_price"), "signed_volume_2h",
    )


@query(
    O.sql(
        O.MARKET,
        "SELECT " + O.columns(["last_trade_price", "last_trade_volume"], [*FRAME, "event_us", "book_us", "trade_us", "last_trade_side", "book_age_ms", "tick_age_ms"])
        + """ FROM (SELECT *, floor((event_us - book_us) / 1000) AS book_age_ms, floor((event_us - trade_us) / 1000) AS tick_age_ms FROM fb JOIN ft USING (symbol, trading_date, frame_no))""",
    )
)
def jn01_jn02_asof(spark, sf_dir):
    t = F.col("trade_asof")
    return _frames(spark, sf_dir).select(
        *FRAME, "event_us", F.col("book_asof.event_us").alias("book_us"), t["event_us"].alias("trade_us"), t["price"].alias("last_trade_price"),
        t["volume"].alias("last_trade_volume"), t["side"].alias("last_trade_side"), "book_age_ms", "tick_age_ms",
    )


@query(O.sql(O.MARKET, "SELECT " + O.columns([*_FLOW, "run_volume", "run_value"], [*FRAME, *_FLOW_COUNTS, "trade_count_intraday"]) + " FROM flow"))
def jn03_ag08_trailing_windows(spark, sf_dir):
    return _frames(spark, sf_dir).select(*FRAME, *_FLOW_COUNTS, *_FLOW, "trade_count_intraday", "run_volume", "run_value")


@query(O.sql(O.MARKET, "SELECT CAST(trading_date AS VARCHAR) AS trading_date, symbol, seq, frame_no FROM assigned"))
def jn04_forward_assign(spark, sf_dir):
    s, _, t = _market(spark, sf_dir)
    return align.assign_forward(s, t).select(*KEYS, "seq", "frame_no")


def _priced(spark, sf_dir) -> DataFrame:
    return _frames(spark, sf_dir).select(*FRAME, "event_us", F.col("snap.last_price").alias("last_price"))


@query(
    O.sql(
        O.MARKET | {"lagged": "SELECT a.symbol, a.trading_date, a.frame_no, "
        + ", ".join(f"arg_max_null(b.last_price, b.frame_no) FILTER (b.event_us <= a.event_us - {h * O.H}) AS price_lag_{h}h" for h in (2, 6))
        + " FROM frames a JOIN frames b ON a.symbol = b.symbol AND a.trading_date = b.trading_date GROUP BY ALL"},
        "SELECT " + O.columns(["price_lag_2h", "price_lag_6h"], FRAME) + " FROM lagged",
    )
)
def jn05_lagged_prices(spark, sf_dir):
    return align.lagged_prices(_priced(spark, sf_dir), "last_price", B.WINDOWS).select(*FRAME, "price_lag_2h", "price_lag_6h")


@query(
    O.sql(
        O.MARKET | {
            "ret": "SELECT *, last_price / nullif(lag(last_price) OVER (PARTITION BY symbol, trading_date ORDER BY frame_no), 0) - 1 AS frame_return FROM frames",
            "vol": O.STATE["vol"],
        },
        "SELECT " + O.columns(["frame_return", "rv_2h", "rv_6h", "rv_24h"], FRAME) + " FROM vol JOIN ret USING (symbol, trading_date, frame_no)",
    )
)
def wn10_wn11_realized_volatility(spark, sf_dir):
    return align.realized_volatility(_priced(spark, sf_dir), "last_price", B.WINDOWS).select(*FRAME, "frame_return", "rv_2h", "rv_6h", "rv_24h")


@query(
    O.sql(
        O.MARKET,
        """SELECT CAST(trading_date AS VARCHAR) AS trading_date, symbol, count(*) AS frame_count, min(event_us) AS first_us, max(event_us) AS last_us,
        max(frame_no) AS last_frame FROM frames GROUP BY ALL""",
    )
)
def ag15_wn12_frame_summary(spark, sf_dir):
    return align.frame_summary(_frames(spark, sf_dir))


# ---- deep book -------------------------------------------------------------------------------------------------

_DEEP = O.MARKET | O.DEEP
_LEVEL = ["symbol", "trading_date", "side", "price", "frame_no"]


@query(O.sql(_DEEP, "SELECT " + O.columns(["price", "volume"], [*FRAME, "side"]) + " FROM lev"))
def st01_visible_levels(spark, sf_dir):
    return deep_book.visible_levels(_frames(spark, sf_dir)).select(*FRAME, "side", "price", "volume")


@query(O.sql(_DEEP, "SELECT " + O.columns(["price", "matched"], [*FRAME, "side"]) + " FROM matched"))
def jn09_ag13_matched_volumes(spark, sf_dir):
    s, _, t = _market(spark, sf_dir)
    return deep_book.matched_volumes(align.assign_forward(s, t))


_MEMORY = (
    "price last_observed_volume max_observed_volume executed_volume_at_price trade_explained_ratio carry_forward_volume wall_suspicion_score reconstruction_confidence".split(),
    [*FRAME, "side", "state", "first_seen_us", "last_seen_us", "reappeared_count", "stale_age_ms"],
)


@query(O.sql(_DEEP, "SELECT " + O.columns(*_MEMORY) + " FROM deep"))
def st02_st06_deep_book(spark, sf_dir):
    return _levels(spark, sf_dir).select(*_MEMORY[1], *_MEMORY[0])


@query(
    O.sql(
        _DEEP,
        """SELECT CAST(trading_date AS VARCHAR) AS trading_date, symbol, frame_no, count(*) AS memory_level_count,
        count(*) FILTER (state IN ('CARRIED_OUTSIDE_TOP3', 'PULLED_OR_CANCELLED', 'SUSPECTED_FAKE_WALL')) AS carried_level_count,
        count(*) FILTER (state = 'SUSPECTED_FAKE_WALL') AS wall_candidate_count FROM deep GROUP BY ALL""",
    )
)
def ag14_frame_totals(spark, sf_dir):
    return deep_book.frame_totals(_levels(spark, sf_dir))


_WALL = ["price", "wall_suspicion_score", "reconstruction_confidence"]


@query(O.sql(_DEEP, "SELECT " + O.columns(_WALL, [*FRAME, "side", "state"]) + " FROM deep WHERE state = 'SUSPECTED_FAKE_WALL'"))
def st07_wall_candidates(spark, sf_dir):
    return deep_book.wall_candidates(_levels(spark, sf_dir))


@query(
    O.sql(
        _DEEP,
        "SELECT " + O.columns(["price", "last_observed_volume"], [*FRAME, "side", "state"])
        + " FROM deep d WHERE frame_no = (SELECT max(frame_no) FROM deep e WHERE e.symbol = d.symbol AND e.trading_date = d.trading_date)",
    )
)
def st07_latest_levels(spark, sf_dir):
    return deep_book.latest_levels(_levels(spark, sf_dir)).select(*FRAME, "side", "state", "price", "last_observed_volume")


_EXT = "observed_bid_level_count observed_ask_level_count reconstructed_bid_levels_used reconstructed_ask_levels_used missing_depth_level_count used_reconstructed_depth_l5".split()


@query(O.sql(_DEEP, "SELECT " + O.columns(["bid_depth_l5", "ask_depth_l5"], [*FRAME, *_EXT]) + " FROM ext"))
def st08_jn10_depth_extension(spark, sf_dir):
    frames, levels = pipeline.frames_with_memory(*_market(spark, sf_dir), B.WINDOWS, B.MEMORY)
    return deep_book.depth_extension(frames, levels).select(*FRAME, *_EXT, "bid_depth_l5", "ask_depth_l5")


# ---- market state, features, quality ---------------------------------------------------------------------------

_STATE = (
    """last_trade_price last_trade_volume cum_volume cum_trade_value current_price day_open best_bid best_ask best_bid_size best_ask_size bid_depth_l1 ask_depth_l1 bid_depth_l3
    ask_depth_l3 bid_depth_l5 ask_depth_l5 mid_price spread spread_bps day_high_so_far day_low_so_far vwap_intraday intraday_return_from_open intraday_pos_in_range""".split(),
    [*FRAME, "event_us", "last_trade_side", "trade_count_intraday", "book_age_ms", "tick_age_ms", "missing_depth_level_count", "used_reconstructed_depth_l5"],
)


@query(O.sql(_DEEP | O.STATE, "SELECT " + O.columns(*_STATE) + " FROM state"))
def l3p1_market_state(spark, sf_dir):
    return _state(spark, sf_dir).select(*_STATE[1], *_STATE[0])


_BASE = (
    ["ret_2h", "ret_6h", "rv_2h", "rv_6h", "rv_24h", "trade_intensity_2h", "queue_pressure_l1", *_FLOW, *[f"{k}_l{n}" for k in ("book_imbalance", "depth_ratio") for n in (1, 3, 5)]],
    [*FRAME, *_FLOW_COUNTS],
)


@query(O.sql(_DEEP | O.STATE, "SELECT " + O.columns(*_BASE) + " FROM base"))
def l3p2_base_features(spark, sf_dir):
    return features.base_features(_state(spark, sf_dir), B.WINDOWS, "2h", "6h", 7200.0).select(*_BASE[1], *_BASE[0])


_STORE = ([*[c for c in O.TECH_NAMES if c != "available_days"], "macd_hist_d", "previous_close", *pipeline.HYBRIDS], [*FRAME, "available_days"])


@query(O.sql(O.ALL, "SELECT " + O.columns(*_STORE) + " FROM store"))
def l3p3_feature_store(spark, sf_dir):
    return _features(spark, sf_dir).select(*_STORE[1], *_STORE[0])


_QUALITY = (
    [c for c in pipeline.SCORES if "coverage" in c or c in ("stale_book_seconds", "trade_side_inferred_ratio", "feature_confidence", "data_quality_score")],
    [*FRAME, "stale_tick_ms", "stale_book_ms", *[c for c in pipeline.SCORES if c.endswith("_flag")]],
)


@query(O.sql(O.ALL, "SELECT " + O.columns(*_QUALITY, places=9) + " FROM quality"), places=9)
def l3p4_feature_quality(spark, sf_dir):
    return _features(spark, sf_dir).select(*_QUALITY[1], *_QUALITY[0])


_PACKED = {"market_state": ["mid_price", "cum_volume", "vwap_intraday"], "feature_store": ["rv_6h", "price_to_ma20", "relative_volume_day"], "feature_quality": ["feature_confidence", "data_quality_score"]}


@query(O.sql(O.ALL, "SELECT " + O.columns([c for cs in _PACKED.values() for c in cs], FRAME, places=9) + " FROM quality"), places=9)
def l3p5_package(spark, sf_dir):
    packed = pipeline.feature_package(_features(spark, sf_dir))
    return packed.select(*FRAME, *[F.col(s)[c].alias(c) for s, cs in _PACKED.items() for c in cs])


@query(O.sql(O.MARKET, """SELECT CAST(trading_date AS VARCHAR) AS trading_date, symbol, count(*) AS mismatches FROM frames WHERE seq % 29 = 0 GROUP BY ALL"""))
def jn07_bundle_mismatches(spark, sf_dir):
    """Two frame tables of which the second has lost a frame here and there: the days for quarantine."""
    frames = _frames(spark, sf_dir).select(*FRAME, "event_us", "seq")
    return features.bundle_mismatches(frames, frames.filter("seq % 29 <> 0"))


# ---- daily -----------------------------------------------------------------------------------------------------

_TECH = O.ORDER_BARS | O.technicals("ob")


@query(O.sql(_TECH, "SELECT " + O.columns([c for c in O.TECH_NAMES if c != "available_days"], ["symbol", "date", "available_days"]) + " FROM tech"))
def wn01_wn09_daily_technicals(spark, sf_dir):
    return daily.daily_technicals(B.order_bars(spark, sf_dir)).select("symbol", "date", *O.TECH_NAMES)


@query(O.sql(_TECH, "SELECT " + O.columns(["tr"], ["symbol", "date"]) + " FROM tr1"))
def wn07_true_ranges(spark, sf_dir):
    return daily.true_ranges(B.order_bars(spark, sf_dir)).filter("tr is not null").select("symbol", "date", "tr")


@query(
    O.sql(
        O.MARKET | O.EVENT_BARS | O.technicals("eb"),
        "SELECT " + O.columns(["ma_5", "rsi_14_d", "previous_close"], ["symbol", "trading_date", "available_days"])
        + """ FROM (SELECT d.symbol, d.trading_date, t.available_days, t.ma_5, t.rsi_14_d, p.close AS previous_close
        FROM dly d ASOF LEFT JOIN tech t ON d.symbol = t.symbol AND d.trading_date >= t.date ASOF LEFT JOIN eb p ON d.symbol = p.symbol AND d.trading_date > p.date)""",
    )
)
def flt10_jn11_as_of_days(spark, sf_dir):
    """Technicals that count the day's own bar; the previous close never does."""
    found = daily.as_of_days(B.daily(spark, sf_dir).select(*KEYS), B.event_bars(spark, sf_dir), include_current_bar=True)
    return found.select(*KEYS, "available_days", "ma_5", "rsi_14_d", "previous_close")


@query(
    """SELECT o_orderpriority AS symbol, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, max(o_orderkey) AS position, round(arg_max(o_totalprice, o_orderkey), 6) + 0.0 AS close
    FROM orders GROUP BY ALL"""
)
def src06_dedup_history(spark, sf_dir):
    o = B.table(spark, sf_dir, "orders")
    records = o.select(F.col("o_orderpriority").alias("symbol"), F.col("o_orderdate").cast("date").alias("date"), F.col("o_orderkey").alias("position"), F.col("o_totalprice").alias("close"))
    return daily.dedup_history(records, ["position"])


_GROUPS = {"view": "ref", "click": "last", "purchase": "foreign"}


@query(
    O.sql(
        {"ev": O.MARKET["ev"]}
        | {f"g_{g}": f"SELECT symbol, trading_date, arg_max(value, (event_us, seq)) AS {g}_value, arg_max(k, (event_us, seq)) AS {g}_k FROM ev WHERE event_type = '{t}' GROUP BY ALL" for t, g in _GROUPS.items()},
        """SELECT symbol, CAST(trading_date AS VARCHAR) AS date, round(ref_value, 6) + 0.0 AS ref_value, ref_k, round(last_value, 6) + 0.0 AS last_value, last_k, round(foreign_value, 6) + 0.0 AS foreign_value, foreign_k
        FROM g_ref FULL JOIN g_last USING (symbol, trading_date) FULL JOIN g_foreign USING (symbol, trading_date)""",
    )
)
def jn14_ag16_daily_merge(spark, sf_dir):
    """The last record of each source and day, sources merged by a full outer join."""
    e = B.events(spark, sf_dir).select("*", F.col("event_us").alias("event_time"), F.col("ingested_us").alias("ts"), F.col("seq").alias("position"))
    return daily.daily_merge([daily.latest_of_day(e.filter(F.col("event_type") == t), F.col("trading_date"), ["value", "k"], g) for t, g in _GROUPS.items()])


# ---- rules -----------------------------------------------------------------------------------------------------


def _case(ok: str, *needed: str) -> str:
    return f"CASE WHEN {' OR '.join(f'{n} IS NULL' for n in needed)} THEN 'skip' WHEN {ok} THEN 'pass' ELSE 'fail' END"


_AVERAGE = "((total_value - putthrough_value) / nullif(deal_volume, 0) / nullif(unit, 0))"
_SINGLE = {
    "price_high_gte_price_low": _case("price_high >= price_low", "price_high", "price_low"),
    "total_volume_matches_components": _case("abs(total_volume - (deal_volume + putthrough_volume)) <= 1.0", "total_volume", "deal_volume", "putthrough_volume"),
    "average_price_consistency": _case(f"abs(price_average - {_AVERAGE}) <= 0.01", "price_average", _AVERAGE),
    "prop_net_value_consistency": _case("abs(prop_net_value - (prop_net_deal_value + prop_net_pt_value)) <= 1.0", "prop_net_value", "prop_net_deal_value", "prop_net_pt_value"),
}
_EOD = {
    "eod_deal_volume_matches_daily": ("s.deal_volume", "d.deal_volume", "1.0"),
    "eod_close_matches_daily_close": ("s.last_price", "d.price_close", "0.001"),
    "eod_deal_value_matches_daily_deal_value": ("s.deal_value", "(d.total_value - d.putthrough_value)", "50000.0"),
}
_ONE = "CAST(status IN ('pass', 'fail') AS BIGINT) AS checked_count, CAST(status = 'pass' AS BIGINT) AS pass_count, CAST(status = 'fail' AS BIGINT) AS fail_count"
_MANY = "n AS checked_count, n - bad AS pass_count, bad AS fail_count"
_EMPTY = "coalesce(total_bid, 0) = 0"
_BAD_TICK = "trade_id IS NULL OR NOT coalesce(price > 0, FALSE) OR NOT coalesce(volume > 0, FALSE)"
RULES = {
    "r_daily0": " UNION ALL ".join(f"SELECT symbol, trading_date, '{k}' AS rule_id, {v} AS status FROM dly" for k, v in _SINGLE.items()),
    "r_daily": f"SELECT *, {_ONE} FROM r_daily0",
    "r_balance0": """SELECT symbol, trading_date, count(gap) AS n, count(*) FILTER (gap > 1.0) AS bad, max(gap) AS max_abs_diff
        FROM (SELECT *, abs(deal_volume - active_buy_volume - active_sell_volume) AS gap FROM snap) GROUP BY ALL""",
    "r_balance": f"""SELECT symbol, trading_date, 'deal_volume_equals_active_buy_plus_sell' AS rule_id, CASE WHEN n = 0 THEN 'skip' WHEN bad > 0 THEN 'fail' ELSE 'pass' END AS status, {_MANY}, max_abs_diff FROM r_balance0""",
    "r_shape0": "SELECT symbol, trading_date, count(*) AS n, count(*) FILTER (places <> 3) AS bad FROM book GROUP BY ALL",
    "r_shape": f"SELECT symbol, trading_date, 'book_has_exactly_3_levels_each_side' AS rule_id, CASE WHEN bad > 0 THEN 'fail' ELSE 'pass' END AS status, {_MANY} FROM r_shape0",
    "r_depth0": f"SELECT symbol, trading_date, count(*) AS n, count(*) FILTER ({_EMPTY}) AS bad, avg(CASE WHEN {_EMPTY} THEN 1.0::DOUBLE ELSE 0 END) AS unusable_ratio FROM book GROUP BY ALL",
    "r_depth": f"SELECT symbol, trading_date, 'reported_total_depth_usable' AS rule_id, CASE WHEN bad = n THEN 'warn' ELSE 'pass' END AS status, {_MANY}, unusable_ratio FROM r_depth0",
    "r_trade0": f"""SELECT symbol, trading_date, count(*) AS n, count(*) FILTER ({_BAD_TICK}) AS bad, count(*) FILTER (trade_id IS NULL) AS missing_id, count(*) FILTER (NOT coalesce(price > 0, FALSE)) AS bad_price,
        count(*) FILTER (NOT coalesce(volume > 0, FALSE)) AS bad_volume, count(*) FILTER (side IS NULL) AS null_side FROM trade GROUP BY ALL""",
    "r_trade": f"SELECT symbol, trading_date, 'trade_tick_basic_integrity' AS rule_id, CASE WHEN bad > 0 THEN 'fail' ELSE 'pass' END AS status, {_MANY}, missing_id, bad_price, bad_volume, null_side FROM r_trade0",
    "r_last": """SELECT symbol, trading_date, TRUE AS found, arg_max(local_us, event_us) AS local_us, arg_max_null(deal_volume, event_us) AS deal_volume, arg_max_null(last_price, event_us) AS last_price,
        arg_max_null(deal_value, event_us) AS deal_value FROM snap GROUP BY ALL""",
    "r_eod0": " UNION ALL ".join(
        f"""SELECT d.symbol, d.trading_date, '{k}' AS rule_id, 53100 - (s.local_us % 86400000000) // 1000000 AS close_gap_seconds, CASE WHEN s.found IS NULL THEN 'skip'
        WHEN NOT (53100 - (s.local_us % 86400000000) // 1000000 BETWEEN 0 AND 120) THEN 'warn' ELSE {_case(f'abs({a} - {b}) <= {t}', a, b)} END AS status
        FROM dly d LEFT JOIN r_last s USING (symbol, trading_date)"""
        for k, (a, b, t) in _EOD.items()
    ),
    "r_eod": f"SELECT *, {_ONE} FROM r_eod0",
    "rules": " UNION ALL ".join(f"SELECT symbol, trading_date, rule_id, status, checked_count, pass_count, fail_count FROM {t}" for t in ("r_daily", "r_balance", "r_shape", "r_depth", "r_trade", "r_eod")),
    "listed": "SELECT * FROM (VALUES " + ", ".join(f"({i}, '{k}', '{v}')" for i, (k, v) in enumerate(rules.RULES.items(), 1)) + ") t(rule_no, rule_id, scope)",
    "results": """SELECT d.symbol, d.trading_date, rule_no, rule_id, scope, coalesce(status, 'skip') AS status, coalesce(checked_count, 0) AS checked_count, coalesce(pass_count, 0) AS pass_count,
        coalesce(fail_count, 0) AS fail_count FROM dly d CROSS JOIN listed LEFT JOIN rules USING (symbol, trading_date, rule_id)""",
    "flags": """SELECT d.symbol, d.trading_date, coalesce(p.status = 'warn', FALSE) AS book_total_depth_unusable, coalesce(t.null_side > 0, FALSE) AS trade_side_nullable
        FROM dly d LEFT JOIN r_depth p USING (symbol, trading_date) LEFT JOIN r_trade t USING (symbol, trading_date)""",
}
_RULES = O.MARKET | RULES
_COUNTERS = "CAST(trading_date AS VARCHAR) AS trading_date, symbol, rule_id, status, checked_count, pass_count, fail_count"
_RULE = ["trading_date", "symbol", "rule_id", "status", "checked_count", "pass_count", "fail_count"]


@query(O.sql(_RULES, f"SELECT {_COUNTERS} FROM r_daily"))
def dq01_dq04_daily_rules(spark, sf_dir):
    return rules.daily_rules(B.daily(spark, sf_dir)).select(_RULE)


@query(O.sql(_RULES, f"SELECT {_COUNTERS}, round(max_abs_diff, 6) + 0.0 AS max_abs_diff FROM r_balance"))
def dq05_ag03_volume_balance(spark, sf_dir):
    return rules.volume_balance(B.snapshots(spark, sf_dir)).select(*_RULE, "max_abs_diff")


@query(
    O.sql(
        _RULES,
        """SELECT CAST(trading_date AS VARCHAR) AS trading_date, symbol, seq, row_number() OVER (PARTITION BY symbol, trading_date ORDER BY seq) AS nth, round(gap, 6) + 0.0 AS abs_diff
        FROM (SELECT *, abs(deal_volume - active_buy_volume - active_sell_volume) AS gap FROM snap) WHERE gap > 1.0 QUALIFY nth <= 5""",
    )
)
def ag03_balance_examples(spark, sf_dir):
    return rules.balance_examples(B.snapshots(spark, sf_dir))


@query(O.sql(_RULES, f"SELECT {_COUNTERS} FROM r_shape"))
def dq06_book_shape(spark, sf_dir):
    return rules.book_shape(B.books(spark, sf_dir)).select(_RULE)


@query(O.sql(_RULES, f"SELECT {_COUNTERS}, round(unusable_ratio, 6) + 0.0 AS unusable_ratio FROM r_depth"))
def dq07_ag17_depth_usable(spark, sf_dir):
    return rules.depth_usable(B.books(spark, sf_dir)).select(*_RULE, "unusable_ratio")


@query(O.sql(_RULES, f"SELECT {_COUNTERS}, missing_id, bad_price, bad_volume, null_side FROM r_trade"))
def dq08_ag18_trade_integrity(spark, sf_dir):
    return rules.trade_integrity(B.trades(spark, sf_dir)).select(*_RULE, "missing_id", "bad_price", "bad_volume", "null_side")


@query(O.sql(_RULES, f"SELECT {_COUNTERS}, close_gap_seconds FROM r_eod"))
def dq09_dq11_jn13_end_of_day(spark, sf_dir):
    return rules.end_of_day(B.snapshots(spark, sf_dir), B.daily(spark, sf_dir)).select(*_RULE, "close_gap_seconds")


@query(O.sql(_RULES, f"SELECT {_COUNTERS}, scope, CAST(rule_no AS BIGINT) AS rule_no FROM results"))
def l2p2_rule_results(spark, sf_dir):
    return rules.rule_results(B.daily(spark, sf_dir), *_market(spark, sf_dir)).select(*_RULE, "scope", "rule_no")


@query(
    O.sql(
        _RULES,
        """SELECT CAST(trading_date AS VARCHAR) AS trading_date, symbol, book_total_depth_unusable, trade_side_nullable, pass_count, fail_count, warn_count, skip_count, failing_rules, warning_rules, scopes,
        CASE WHEN fail_count > 0 THEN 'fail' WHEN warn_count > 0 OR book_total_depth_unusable OR trade_side_nullable THEN 'degraded' ELSE 'pass' END AS validation_status
        FROM (SELECT symbol, trading_date, """
        + ", ".join(f"count(*) FILTER (status = '{s}') AS {s}_count" for s in ("pass", "fail", "warn", "skip"))
        + """, coalesce(string_agg(rule_id, ',' ORDER BY rule_no) FILTER (status = 'fail'), '') AS failing_rules, coalesce(string_agg(rule_id, ',' ORDER BY rule_no) FILTER (status = 'warn'), '') AS warning_rules,
        string_agg(scope || '.' || rule_id || '=' || status, ',' ORDER BY scope || '.' || rule_id) AS scopes FROM results GROUP BY ALL) JOIN flags USING (symbol, trading_date)""",
    )
)
def dq12_dq13_ag04_ag06_validation_status(spark, sf_dir):
    days, (snap, book, trade) = B.daily(spark, sf_dir), _market(spark, sf_dir)
    out = rules.validation_status(rules.rule_results(days, snap, book, trade), book, trade)
    scopes = F.array_join(F.array_sort(F.transform(F.map_entries("status_by_rule"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ",")
    lists = [F.array_join(c, ",").alias(c) for c in ("failing_rules", "warning_rules")]
    names = ["book_total_depth_unusable", "trade_side_nullable", "pass_count", "fail_count", "warn_count", "skip_count", "validation_status"]
    return out.select(*KEYS, *names, *lists, scopes.alias("scopes"))


# ---- intake, normalization, scalar functions -------------------------------------------------------------------

RAW = """SELECT event_id, event_type, ts, CASE event_id % 5 WHEN 0 THEN ' s/' WHEN 1 THEN 'S\\' WHEN 2 THEN '' ELSE 's' END || CASE WHEN event_id % 5 = 2 THEN '' ELSE CAST(user_id % 10 AS VARCHAR) END AS symbol,
    value, TRY_CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) AS k FROM events"""


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the raw text records of a feed: unclean symbols, ISO times with and without zone, numbers as text."""
    e = B.table(spark, sf_dir, "events")
    k = F.regexp_extract("props", r"(\d+)", 1).try_cast("bigint")
    pick, user = F.col("event_id") % 5, (F.col("user_id") % 10).cast("string")
    symbol = F.when(pick == 2, "").otherwise(F.concat(F.when(pick == 0, " s/").when(pick == 1, "S\\").otherwise("s"), user))
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS")
    event_time = F.when(k % 10 == 0, "garbage").when(k % 2 == 0, F.concat(iso, F.lit("Z"))).otherwise(iso)
    return e.select(
        "event_id", "event_type", symbol.alias("symbol"), event_time.alias("event_time"),
        F.when(k % 3 == 0, F.concat(iso, F.lit("+00:00"))).otherwise(iso).alias("ts"),
        F.when(k % 7 == 0, "x").otherwise(F.col("value").cast("string")).alias("last_price"),
        F.concat(F.lit(" "), k.cast("string")).alias("deal_volume"), F.when(k % 4 == 0, " b").when(k % 4 == 1, "S").when(k % 4 == 2, " ").alias("side"),
        F.col("event_id").cast("string").alias("trade_id"), F.col("value").cast("string").alias("price"), k.cast("string").alias("volume"),
    )


_SYMBOL = "coalesce(nullif(translate(trim(upper(symbol)), '/\\', '__'), ''), 'UNKNOWN')"
_MS = "epoch_us(date_trunc('millisecond', ts))"
_EVENT_US = f"CASE WHEN k % 10 <> 0 THEN {_MS} END"
_INGEST_US = f"CASE WHEN k % 3 = 0 THEN {_MS} ELSE {_MS} - 25200000000 END"
_DAY = "CAST(CAST(CASE WHEN k % 10 <> 0 THEN ts + INTERVAL 7 HOUR ELSE ts END AS DATE) AS VARCHAR)"
_ZONE = "CASE WHEN k % 3 = 0 THEN 'explicit' ELSE 'assumed' END AS ingested_tz_source"


@query(
    O.sql(
        {"raw": RAW},
        f"SELECT event_id, {_SYMBOL} AS symbol, {_DAY} AS trading_date, {_EVENT_US} AS event_us, {_INGEST_US} AS ingested_us, {_ZONE}, CASE WHEN k % 7 <> 0 THEN round(value, 6) + 0.0 END AS last_price, CAST(k AS DOUBLE) AS deal_volume FROM raw",
    )
)
def fn01_fn08_normalize_snapshots(spark, sf_dir):
    out = normalize.normalize_snapshots(raw_events(spark, sf_dir), keep=("event_id",))
    return out.select("event_id", *KEYS, "event_us", "ingested_us", "ingested_tz_source", "last_price", "deal_volume")


@query(
    O.sql(
        {"raw": RAW},
        f"""SELECT event_id, {_SYMBOL} AS symbol, {_DAY} AS trading_date, {_EVENT_US} AS event_us, event_id AS trade_id, round(value, 6) + 0.0 AS price, CAST(k AS DOUBLE) AS volume,
        CASE WHEN k % 4 = 0 THEN 'B' WHEN k % 4 = 1 THEN 'S' END AS side FROM raw""",
    )
)
def fn02_fn17_normalize_trades(spark, sf_dir):
    out = normalize.normalize_trades(raw_events(spark, sf_dir), keep=("event_id",))
    return out.select("event_id", *KEYS, "event_us", "trade_id", "price", "volume", "side")


_TOD = f"(({_MS} + 25200000000) % 86400000000)"


@query(
    O.sql(
        {"raw": RAW},
        f"SELECT event_id, {_SYMBOL} AS symbol FROM raw WHERE k % 10 <> 0 AND (({_TOD} >= 32400000000 AND {_TOD} < 41400000000) OR {_TOD} BETWEEN 46800000000 AND 53100000000)",
    )
)
def flt01_session_gate(spark, sf_dir):
    return normalize.session_only(normalize.normalize_snapshots(raw_events(spark, sf_dir), keep=("event_id",))).select("event_id", "symbol")


@query(
    O.sql(
        {"ev": O.MARKET["ev"]},
        """SELECT seq, (tod BETWEEN 32400000000 AND 41400000000) OR (tod BETWEEN 46800000000 AND 53100000000) AS in_session, (tod >= 32400000000 AND tod < 32700000000) OR (tod BETWEEN 52800000000 AND 53100000000) AS auction,
        tod BETWEEN 52200000000 AND 53100000000 AS near_close FROM (SELECT seq, local_us % 86400000000 AS tod FROM ev)""",
    )
)
def flt08_session_flags(spark, sf_dir):
    tod = X.time_of_day(F.col("local_us"))
    return B.events(spark, sf_dir).select("seq", X.in_quality_session(tod).alias("in_session"), X.in_auction(tod).alias("auction"), X.near_close(tod).alias("near_close"))


@query(
    O.sql(
        {"raw": RAW},
        """SELECT event_id, 'bid' AS side, i AS level_no, round(CASE WHEN i <> 2 THEN value - i END, 6) + 0.0 AS price, CAST(k * i AS DOUBLE) AS volume
        FROM raw, (VALUES (1), (2), (4)) l(i) WHERE event_type = 'click'""",
    )
)
def fn18_normalize_levels(spark, sf_dir):
    """Levels numbered by their raw place: the third entry is missing but keeps its number."""
    e = raw_events(spark, sf_dir).filter("event_type = 'click'")
    level = lambda i: F.struct(F.when(F.lit(i != 2), (F.col("price").cast("double") - i).cast("string")).alias("price"), (F.col("volume").cast("bigint") * i).cast("string").alias("volume"))
    gap = F.when(F.lit(False), level(3))
    raw = e.withColumn("bid_levels", F.array(level(1), level(2), gap, level(4))).withColumn("ask_levels", F.col("bid_levels"))
    out = normalize.normalize_books(raw, keep=("event_id",)).select("event_id", F.lit("bid").alias("side"), F.explode("bid_levels").alias("x"))
    return out.select("event_id", "side", "x.*")


_CUTS = "('1995-06-01', '1998-01-01')"


@query(
    """SELECT o_orderpriority AS symbol, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS trading_date, count(*) AS record_count, count(*) FILTER (o_totalprice IS NOT NULL) AS priced_count,
    bool_and(o_totalprice > 0) AS complete, max(o_orderkey) AS newest, count(DISTINCT o_custkey) AS file_count FROM orders GROUP BY ALL"""
)
def ag01_ag02_source_counts(spark, sf_dir):
    o = B.table(spark, sf_dir, "orders").withColumnsRenamed({"o_orderpriority": "symbol", "o_orderkey": "mtime", "o_custkey": "path"})
    o = o.withColumn("trading_date", F.col("o_orderdate").cast("date"))
    return intake.source_counts(o, "o_totalprice")


@query(
    """SELECT o_orderpriority AS symbol, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS trading_date, o_orderkey AS mtime, o_custkey AS path
    FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderpriority, CAST(o_orderdate AS DATE) ORDER BY o_custkey DESC, o_orderkey DESC) = 1"""
)
def flt07_latest_source(spark, sf_dir):
    o = B.table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("symbol"), F.col("o_orderdate").cast("date").alias("trading_date"), F.col("o_orderkey").alias("mtime"), F.col("o_custkey").alias("path"))
    return intake.latest_source(o, ["path", "mtime"])


@query(
    """SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE CAST(l_shipdate AS DATE) = CAST(o_orderdate AS DATE) AND l_returnflag = 'R')"""
)
def flt04_days_with_intraday(spark, sf_dir):
    """Daily records only of days that have intraday records: a semi-join on days."""
    o = B.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("trading_date"), F.lit("all").alias("symbol"))
    i = B.table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.lit("all").alias("symbol"), F.col("l_shipdate").cast("date").alias("trading_date"))
    return intake.with_intraday(o, i).select("o_orderkey")


@query(O.sql(O.MARKET, "SELECT event_id FROM events WHERE upper('s' || CAST(user_id % 10 AS VARCHAR)) IN ('S1', 'S4')"))
def src05_symbol_filter(spark, sf_dir):
    return intake.only_symbols(B.events(spark, sf_dir), "s1, S4,").select(F.col("seq").alias("event_id"))


@query(
    O.sql(
        O.MARKET,
        """SELECT CAST(trading_date AS VARCHAR) AS trading_date, symbol, count(*) AS record_count FROM ev WHERE (symbol, trading_date) NOT IN (SELECT (symbol, trading_date) FROM ev WHERE k % 10 = 0) GROUP BY ALL""",
    )
)
def flt06_quarantine(spark, sf_dir):
    """Days with a record whose time cannot be read fail as a whole; the rest is counted."""
    e = B.events(spark, sf_dir).withColumn("t", F.when(F.col("k") % 10 != 0, F.col("event_us")))
    good, _ = intake.quarantine(e, F.col("t").isNull())
    return good.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("record_count"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import run_queries, source_queries

    return QUERIES | source_queries.queries() | run_queries.QUERIES


def oracle_sql() -> dict[str, str]:
    from . import run_queries, source_queries

    return SQL | source_queries.oracle_sql() | run_queries.SQL
