"""The queries' meaning in DuckDB SQL: named common table expressions over the test tables, and a SELECT for each."""

from __future__ import annotations

H = 3_600_000_000

MARKET = {
    "ev": """SELECT 'S' || CAST(user_id % 10 AS VARCHAR) AS symbol, epoch_us(ts) AS event_us, event_id AS seq, event_type, value,
        TRY_CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) AS k, epoch_us(ts) + 7 * 3600000000 AS local_us,
        CAST(ts + INTERVAL 7 HOUR AS DATE) AS trading_date FROM events""",
    "snap": """SELECT symbol, trading_date, event_us, seq, local_us, CASE WHEN k % 11 <> 0 THEN value END AS last_price,
        CASE WHEN k % 5 <> 0 THEN k * 1000.0::DOUBLE END AS deal_volume, CASE WHEN k % 7 <> 0 THEN value * k * 1000.0::DOUBLE END AS deal_value,
        k * 400.0::DOUBLE AS active_buy_volume, CASE WHEN k % 3 <> 1 THEN k * 600.0::DOUBLE + k % 4 END AS active_sell_volume
        FROM ev WHERE event_type = 'view'""",
    "book": """SELECT symbol, trading_date, event_us, seq, k, floor(value / 100) * 10.0::DOUBLE + 10.0::DOUBLE AS base,
        CASE WHEN k % 13 <> 0 THEN 3 ELSE 2 END AS places, CASE WHEN k % 2 = 0 THEN 0.0::DOUBLE ELSE k * 1.0::DOUBLE END AS total_bid FROM ev WHERE event_type = 'click'""",
    "trade": """SELECT symbol, trading_date, event_us, seq, CASE WHEN k % 17 <> 0 THEN seq END AS trade_id,
        round(floor(value / 100) * 10.0::DOUBLE + 10.0::DOUBLE + (k % 7 - 3) * 0.1::DOUBLE, 6) AS price, k * 10.0::DOUBLE AS volume,
        CASE event_type WHEN 'purchase' THEN 'B' WHEN 'error' THEN 'S' END AS side FROM ev WHERE event_type IN ('purchase', 'error', 'signup')""",
    "frames": "SELECT *, row_number() OVER (PARTITION BY symbol, trading_date ORDER BY event_us, seq) AS frame_no FROM snap",
    "day_sums": """SELECT symbol, trading_date, arg_min(value, seq) AS price_open, max(value) AS price_high, min(value) AS price_low,
        arg_max(value, seq) AS price_close, CAST(sum(k) AS DOUBLE) AS q, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) AS cents FROM ev GROUP BY ALL""",
    "dly": """SELECT symbol, trading_date, price_open, price_high, price_low, price_close,
        cents / 100.0::DOUBLE / n + CASE WHEN n % 4 = 0 THEN 0.05::DOUBLE ELSE 0.001::DOUBLE END AS price_average, q * 100 AS total_volume, q * 90 AS deal_volume,
        q * 10 + n % 3 AS putthrough_volume, cents / 100.0::DOUBLE + cents / 100.0::DOUBLE / n * q * 90 * 1000 AS total_value, cents / 100.0::DOUBLE AS putthrough_value,
        q * 3 AS buy_foreign_quantity, CASE WHEN n % 6 <> 0 THEN q * 2 END AS sell_foreign_quantity, q AS prop_net_deal_value,
        CAST(n AS DOUBLE) AS prop_net_pt_value, q + n + n % 5 AS prop_net_value, 1000.0::DOUBLE AS unit FROM day_sums""",
    "fb": """SELECT f.symbol, f.trading_date, f.frame_no, f.event_us, b.event_us AS book_us, b.base, b.k AS bk, b.places
        FROM frames f ASOF LEFT JOIN book b ON f.symbol = b.symbol AND f.trading_date = b.trading_date AND f.event_us >= b.event_us""",
    "ft": """SELECT f.symbol, f.trading_date, f.frame_no, t.event_us AS trade_us, t.price AS last_trade_price, t.volume AS last_trade_volume, t.side AS last_trade_side
        FROM frames f ASOF LEFT JOIN trade t ON f.symbol = t.symbol AND f.trading_date = t.trading_date AND f.event_us >= t.event_us""",
    "flow": "SELECT f.symbol, f.trading_date, f.frame_no, "
    + ", ".join(
        f"""count(t.seq) FILTER (t.event_us > f.event_us - {h * H}) AS trade_count_{h}h, sum(t.volume) FILTER (t.event_us > f.event_us - {h * H}) AS volume_sum_{h}h,
        sum(CASE t.side WHEN 'B' THEN t.volume WHEN 'S' THEN -t.volume ELSE 0 END) FILTER (t.event_us > f.event_us - {h * H}) AS signed_volume_{h}h,
        count(t.seq) FILTER (t.side IS NULL AND t.event_us > f.event_us - {h * H}) AS null_side_count_{h}h"""
        for h in (2, 6, 24)
    )
    + """, count(t.seq) AS trade_count_intraday, sum(t.volume) AS run_volume, sum(t.price * t.volume) AS run_value
        FROM frames f LEFT JOIN trade t ON f.symbol = t.symbol AND f.trading_date = t.trading_date AND t.event_us <= f.event_us GROUP BY ALL""",
    "assigned": """SELECT t.symbol, t.trading_date, t.seq, t.price, t.volume, t.side, f.frame_no
        FROM trade t ASOF LEFT JOIN frames f ON t.symbol = f.symbol AND t.trading_date = f.trading_date AND t.event_us <= f.event_us""",
    "lev": """SELECT symbol, trading_date, frame_no, event_us, side, i AS nth, round(base + CASE side WHEN 'bid' THEN -0.1::DOUBLE ELSE 0.1::DOUBLE END * i, 6) AS price, (bk + i) * 100.0::DOUBLE AS volume
        FROM fb, (VALUES ('bid'), ('ask')) s(side), (VALUES (1), (2), (3)) l(i) WHERE book_us IS NOT NULL AND i <= places""",
    "matched": """SELECT symbol, trading_date, frame_no, price, x.side, sum(volume) AS matched FROM assigned a, (VALUES ('bid'), ('ask')) x(side)
        WHERE frame_no IS NOT NULL AND (a.side IS NULL OR (a.side = 'S' AND x.side = 'bid') OR (a.side = 'B' AND x.side = 'ask')) GROUP BY ALL""",
}

EXPIRY_US = 5 * H
DEEP = {
    "clock": f"""SELECT f.symbol, f.trading_date, f.frame_no, f.event_us, lag(f.event_us) OVER w AS t_before, max(f.frame_no) OVER (PARTITION BY f.symbol, f.trading_date) AS last_frame,
        (SELECT min(g.frame_no) FROM frames g WHERE g.symbol = f.symbol AND g.trading_date = f.trading_date AND g.event_us >= f.event_us + {EXPIRY_US}) AS expiry_frame
        FROM frames f WINDOW w AS (PARTITION BY f.symbol, f.trading_date ORDER BY f.frame_no)""",
    "seen0": f"""SELECT l.*, c.expiry_frame, c.last_frame, CASE WHEN l.frame_no - 1 > lag(l.frame_no) OVER w AND c.t_before - lag(l.event_us) OVER w >= {EXPIRY_US} THEN 1
        WHEN lag(l.frame_no) OVER w IS NULL THEN 1 ELSE 0 END AS fresh, lead(l.frame_no) OVER w AS next_no
        FROM lev l JOIN clock c USING (symbol, trading_date, frame_no) WINDOW w AS (PARTITION BY l.symbol, l.trading_date, l.side, l.price ORDER BY l.frame_no)""",
    "seen1": "SELECT *, sum(fresh) OVER (PARTITION BY symbol, trading_date, side, price ORDER BY frame_no) AS life FROM seen0",
    "seen2": """SELECT *, row_number() OVER w AS vis, min(frame_no) OVER w AS first_no, min(event_us) OVER w AS first_us, max(volume) OVER w AS biggest FROM seen1
        WINDOW w AS (PARTITION BY symbol, trading_date, side, price, life ORDER BY frame_no)""",
    "seen": """SELECT *, count(*) FILTER (frame_no - first_no <> vis - 1) OVER (PARTITION BY symbol, trading_date, side, price, life ORDER BY frame_no) AS reapp,
        least(coalesce(next_no - 1, last_frame), coalesce(expiry_frame, last_frame)) AS until_no FROM seen2""",
    "gone0": """SELECT s.symbol, s.trading_date, s.side, s.price, s.frame_no AS seen_no, s.event_us AS seen_us, s.volume, s.biggest, s.reapp, s.first_us, f.frame_no, f.event_us,
        least(greatest(s.volume, 0), coalesce(sum(m.matched) OVER (PARTITION BY s.symbol, s.trading_date, s.side, s.price, s.frame_no ORDER BY f.frame_no), 0)) AS executed,
        CAST(floor((f.event_us - s.event_us) / 1000) AS BIGINT) AS stale
        FROM seen s JOIN frames f ON f.symbol = s.symbol AND f.trading_date = s.trading_date AND f.frame_no > s.frame_no AND f.frame_no <= s.until_no
        LEFT JOIN matched m ON m.symbol = s.symbol AND m.trading_date = s.trading_date AND m.frame_no = f.frame_no AND m.side = s.side AND m.price = s.price""",
    "gone1": """SELECT *, CASE WHEN volume <= 0 THEN 1.0::DOUBLE ELSE executed / volume END AS ratio, greatest(volume - executed, 0) AS carry FROM gone0""",
    "gone2": """SELECT *, least(1, greatest(0, 0.35::DOUBLE * (1 - ratio) + 0.20::DOUBLE * least(1, biggest / 5000.0::DOUBLE) + 0.25::DOUBLE * least(1, reapp / 3.0::DOUBLE)
        + 0.20::DOUBLE * least(1, stale / 18000000.0::DOUBLE))) AS score FROM gone1""",
    "gone": """SELECT *, CASE WHEN stale >= 18000000 THEN 'EXPIRED' WHEN ratio >= 0.95 THEN 'CONSUMED_BY_TRADES' WHEN carry > 0 AND stale <= 1800000 THEN 'CARRIED_OUTSIDE_TOP3'
        WHEN stale >= 3600000 AND reapp > 0 AND score >= 0.5 AND biggest >= 5000 THEN 'SUSPECTED_FAKE_WALL' ELSE 'PULLED_OR_CANCELLED' END AS state FROM gone2""",
    "deep0": """SELECT symbol, trading_date, side, price, frame_no, state, first_us AS first_seen_us, seen_us AS last_seen_us, volume AS last_observed_volume,
        biggest AS max_observed_volume, reapp AS reappeared_count, stale AS stale_age_ms, executed AS executed_volume_at_price, ratio AS trade_explained_ratio,
        carry AS carry_forward_volume, score AS wall_suspicion_score, FALSE AS fresh_life FROM gone
        UNION ALL SELECT symbol, trading_date, side, price, frame_no, CASE WHEN reapp > 0 THEN 'REAPPEARED' ELSE 'OBSERVED_TOP3' END, first_us, event_us, volume, biggest, reapp, 0,
        0.0::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, vis = 1 FROM seen""",
    "deep": """SELECT *, CASE WHEN fresh_life THEN 0.95::DOUBLE ELSE greatest(0, least(1, CASE state WHEN 'OBSERVED_TOP3' THEN 0.95::DOUBLE WHEN 'REAPPEARED' THEN 0.88 WHEN 'CONSUMED_BY_TRADES' THEN 0.78
        WHEN 'CARRIED_OUTSIDE_TOP3' THEN 0.72 WHEN 'PULLED_OR_CANCELLED' THEN 0.64 WHEN 'SUSPECTED_FAKE_WALL' THEN 0.58 ELSE 0.40 END
        - 0.20::DOUBLE * least(1, stale_age_ms / 18000000.0::DOUBLE))) END AS reconstruction_confidence FROM deep0""",
    "shown": """SELECT f.symbol, f.trading_date, f.frame_no, s.side, count(l.nth) FILTER (l.nth <= 3) AS observed_count, coalesce(sum(l.volume) FILTER (l.nth <= 3), 0) AS observed_depth
        FROM frames f CROSS JOIN (VALUES ('bid'), ('ask')) s(side) LEFT JOIN lev l ON l.symbol = f.symbol AND l.trading_date = f.trading_date AND l.frame_no = f.frame_no AND l.side = s.side GROUP BY ALL""",
    "memo": """SELECT d.symbol, d.trading_date, d.frame_no, d.side, CASE WHEN carry_forward_volume > 0 THEN carry_forward_volume ELSE last_observed_volume END AS fill,
        row_number() OVER (PARTITION BY d.symbol, d.trading_date, d.frame_no, d.side ORDER BY CASE d.side WHEN 'bid' THEN -d.price ELSE d.price END) AS rank
        FROM deep d WHERE state <> 'EXPIRED' AND CASE WHEN carry_forward_volume > 0 THEN carry_forward_volume ELSE last_observed_volume END > 0
        AND NOT EXISTS (SELECT 1 FROM lev l WHERE l.symbol = d.symbol AND l.trading_date = d.trading_date AND l.frame_no = d.frame_no AND l.side = d.side AND l.price = d.price)""",
    "filled": """SELECT s.symbol, s.trading_date, s.frame_no, s.side, s.observed_count, s.observed_depth, count(m.rank) AS used_count, coalesce(sum(m.fill), 0) AS used_depth
        FROM shown s LEFT JOIN memo m ON m.symbol = s.symbol AND m.trading_date = s.trading_date AND m.frame_no = s.frame_no AND m.side = s.side AND m.rank <= 5 - s.observed_count GROUP BY ALL""",
    "ext": """SELECT symbol, trading_date, frame_no, max(observed_depth + used_depth) FILTER (side = 'bid') AS bid_depth_l5, max(observed_depth + used_depth) FILTER (side = 'ask') AS ask_depth_l5,
        max(observed_count) FILTER (side = 'bid') AS observed_bid_level_count, max(observed_count) FILTER (side = 'ask') AS observed_ask_level_count,
        max(used_count) FILTER (side = 'bid') AS reconstructed_bid_levels_used, max(used_count) FILTER (side = 'ask') AS reconstructed_ask_levels_used,
        CAST(sum(5 - observed_count - used_count) AS BIGINT) AS missing_depth_level_count, max(used_count) > 0 AS used_reconstructed_depth_l5 FROM filled GROUP BY ALL""",
}

_SIDES = " ".join(
    f"""coalesce((SELECT sum(volume) FROM lev l WHERE l.symbol = f.symbol AND l.trading_date = f.trading_date AND l.frame_no = f.frame_no AND l.side = '{s}' AND l.nth <= {n}), 0) AS {s}_depth_l{n},"""
    for s in ("bid", "ask")
    for n in (1, 3)
)
STATE = {
    "st0": f"""SELECT f.symbol, f.trading_date, f.frame_no, f.event_us, f.local_us, ft.last_trade_price, ft.last_trade_volume, ft.last_trade_side, coalesce(f.deal_volume, flow.run_volume) AS cum_volume,
        coalesce(f.deal_value, flow.run_value) AS cum_trade_value, coalesce(f.last_price, ft.last_trade_price) AS current_price, d.price_open AS day_open,
        round(fb.base - 0.1::DOUBLE, 6) AS best_bid, round(fb.base + 0.1::DOUBLE, 6) AS best_ask, (fb.bk + 1) * 100.0::DOUBLE AS best_bid_size, (fb.bk + 1) * 100.0::DOUBLE AS best_ask_size,
        {_SIDES} CAST(floor((f.event_us - fb.book_us) / 1000) AS BIGINT) AS book_age_ms, CAST(floor((f.event_us - ft.trade_us) / 1000) AS BIGINT) AS tick_age_ms,
        flow.* EXCLUDE (symbol, trading_date, frame_no), ext.* EXCLUDE (symbol, trading_date, frame_no)
        FROM frames f JOIN fb USING (symbol, trading_date, frame_no) JOIN ft USING (symbol, trading_date, frame_no) JOIN flow USING (symbol, trading_date, frame_no)
        JOIN ext USING (symbol, trading_date, frame_no) LEFT JOIN dly d USING (symbol, trading_date)""",
    "st1": """SELECT *, (best_bid + best_ask) / 2 AS mid_price, best_ask - best_bid AS spread, max(current_price) OVER w AS day_high_so_far, min(current_price) OVER w AS day_low_so_far
        FROM st0 WINDOW w AS (PARTITION BY symbol, trading_date ORDER BY frame_no)""",
    "state": """SELECT *, spread / nullif(mid_price, 0) * 10000 AS spread_bps, cum_trade_value / nullif(cum_volume, 0) AS vwap_intraday, current_price / nullif(day_open, 0) - 1 AS intraday_return_from_open,
        CASE WHEN day_high_so_far <> day_low_so_far AND current_price IS NOT NULL THEN greatest(0, least(1, (current_price - day_low_so_far) / (day_high_so_far - day_low_so_far))) END AS intraday_pos_in_range FROM st1""",
    "ret": """SELECT *, current_price / nullif(lag(current_price) OVER (PARTITION BY symbol, trading_date ORDER BY frame_no), 0) - 1 AS frame_return FROM state""",
    "vol": "SELECT a.symbol, a.trading_date, a.frame_no, "
    + ", ".join(
        f"""sqrt(sum(b.frame_return * b.frame_return) FILTER (b.frame_no > (SELECT count(*) + 1 FROM ret c WHERE c.symbol = a.symbol AND c.trading_date = a.trading_date AND c.event_us <= a.event_us - {h * H}))) AS rv_{h}h"""
        for h in (2, 6, 24)
    )
    + " FROM ret a JOIN ret b ON a.symbol = b.symbol AND a.trading_date = b.trading_date AND b.frame_no <= a.frame_no GROUP BY ALL",
    "lagged": "SELECT a.symbol, a.trading_date, a.frame_no, "
    + ", ".join(f"arg_max_null(b.current_price, b.frame_no) FILTER (b.event_us <= a.event_us - {h * H}) AS lag_{h}h" for h in (2, 6))
    + " FROM state a JOIN state b ON a.symbol = b.symbol AND a.trading_date = b.trading_date GROUP BY ALL",
    "base": """SELECT ret.*, rv_2h, rv_6h, rv_24h, current_price / nullif(lag_2h, 0) - 1 AS ret_2h, current_price / nullif(lag_6h, 0) - 1 AS ret_6h, trade_count_2h / 7200.0::DOUBLE AS trade_intensity_2h, """
    + ", ".join(
        f"(bid_depth_l{n} - ask_depth_l{n}) / nullif(bid_depth_l{n} + ask_depth_l{n}, 0) AS book_imbalance_l{n}, bid_depth_l{n} / nullif(ask_depth_l{n}, 0) AS depth_ratio_l{n}" for n in (1, 3, 5)
    )
    + """, CASE WHEN best_bid_size + best_ask_size > 0 THEN best_bid_size / (best_bid_size + best_ask_size) END AS queue_pressure_l1
        FROM ret JOIN vol USING (symbol, trading_date, frame_no) JOIN lagged USING (symbol, trading_date, frame_no)""",
}


def technicals(bars: str) -> dict[str, str]:
    """Every indicator as of each bar of ``bars``, carried forward."""
    sma = ", ".join(f"CASE WHEN count(close) OVER (w ROWS {n - 1} PRECEDING) = {n} THEN avg(close) OVER (w ROWS {n - 1} PRECEDING) END AS ma_{n}" for n in (5, 10, 20, 50, 100, 200))
    fold = (
        lambda values, n: f"""CASE WHEN len({values}) < {n} THEN NULL ELSE list_reduce({values}[{n + 1}:], lambda a, v: {2 / (n + 1)!r}::DOUBLE * v + {1 - 2 / (n + 1)!r}::DOUBLE * a, list_avg({values}[1:{n}])) END"""
    )
    names = "ma_5 ma_10 ma_20 ma_50 ma_100 ma_200 rsi_14_d bollinger_mid_20 bollinger_upper_20 bollinger_lower_20 volatility_20d ma20_slope_5d ma20_ma200_ratio ema_12 ema_20 ema_26 macd_line_d macd_signal_d".split()
    carry = ", ".join(f"last_value(CASE WHEN m.date IS NOT NULL THEN struct_pack(v := m.{c}) END IGNORE NULLS) OVER (PARTITION BY b.symbol ORDER BY b.date).v AS {c}" for c in names)
    return {
        "cl": f"SELECT symbol, date, close, close - lag(close) OVER w AS change, close / nullif(lag(close) OVER w, 0) - 1 AS ret, row_number() OVER w AS nth FROM {bars} WHERE close IS NOT NULL WINDOW w AS (PARTITION BY symbol ORDER BY date)",
        "mv0": f"""SELECT symbol, date, nth, {sma}, avg(greatest(change, 0)) OVER (w ROWS 13 PRECEDING) AS gain, avg(greatest(-change, 0)) OVER (w ROWS 13 PRECEDING) AS loss,
            stddev_samp(close) OVER (w ROWS 19 PRECEDING) AS sigma, stddev_samp(ret) OVER (w ROWS 19 PRECEDING) AS rvol, list(close) OVER (w ROWS UNBOUNDED PRECEDING) AS closes
            FROM cl WINDOW w AS (PARTITION BY symbol ORDER BY date)""",
        "mv1": f"SELECT *, {fold('closes', 12)} AS ema_12, {fold('closes', 20)} AS ema_20, {fold('closes', 26)} AS ema_26 FROM mv0",
        "mv2": "SELECT *, ema_12 - ema_26 AS macd_line_d, list(ema_12 - ema_26) FILTER (ema_26 IS NOT NULL) OVER (PARTITION BY symbol ORDER BY date) AS lines FROM mv1",
        "mv": f"""SELECT symbol, date, ma_5, ma_10, ma_20, ma_50, ma_100, ma_200, CASE WHEN nth >= 15 THEN CASE WHEN loss = 0 THEN 100.0::DOUBLE ELSE 100 - 100 / (1 + gain / loss) END END AS rsi_14_d,
            ma_20 AS bollinger_mid_20, ma_20 + 2 * sigma AS bollinger_upper_20, ma_20 - 2 * sigma AS bollinger_lower_20, CASE WHEN nth >= 21 THEN rvol END AS volatility_20d,
            (ma_20 - lag(ma_20, 5) OVER w) / nullif(lag(ma_20, 5) OVER w, 0) AS ma20_slope_5d, ma_20 / nullif(ma_200, 0) AS ma20_ma200_ratio, ema_12, ema_20, ema_26, macd_line_d,
            {fold('coalesce(lines, [])', 9)} AS macd_signal_d FROM mv2 WINDOW w AS (PARTITION BY symbol ORDER BY date)""",
        "vm": f"SELECT symbol, date, CASE WHEN count(volume) OVER w = 20 THEN avg(volume) OVER w END AS avg_volume_20d FROM {bars} WHERE volume IS NOT NULL WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS 19 PRECEDING)",
        "tr0": f"SELECT *, lag(close) OVER w AS pc, row_number() OVER w AS bar_no FROM {bars} WINDOW w AS (PARTITION BY symbol ORDER BY date)",
        "tr1": """SELECT symbol, date, bar_no, CASE WHEN pc IS NULL THEN high - low ELSE greatest(high - low, abs(high - pc), abs(low - pc)) END AS tr
            FROM tr0 WHERE high IS NOT NULL AND low IS NOT NULL AND close IS NOT NULL""",
        "avtr": "SELECT symbol, date, CASE WHEN bar_no >= 15 AND count(tr) OVER w = 14 THEN avg(tr) OVER w END AS atr_14 FROM tr1 WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS 13 PRECEDING)",
        "tech": f"""SELECT b.symbol, b.date, b.close AS bar_close, count(*) OVER (PARTITION BY b.symbol ORDER BY b.date) AS available_days, {carry},
            last_value(CASE WHEN v.date IS NOT NULL THEN struct_pack(v := v.avg_volume_20d) END IGNORE NULLS) OVER (PARTITION BY b.symbol ORDER BY b.date).v AS avg_volume_20d,
            last_value(CASE WHEN a.date IS NOT NULL THEN struct_pack(v := a.atr_14) END IGNORE NULLS) OVER (PARTITION BY b.symbol ORDER BY b.date).v AS atr_14
            FROM {bars} b LEFT JOIN mv m USING (symbol, date) LEFT JOIN vm v USING (symbol, date) LEFT JOIN avtr a USING (symbol, date)""",
    }


ORDER_BARS = {
    "ob0": """SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS date, arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high, min(o_totalprice) AS low,
        arg_max(o_totalprice, o_orderkey) AS close, count(*) * 100.0::DOUBLE AS volume FROM orders GROUP BY ALL""",
    "ob": """SELECT symbol, date, open, CASE WHEN day(date) <> 17 THEN high END AS high, low, CASE WHEN day(date) <> 19 THEN close END AS close,
        CASE WHEN day(date) <> 23 THEN volume END AS volume FROM ob0""",
}
EVENT_BARS = {"eb": "SELECT symbol, trading_date AS date, price_open AS open, price_high AS high, price_low AS low, price_close AS close, total_volume AS volume FROM dly"}

TECH_NAMES = (
    "available_days ma_5 ma_10 ma_20 ma_50 ma_100 ma_200 rsi_14_d bollinger_mid_20 bollinger_upper_20 bollinger_lower_20 volatility_20d ma20_slope_5d ma20_ma200_ratio "
    "ema_12 ema_20 ema_26 macd_line_d macd_signal_d avg_volume_20d atr_14"
).split()

STORE = {
    "asof_tech": "SELECT d.symbol, d.trading_date, "
    + ", ".join(f"t.{c}" for c in TECH_NAMES)
    + """, t.macd_line_d - t.macd_signal_d AS macd_hist_d, t.bar_close AS previous_close
        FROM dly d ASOF LEFT JOIN tech t ON d.symbol = t.symbol AND d.trading_date > t.date""",
    "store": """SELECT b.*, t.* EXCLUDE (symbol, trading_date), current_price / nullif(t.ma_20, 0) AS price_to_ma20, current_price / nullif(t.ma_200, 0) AS price_to_ma200,
        day_open / nullif(t.previous_close, 0) - 1 AS gap_pct, cum_volume / nullif(t.avg_volume_20d, 0) AS relative_volume_day, current_price / nullif(day_high_so_far, 0) - 1 AS distance_to_day_high,
        current_price / nullif(day_low_so_far, 0) - 1 AS distance_to_day_low, CASE WHEN local_us % 86400000000 >= 53100000000 THEN d.buy_foreign_quantity - d.sell_foreign_quantity END AS foreign_net_volume_day,
        CASE WHEN local_us % 86400000000 >= 53100000000 THEN (d.buy_foreign_quantity - d.sell_foreign_quantity) / nullif(d.total_volume, 0) END AS foreign_net_ratio_day,
        signed_volume_2h * book_imbalance_l1 AS signed_volume_x_imbalance, current_price / nullif(vwap_intraday, 0) * (cum_volume / nullif(t.avg_volume_20d, 0)) AS price_to_vwap_x_relative_volume
        FROM base b LEFT JOIN asof_tech t USING (symbol, trading_date) LEFT JOIN dly d USING (symbol, trading_date)""",
    "q0": """SELECT *, local_us % 86400000000 AS tod,
        CASE WHEN trade_count_2h > 0 AND tick_age_ms IS NOT NULL THEN greatest(0, least(1, 1 - tick_age_ms / 7200000.0::DOUBLE)) ELSE 0 END AS tick_coverage_10s,
        CASE WHEN trade_count_6h > 0 AND tick_age_ms IS NOT NULL THEN greatest(0, least(1, 1 - tick_age_ms / 21600000.0::DOUBLE)) ELSE 0 END AS tick_coverage_60s,
        CASE WHEN book_age_ms IS NOT NULL THEN greatest(0, least(1, 1 - book_age_ms / 7200000.0::DOUBLE)) ELSE 0 END AS book_coverage_10s,
        CASE WHEN book_age_ms IS NOT NULL THEN greatest(0, least(1, 1 - book_age_ms / 21600000.0::DOUBLE)) ELSE 0 END AS book_coverage_60s,
        tick_age_ms AS stale_tick_ms, book_age_ms AS stale_book_ms, book_age_ms / 1000.0::DOUBLE AS stale_book_seconds,
        CASE WHEN trade_count_6h > 0 THEN null_side_count_6h / trade_count_6h ELSE 0 END AS trade_side_inferred_ratio, coalesce(spread < 0, TRUE) AS spread_invalid_flag,
        coalesce(abs(ret_2h) > 0.03, FALSE) OR coalesce(abs(ret_6h) > 0.06, FALSE) OR coalesce(rv_2h > 0.08, FALSE) OR coalesce(spread_bps > 500, FALSE) AS outlier_flag,
        coalesce(used_reconstructed_depth_l5, FALSE) AS book_reconstructed_flag, count(*) OVER (PARTITION BY symbol, trading_date, event_us) > 1 AS duplicate_event_flag FROM store""",
    "q1": """SELECT *, (tod BETWEEN 32400000000 AND 41400000000) OR (tod BETWEEN 46800000000 AND 53100000000) AS session_valid_flag,
        (tod >= 32400000000 AND tod < 32700000000) OR (tod BETWEEN 52800000000 AND 53100000000) AS auction_flag, tod BETWEEN 52200000000 AND 53100000000 AS near_close_flag FROM q0""",
    "q2": """SELECT *, greatest(0, least(1, 1 - 0.20::DOUBLE * (1 - tick_coverage_60s) - 0.20::DOUBLE * (1 - book_coverage_60s) - 0.10::DOUBLE * trade_side_inferred_ratio
        - CASE WHEN book_reconstructed_flag THEN 0.08::DOUBLE ELSE 0 END - 0.03::DOUBLE * least(coalesce(missing_depth_level_count, 0), 4) - CASE WHEN spread_invalid_flag THEN 0.08::DOUBLE ELSE 0 END
        - CASE WHEN outlier_flag THEN 0.05::DOUBLE ELSE 0 END - CASE WHEN duplicate_event_flag THEN 0.05::DOUBLE ELSE 0 END - CASE WHEN session_valid_flag THEN 0 ELSE 0.05::DOUBLE END)) AS feature_confidence FROM q1""",
    "quality": """SELECT *, greatest(0, least(1, (feature_confidence + tick_coverage_10s + tick_coverage_60s + book_coverage_10s + book_coverage_60s
        + CASE WHEN session_valid_flag THEN 1 ELSE 0 END) / 6)) AS data_quality_score FROM q2""",
}

ALL = MARKET | DEEP | STATE | EVENT_BARS | technicals("eb") | STORE


def sql(ctes: dict[str, str], select: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS MATERIALIZED ({body})" if name in ("lev", "deep", "state", "ret", "frames") else f"{name} AS ({body})" for name, body in ctes.items()) + "\n" + select


def columns(doubles: list[str], others: list[str], places: int = 6) -> str:
    """A select list: doubles rounded, the rest as they are, days as text."""
    out = [f"CAST({c} AS VARCHAR) AS {c}" if c in ("trading_date", "date") else f"CAST({c} AS BIGINT) AS {c}" if c.endswith(("_no", "_count", "_ms", "_days")) else c for c in others]
    return ", ".join(out + [f"round(CAST({c} AS DOUBLE), {places}) + 0.0 AS {c}" for c in doubles])
