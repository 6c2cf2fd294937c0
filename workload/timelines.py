"""Windows, joins in time, calendars (W, J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from macrotide.operators import joins, network, series as s, stats
from macrotide.plans import layers
from macrotide.session import scratch_dir
from macrotide.sources.sinks import write_bucketed
from macrotide.sources.tables import series_catalog
from workload import standins as st
from workload.registry import query, r6, rounded, table
from workload.standins import (
    BLOCKS, CATALOG, FACTS, FEES, INDICATORS, PEAKED, PRICES, REGIMES, RETURNS, SERIES_ROWS, VOLATILITY, WIDE, WIDE_FILLS,
    WIDE_PIVOTS, with_,
)

KEYED = "PARTITION BY asset_id ORDER BY date"


@query("w1_daily_return", with_(PRICES, RETURNS) + "SELECT asset_id, date, price_usd, daily_return FROM returns")
def w1(spark, sf):
    return st.returns(spark, sf).select("asset_id", "date", "price_usd", "daily_return")


_DENSE = """bounds AS (SELECT series_key, min(date) AS lo, max(date) AS hi FROM series GROUP BY 1),
days AS (SELECT series_key, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM bounds),
dense AS (SELECT series_key, date, numeric_value FROM days LEFT JOIN series USING (series_key, date))"""


@query("w2_forward_fill", with_(SERIES_ROWS, _DENSE) + """
SELECT series_key, date, last_value(numeric_value IGNORE NULLS)
  OVER (PARTITION BY series_key ORDER BY date ROWS UNBOUNDED PRECEDING) AS numeric_value FROM dense""")
def w2(spark, sf):
    points = st.series(spark, sf).select("series_key", "date", "numeric_value")
    return s.forward_fill(joins.densify(points, "series_key"), "series_key", "numeric_value")


@query("w2_forward_fill_blocks", with_(SERIES_ROWS, f"pivoted AS (SELECT date, {WIDE_PIVOTS} FROM series GROUP BY date)")
       + f"SELECT date, {WIDE_FILLS} FROM pivoted")
def w2_blocks(spark, sf):
    """The wide table has no key: all of it is one series, dealt in pieces."""
    return s.forward_fill_blocks(stats.pivot_series(st.series(spark, sf), INDICATORS), None, INDICATORS)


@query("w3_rolling_volatility", with_(PRICES, RETURNS, VOLATILITY)
       + f"SELECT asset_id, date, {r6('volatility')} AS volatility FROM volatile")
def w3(spark, sf):
    out = s.rolling_volatility(st.returns(spark, sf), "asset_id").select("asset_id", "date", "volatility")
    return rounded(out, "volatility")


def _ma(n: int) -> str:
    frame = f"OVER ({KEYED} ROWS {n - 1} PRECEDING)"
    return f"CASE WHEN count(price_usd) {frame} = {n} THEN {r6(f'avg(price_usd) {frame}')} END AS ma_{n}"


@query("w4_moving_averages", with_(PRICES) + f"SELECT asset_id, date, {_ma(7)}, {_ma(30)}, {_ma(90)} FROM prices")
def w4(spark, sf):
    out = s.moving_averages(st.prices(spark, sf), "asset_id")
    return rounded(out.select("asset_id", "date", "ma_7", "ma_30", "ma_90"), "ma_7", "ma_30", "ma_90")


@query("w5_momentum", with_(PRICES) + f"""
SELECT asset_id, date, price_usd / NULLIF(lag(price_usd, 10) OVER ({KEYED}), 0) - 1 AS momentum FROM prices""")
def w5(spark, sf):
    return s.momentum(st.prices(spark, sf), "asset_id", 10).select("asset_id", "date", "momentum")


@query("w6_daily_change_pct", with_(PRICES, RETURNS) + "SELECT asset_id, date, daily_return * 1e2 AS change_pct FROM returns")
def w6(spark, sf):
    return s.daily_change_pct(st.prices(spark, sf), "asset_id").select("asset_id", "date", "change_pct")


@query("w7_drawdown", with_(PRICES, PEAKED) + "SELECT asset_id, date, peak, drawdown FROM peaked")
def w7(spark, sf):
    return s.drawdown(st.prices(spark, sf), "asset_id").select("asset_id", "date", "peak", "drawdown")


@query("w7_drawdown_blocks", with_(PRICES, PEAKED) + "SELECT asset_id, date, peak, drawdown FROM peaked")
def w7_blocks(spark, sf):
    return s.drawdown_blocks(st.prices(spark, sf), "asset_id").select("asset_id", "date", "peak", "drawdown")


@query("w9_indicator_trend", with_(SERIES_ROWS) + """
SELECT series_key, date, numeric_value, numeric_value - lag(numeric_value) OVER w AS change,
  CASE sign(numeric_value - lag(numeric_value) OVER w) WHEN 1 THEN 'up' WHEN -1 THEN 'down' WHEN 0 THEN 'flat' END AS trend
FROM series WINDOW w AS (PARTITION BY series_key ORDER BY date)""")
def w9(spark, sf):
    return s.indicator_trend(st.series(spark, sf).drop("n_rows"))


@query("w10_gaps", with_(SERIES_ROWS) + """
SELECT series_key, date, CAST(date - lag(date) OVER (PARTITION BY series_key ORDER BY date) AS INTEGER) AS gap_days FROM series""")
def w10(spark, sf):
    return s.gaps(st.series(spark, sf), "series_key").select("series_key", "date", "gap_days")


@query("w11_volatility_regime", with_(PRICES, RETURNS, VOLATILITY, REGIMES) + "SELECT asset_id, date, regime FROM regimes")
def w11(spark, sf):
    return layers.price_history(st.prices(spark, sf)).select("asset_id", "date", "regime")


@query("w12_volume_confirmation", with_(PRICES, RETURNS) + f"""
, averaged AS (SELECT *, CASE WHEN count(volume_usd) OVER w = 30 THEN avg(volume_usd) OVER w END AS avg_volume
  FROM returns WINDOW w AS ({KEYED} ROWS 29 PRECEDING))
SELECT asset_id, date, {r6('avg_volume')} AS avg_volume,
  CASE WHEN volume_usd > avg_volume AND daily_return > 0 THEN 'up' WHEN volume_usd > avg_volume AND daily_return < 0 THEN 'down'
       WHEN avg_volume IS NOT NULL AND daily_return IS NOT NULL THEN 'unconfirmed' END AS confirmation
FROM averaged""")
def w12(spark, sf):
    out = s.volume_confirmation(st.returns(spark, sf), "asset_id")
    return rounded(out.select("asset_id", "date", "avg_volume", "confirmation"), "avg_volume")


@query("w13_trend_signal", with_(PRICES) + f"""
, averaged AS (SELECT *, CASE WHEN count(*) OVER f = 7 THEN avg(price_usd) OVER f END AS fast,
    CASE WHEN count(*) OVER s = 30 THEN avg(price_usd) OVER s END AS slow
  FROM prices WINDOW f AS ({KEYED} ROWS 6 PRECEDING), s AS ({KEYED} ROWS 29 PRECEDING)),
placed AS (SELECT *, CASE WHEN fast > slow THEN 'above' WHEN fast <= slow THEN 'below' END AS position FROM averaged)
SELECT asset_id, date, position,
  CASE WHEN position = 'above' AND lag(position) OVER ({KEYED}) = 'below' THEN 'buy'
       WHEN position = 'below' AND lag(position) OVER ({KEYED}) = 'above' THEN 'sell' END AS signal
FROM placed""")
def w13(spark, sf):
    return s.trend_signal(st.prices(spark, sf), "asset_id").select("asset_id", "date", "position", "signal")


# Joins -------------------------------------------------------------------------

@query("j1_fact_prices", with_(PRICES, RETURNS, SERIES_ROWS, WIDE, FACTS)
       + f"SELECT asset_id, date, price_usd, volume_usd, daily_return, {', '.join(INDICATORS)} FROM facts")
def j1(spark, sf):
    wide = layers.economic_wide(st.series(spark, sf), INDICATORS, st.last_day(spark, sf))
    facts = joins.fact_prices(st.returns(spark, sf), wide)
    return facts.select("asset_id", "date", "price_usd", "volume_usd", "daily_return", *INDICATORS)


@query("j2_densify", with_(SERIES_ROWS, _DENSE) + "SELECT series_key, date, numeric_value FROM dense")
def j2(spark, sf):
    return joins.densify(st.series(spark, sf).select("series_key", "date", "numeric_value"), "series_key")


@query("j3_dim_economic", with_(st.OPEN_SERIES, CATALOG) + """
SELECT series_key, series_id, category, date, numeric_value, numeric_value - lag(numeric_value) OVER w AS change,
  CASE sign(numeric_value - lag(numeric_value) OVER w) WHEN 1 THEN 'up' WHEN -1 THEN 'down' WHEN 0 THEN 'flat' END AS trend
FROM open_series LEFT JOIN catalog USING (series_key) WINDOW w AS (PARTITION BY series_key ORDER BY date)""")
def j3(spark, sf):
    return joins.dim_economic(st.open_series(spark, sf), series_catalog(spark))


_FEE_DAYS = f"""fee_days AS (
  SELECT CAST(snapshot_ts AS DATE) AS date, target AS fee_target, {r6('avg(fee_rate)')} AS fee_avg FROM fees GROUP BY 1, 2)"""


def _moved_blocks(spark, sf):
    return st.blocks(spark, sf).withColumn("block_ts", F.date_add(F.to_date("block_ts"), st.days_to_events(spark, sf)))


@query("j4_fact_network", with_(BLOCKS, FEES, _FEE_DAYS, st.MOVED_DAYS) + """
, mempool AS (SELECT CAST(ts AS DATE) AS date, count(*) AS mempool_count FROM events GROUP BY 1)
SELECT date, tx_count, size, difficulty, fee_target, fee_avg, mempool_count
FROM network_days LEFT JOIN fee_days USING (date) LEFT JOIN mempool USING (date)""")
def j4(spark, sf):
    days = network.daily_blocks(_moved_blocks(spark, sf)).select("date", "tx_count", "size", "difficulty")
    fees = rounded(network.fee_history(st.fees(spark, sf)), "fee_avg").select(
        F.to_date("period").alias("date"), F.col("target").alias("fee_target"), "fee_avg"
    )
    pool = table(spark, sf, "events").groupBy(F.to_date("ts").alias("date")).agg(F.count(F.lit(1)).alias("mempool_count"))
    return joins.fact_network(days, fees, pool)


@query("j5_asof_join", """
WITH quotes AS (SELECT user_id, ts, event_id AS quote_id, value AS quote FROM events WHERE event_type = 'view'),
trades AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'purchase')
SELECT t.user_id, t.ts, t.event_id, q.quote_id, q.quote
FROM trades t ASOF LEFT JOIN quotes q ON t.user_id = q.user_id AND t.ts >= q.ts""")
def j5(spark, sf):
    events = table(spark, sf, "events")
    trades = events.filter(F.col("event_type") == "purchase").select("user_id", "ts", "event_id")
    quotes = events.filter(F.col("event_type") == "view").select(
        "user_id", "ts", F.col("event_id").alias("quote_id"), F.col("value").alias("quote")
    )
    return joins.asof_join(trades, quotes, "user_id", "ts", ["quote_id", "quote"])


@query("j5_asof_join_hot", """
WITH quotes AS (SELECT ts, event_id AS quote_id FROM events WHERE event_type = 'view'),
trades AS (SELECT ts, event_id FROM events WHERE event_type <> 'view')
SELECT 'all' AS market, t.ts, t.event_id, q.quote_id FROM trades t ASOF LEFT JOIN quotes q ON t.ts >= q.ts""")
def j5_hot(spark, sf):
    """One key with all rows, dealt over 16 pieces by its times."""
    events = table(spark, sf, "events").withColumn("market", F.lit("all"))
    trades = events.filter(F.col("event_type") != "view").select("market", "ts", "event_id")
    quotes = events.filter(F.col("event_type") == "view").select("market", "ts", F.col("event_id").alias("quote_id"))
    return joins.asof_join(trades, quotes, "market", "ts", ["quote_id"], pieces=16)


@query("j6_orphans", """
SELECT o_orderkey, o_custkey FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_acctbal >= 0)""")
def j6(spark, sf):
    solvent = table(spark, sf, "customer").filter(F.col("c_acctbal") >= 0)
    return joins.orphans(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), solvent, "o_custkey", "c_custkey")


@query("j7_missing_dates", with_(SERIES_ROWS) + """
, keys AS (SELECT DISTINCT series_key FROM series),
calendar AS (SELECT series_key, CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS date FROM keys)
SELECT series_key, date FROM calendar c
WHERE NOT EXISTS (SELECT 1 FROM series s WHERE s.series_key = c.series_key AND s.date = c.date)""")
def j7(spark, sf):
    return joins.missing_dates(st.series(spark, sf), "series_key", "1995-01-01", "2001-12-31")


@query("j8_network_stats", with_(BLOCKS, FEES) + """
SELECT (SELECT arg_max(event_id, ts) FROM events) AS mempool_id, (SELECT arg_max(fee_rate, snapshot_ts) FROM fees) AS fee_rate,
  (SELECT max(height) FROM blocks WHERE block_ts = (SELECT max(block_ts) FROM blocks)) AS height""")
def j8(spark, sf):
    tips = st.blocks(spark, sf).groupBy("block_ts").agg(F.max("height").alias("height"))
    state = joins.network_stats({
        "mempool": (table(spark, sf, "events").select("event_id", "ts"), "ts"),
        "fees": (st.fees(spark, sf), "snapshot_ts"),
        "tip": (tips, "block_ts"),
    })
    return state.select(
        F.col("mempool.event_id").alias("mempool_id"), F.col("fees.fee_rate").alias("fee_rate"), F.col("tip.height").alias("height")
    )


@query("j9_align", with_(SERIES_ROWS) + """
SELECT a.date, a.numeric_value AS fed_funds, b.numeric_value AS sp500
FROM series a JOIN series b USING (date) WHERE a.series_key = 'federal_funds_rate' AND b.series_key = 'sp500_index'""")
def j9(spark, sf):
    points = st.series(spark, sf)

    def one(key: str, name: str):
        return points.filter(F.col("series_key") == key).select("date", F.col("numeric_value").alias(name))

    return joins.align(one("federal_funds_rate", "fed_funds"), one("sp500_index", "sp500"))


@query("j10_lag_align", with_(PRICES) + """
, bounds AS (SELECT asset_id, min(date) AS lo, max(date) AS hi FROM prices GROUP BY 1),
days AS (SELECT asset_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM bounds)
SELECT asset_id, date, lag(volume_usd, 5) OVER (PARTITION BY asset_id ORDER BY date) AS volume_usd_lag5, price_usd
FROM days LEFT JOIN prices USING (asset_id, date)""")
def j10(spark, sf):
    daily = joins.densify(st.prices(spark, sf), "asset_id")
    return joins.lag_align(daily, "volume_usd", "price_usd", 5, "asset_id")


# Bucketed tables ---------------------------------------------------------------------

def _bucketed(spark, df, label, key, *order):
    path = scratch_dir(spark, label)
    return write_bucketed(df, path.rsplit("/", 1)[1].replace("-", "_"), key, order, buckets=8, path=path)


@query("k3_bucketed_history", with_(PRICES, RETURNS, VOLATILITY, REGIMES) + f"""
SELECT asset_id, date, daily_return, {r6('volatility')} AS volatility, regime FROM regimes""")
def k3_bucketed(spark, sf):
    """Windows by key over a table that is bucketed by it: no exchange."""
    bars = _bucketed(spark, st.prices(spark, sf), "bucketed-prices", "asset_id", "date")
    return rounded(layers.price_history(bars).select("asset_id", "date", "daily_return", "volatility", "regime"), "volatility")


@query("k3_bucketed_join", """
SELECT o_orderkey, o_custkey, count(l_orderkey) AS n_lines, max(l_shipdate) AS last_shipped
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2""")
def k3_bucketed_join(spark, sf):
    """Two tables bucketed by the order: joined and aggregated in place."""
    orders = _bucketed(spark, table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "bucketed-orders", "o_orderkey")
    lines = _bucketed(spark, table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate"), "bucketed-lines", "o_orderkey")
    last = lines.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n_lines"), F.max("l_shipdate").alias("last_shipped"))
    return orders.join(last.hint("merge"), "o_orderkey", "left").withColumn("n_lines", F.coalesce("n_lines", F.lit(0).cast("bigint")))
