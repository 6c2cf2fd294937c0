"""Statistics, network aggregates, ordered output (A, L)."""

from __future__ import annotations

from pyspark.sql import functions as F

from macrotide.operators import network, ordering, search, series as s, stats
from macrotide.plans import layers
from macrotide.session import scratch_dir
from macrotide.sources.tables import series_catalog
from workload import standins as st
from workload.registry import query, r6, rounded, table
from workload.standins import (
    BLOCKS, CATALOG, FACTS, FEES, INDICATORS, PEAKED, PRICES, REGIMES, RETURNS, SERIES_ROWS, VOLATILITY, WIDE,
    WIDE_PIVOTS, corr_sql, with_,
)

FACT_PARTS = with_(PRICES, RETURNS, SERIES_ROWS, WIDE, FACTS)


@query("a1_pivot_series", with_(SERIES_ROWS) + f"SELECT date, {WIDE_PIVOTS} FROM series GROUP BY date")
def a1(spark, sf):
    return stats.pivot_series(st.series(spark, sf), INDICATORS)


@query("a2_series_counts", with_(SERIES_ROWS, CATALOG) + """
, counted AS (SELECT category, series_key, count(*) AS n FROM series JOIN catalog USING (series_key) GROUP BY 1, 2)
SELECT 'series' AS level, category, series_key, CAST(n AS BIGINT) AS n_points, CAST(1 AS BIGINT) AS n_series FROM counted
UNION ALL SELECT 'category', category, NULL, CAST(sum(n) AS BIGINT), count(*) FROM counted GROUP BY category
UNION ALL SELECT 'all', NULL, NULL, CAST(sum(n) AS BIGINT), count(*) FROM counted""")
def a2(spark, sf):
    from macrotide.operators.clean import with_series_meta

    return stats.series_counts(with_series_meta(st.series(spark, sf), series_catalog(spark)))


@query("a3_series_bounds", with_(SERIES_ROWS) + """
SELECT series_key, min(date) AS first_date, arg_min(numeric_value, date) AS first_value,
  max(date) AS last_date, arg_max(numeric_value, date) AS last_value FROM series GROUP BY 1""")
def a3(spark, sf):
    return stats.series_bounds(st.series(spark, sf))


@query("a4_batch_bounds", """
SELECT o_orderstatus AS batch, CAST(min(o_orderdate) AS DATE) AS first_date, CAST(max(o_orderdate) AS DATE) AS last_date,
  count(*) AS record_count FROM orders GROUP BY 1""")
def a4(spark, sf):
    rows = table(spark, sf, "orders").select(F.col("o_orderstatus").alias("batch"), F.to_date("o_orderdate").alias("date"))
    return stats.batch_bounds(rows, "batch")


@query("a5_success_rate", """
SELECT user_id, count(*) AS attempts, count(*) FILTER (event_type <> 'error') AS successes,
  count(*) FILTER (event_type <> 'error') / CAST(count(*) AS DOUBLE) * 1e2 AS success_rate FROM events GROUP BY 1""")
def a5(spark, sf):
    runs = table(spark, sf, "events").withColumn("ok", F.col("event_type") != "error")
    return stats.success_rate(runs, by="user_id")


@query("a6_return_stats", with_(PRICES, RETURNS) + f"""
SELECT asset_id, count(daily_return) AS n, {r6('avg(daily_return)')} AS mean, {r6('stddev_samp(daily_return)')} AS stddev,
  min(daily_return) AS min, max(daily_return) AS max, {r6('quantile_cont(daily_return, 0.25)')} AS q25,
  {r6('quantile_cont(daily_return, 0.5)')} AS median, {r6('quantile_cont(daily_return, 0.75)')} AS q75
FROM returns GROUP BY 1""")
def a6(spark, sf):
    out = stats.return_stats(st.returns(spark, sf), "asset_id")
    return rounded(out, "mean", "stddev", "q25", "median", "q75")


@query("a7_sharpe", with_(PRICES, RETURNS) + f"""
SELECT asset_id, count(daily_return) AS n,
  {r6('(avg(daily_return) - 1e-3) / NULLIF(stddev_samp(daily_return), 0) * sqrt(365e0)')} AS sharpe FROM returns GROUP BY 1""")
def a7(spark, sf):
    return rounded(stats.sharpe(st.returns(spark, sf), "asset_id", rf=0.001, periods=365), "sharpe")


@query("a8_max_drawdown", with_(PRICES, PEAKED) + """
SELECT asset_id, min(drawdown) AS max_drawdown, first(date ORDER BY drawdown, date) AS trough_date FROM peaked GROUP BY 1""")
def a8(spark, sf):
    return stats.max_drawdown(st.prices(spark, sf), "asset_id")


@query("a9_histogram", with_(PRICES, RETURNS) + f"""
, counted AS (SELECT CAST(least(greatest(floor((daily_return + 1) / (3e0 / 30)) + 1, 0), 31) AS BIGINT) AS bin, count(*) AS n
  FROM returns WHERE daily_return IS NOT NULL GROUP BY 1)
SELECT b.bin, CASE WHEN b.bin > 0 THEN {r6('-1e0 + (b.bin - 1) * 1e-1')} END AS bin_from, coalesce(n, 0) AS n
FROM (SELECT unnest(range(32)) AS bin) b LEFT JOIN counted USING (bin)""")
def a9(spark, sf):
    return rounded(stats.histogram(st.returns(spark, sf), "daily_return", -1.0, 2.0, 30), "bin_from")


def _corr(x: str, y: str) -> str:
    return r6(corr_sql(x, y))


def _corr_row(x: str, y: str, name_x: str | None = None, name_y: str | None = None) -> str:
    r = corr_sql(x, y)
    return (
        f"'{name_x or x}' AS x, '{name_y or y}' AS y, {r6(r)} AS r, {r6(f'({r}) * ({r})')} AS r2, "
        f"count(*) FILTER ({x} IS NOT NULL AND {y} IS NOT NULL) AS n"
    )


@query("a10_correlate", FACT_PARTS + f"""
SELECT asset_id, {_corr('price_usd', 'sp500_index')} AS r, {r6('corr(price_usd, sp500_index) * corr(price_usd, sp500_index)')} AS r2,
  count(*) FILTER (price_usd IS NOT NULL AND sp500_index IS NOT NULL) AS n FROM facts GROUP BY 1""")
def a10(spark, sf):
    return rounded(stats.correlate(st.facts(spark, sf), "price_usd", "sp500_index", by="asset_id"), "r", "r2")


MATRIX = ["price_usd", *INDICATORS]


@query("a11_correlation_matrix", FACT_PARTS + " UNION ALL ".join(
    f"SELECT {_corr_row(x, y)} FROM facts" for x in MATRIX for y in MATRIX))
def a11(spark, sf):
    return rounded(stats.correlation_matrix(st.facts(spark, sf), MATRIX), "r", "r2")


_CHANGES = "changes AS (SELECT asset_id, " + ", ".join(
    f"CASE WHEN lag({c}) OVER w > 0 THEN {c} / lag({c}) OVER w - 1 END AS {c}" for c in MATRIX
) + " FROM facts WINDOW w AS (PARTITION BY asset_id ORDER BY date))"


@query("a11_correlation_matrix_returns", with_(PRICES, RETURNS, SERIES_ROWS, WIDE, FACTS, _CHANGES) + " UNION ALL ".join(
    f"SELECT {_corr_row(x, y)} FROM changes" for x in MATRIX for y in MATRIX))
def a11_returns(spark, sf):
    out = stats.correlation_matrix(st.facts(spark, sf), MATRIX, on="returns", key="asset_id")
    return rounded(out, "r", "r2")


@query("a12_r_squared", FACT_PARTS + " UNION ALL ".join(
    f"SELECT asset_id, {_corr_row('price_usd', k)} FROM facts GROUP BY 1" for k in INDICATORS))
def a12(spark, sf):
    pairs = [("price_usd", k) for k in INDICATORS]
    return rounded(stats.correlate_pairs(st.facts(spark, sf), pairs, by="asset_id"), "r", "r2")


@query("a13_correlation_by_regime", with_(PRICES, RETURNS, VOLATILITY, REGIMES, SERIES_ROWS, WIDE) + """
, facts AS (SELECT * FROM regimes LEFT JOIN wide USING (date)) """ + " UNION ALL ".join(
    f"SELECT regime, {_corr_row('price_usd', k)} FROM facts WHERE regime IS NOT NULL GROUP BY 1" for k in INDICATORS))
def a13(spark, sf):
    facts = layers.gold_prices(st.prices(spark, sf), st.series(spark, sf), INDICATORS, st.last_day(spark, sf))
    return rounded(stats.correlation_by_regime(facts, "regime", [("price_usd", k) for k in INDICATORS]), "r", "r2")


@query("a13_correlation_by_regime_and_asset", with_(PRICES, RETURNS, VOLATILITY, REGIMES, SERIES_ROWS, WIDE) + """
, facts AS (SELECT * FROM regimes LEFT JOIN wide USING (date)) """ + " UNION ALL ".join(
    f"SELECT asset_id, regime, {_corr_row('price_usd', k)} FROM facts WHERE regime IS NOT NULL GROUP BY 1, 2" for k in INDICATORS))
def a13_by_asset(spark, sf):
    facts = layers.gold_prices(st.prices(spark, sf), st.series(spark, sf), INDICATORS, st.last_day(spark, sf))
    return rounded(stats.correlation_by_regime(facts, "regime", [("price_usd", k) for k in INDICATORS], by="asset_id"), "r", "r2")


_LAGS = range(0, 11)


@query("a14_lagged_correlation", with_(PRICES) + """
, bounds AS (SELECT asset_id, min(date) AS lo, max(date) AS hi FROM prices GROUP BY 1),
days AS (SELECT asset_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM bounds),
shifted AS (SELECT price_usd, """ + ", ".join(f"lag(volume_usd, {k}) OVER w AS x{k}" for k in _LAGS) + """
  FROM days LEFT JOIN prices USING (asset_id, date) WINDOW w AS (PARTITION BY asset_id ORDER BY date)) """ + " UNION ALL ".join(
    f"SELECT {k} AS lag, {_corr(f'x{k}', 'price_usd')} AS r, {r6(f'corr(x{k}, price_usd) * corr(x{k}, price_usd)')} AS r2, "
    f"count(*) FILTER (x{k} IS NOT NULL AND price_usd IS NOT NULL) AS n FROM shifted" for k in _LAGS))
def a14(spark, sf):
    from macrotide.operators.joins import densify

    daily = densify(st.prices(spark, sf), "asset_id")
    return rounded(stats.lagged_correlation(daily, "volume_usd", "price_usd", _LAGS, "asset_id"), "r", "r2")


@query("a14_lagged_correlation_by_asset", with_(PRICES) + """
, bounds AS (SELECT asset_id, min(date) AS lo, max(date) AS hi FROM prices GROUP BY 1),
days AS (SELECT asset_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM bounds),
shifted AS (SELECT asset_id, price_usd, """ + ", ".join(f"lag(volume_usd, {k}) OVER w AS x{k}" for k in _LAGS) + """
  FROM days LEFT JOIN prices USING (asset_id, date) WINDOW w AS (PARTITION BY asset_id ORDER BY date)) """ + " UNION ALL ".join(
    f"SELECT asset_id, {k} AS lag, {_corr(f'x{k}', 'price_usd')} AS r, {r6(f'corr(x{k}, price_usd) * corr(x{k}, price_usd)')} AS r2, "
    f"count(*) FILTER (x{k} IS NOT NULL AND price_usd IS NOT NULL) AS n FROM shifted GROUP BY 1" for k in _LAGS))
def a14_by_asset(spark, sf):
    from macrotide.operators.joins import densify

    daily = densify(st.prices(spark, sf), "asset_id")
    return rounded(stats.lagged_correlation(daily, "volume_usd", "price_usd", _LAGS, "asset_id", by="asset_id"), "r", "r2")


@query("a15_price_volume_corr", with_(PRICES) + f"""
SELECT asset_id, {_corr('price_usd', 'volume_usd')} AS r, {r6('corr(price_usd, volume_usd) * corr(price_usd, volume_usd)')} AS r2,
  count(*) AS n FROM prices GROUP BY 1""")
def a15(spark, sf):
    return rounded(stats.price_volume_corr(st.prices(spark, sf), "asset_id"), "r", "r2")


@query("a16_regime_summary", with_(PRICES, RETURNS, VOLATILITY, REGIMES) + f"""
SELECT asset_id, regime, count(*) AS days, {r6('avg(daily_return)')} AS mean_return
FROM regimes WHERE regime IS NOT NULL GROUP BY 1, 2""")
def a16(spark, sf):
    return rounded(stats.regime_summary(layers.price_history(st.prices(spark, sf)), "asset_id"), "mean_return")


@query("a17_daily_blocks", with_(BLOCKS) + """
SELECT CAST(block_ts AS DATE) AS date, count(*) AS n_blocks, CAST(sum(tx_count) AS BIGINT) AS tx_count,
  CAST(sum(size) AS BIGINT) AS size, CAST(sum(size) AS DOUBLE) / count(*) AS avg_size, max(difficulty) AS difficulty
FROM blocks GROUP BY 1""")
def a17(spark, sf):
    return network.daily_blocks(st.blocks(spark, sf))


@query("a18_fee_history", with_(FEES) + f"""
SELECT date_trunc('hour', snapshot_ts) AS period, target, min(fee_rate / 7e0) AS fee_min, {r6('avg(fee_rate / 7e0)')} AS fee_avg,
  max(fee_rate / 7e0) AS fee_max, count(*) AS n FROM fees GROUP BY 1, 2""")
def a18(spark, sf):
    """Rates with many decimals: sevenths."""
    fees = st.fees(spark, sf).withColumn("fee_rate", F.col("fee_rate") / 7)
    return rounded(network.fee_history(fees, "hour"), "fee_avg")


_LEVEL = "CASE WHEN {0} >= 7 THEN 'high' WHEN {0} >= 3 THEN 'medium' WHEN {0} >= 0 THEN 'low' END"
CONGESTION = {"low": 0, "medium": 3, "high": 7}


@query("a19_congestion", f"""
WITH levelled AS (SELECT *, {_LEVEL.format('load')} AS level, time_bucket(INTERVAL 1 HOUR, ts) AS w FROM (SELECT ts, value / 7e0 AS load FROM events)),
hours AS (SELECT w AS window_start, w + INTERVAL 1 HOUR AS window_end, count(*) AS n_snapshots,
  {r6('avg(load)')} AS load_avg, max(load) AS load_max,
  count(*) FILTER (level = 'low') AS n_low, count(*) FILTER (level = 'medium') AS n_medium,
  count(*) FILTER (level = 'high') AS n_high FROM levelled GROUP BY w)
SELECT *, {_LEVEL.format('load_avg')} AS level FROM hours""")
def a19(spark, sf):
    loads = table(spark, sf, "events").select("ts", (F.col("value") / 7).alias("load"))
    return rounded(network.congestion(loads, CONGESTION, ts="ts", load="load"), "load_avg")


@query("a20_current_metrics", with_(PRICES, RETURNS) + """
SELECT asset_id, max(date) AS date, arg_max(price_usd, date) AS price_usd, arg_max(daily_return * 1e2, date) AS change_pct
FROM returns GROUP BY 1""")
def a20(spark, sf):
    return stats.current_metrics(st.prices(spark, sf), "asset_id")


@query("a21_daily_bars", with_(PRICES) + "SELECT asset_id, date, price_usd, volume_usd, n_rows FROM prices")
def a21(spark, sf):
    return st.prices(spark, sf)


@query("a21_daily_bars_by_supplier", """
SELECT l_suppkey, CAST(l_shipdate AS DATE) AS date, max(charge) AS price_usd, """ + r6("sum(charge)") + """ AS volume_usd, count(*) AS n_rows
FROM (SELECT *, l_extendedprice * l_discount / 7e0 AS charge FROM lineitem) GROUP BY 1, 2""")
def a21_by_supplier(spark, sf):
    """Many small keys, amounts with many decimals. Ship dates have no time of day, so of one
    day's rows the dearest counts as last."""
    lines = table(spark, sf, "lineitem").select(
        "l_suppkey", F.to_date("l_shipdate").alias("day"), (F.col("l_extendedprice") * F.col("l_discount") / 7).alias("charge")
    )
    return rounded(s.daily_bars(lines, "l_suppkey", "day", "charge", "charge"), "volume_usd")


@query("flagship_indicator_report", with_(PRICES, SERIES_ROWS, WIDE) + """
, facts AS (SELECT * FROM prices LEFT JOIN wide USING (date)) """ + " UNION ALL ".join(
    f"SELECT asset_id, '{k}' AS indicator, {_corr('price_usd', k)} AS r, "
    f"{r6(f'corr(price_usd, {k}) * corr(price_usd, {k})')} AS r2, "
    f"count(*) FILTER (price_usd IS NOT NULL AND {k} IS NOT NULL) AS n FROM facts GROUP BY 1" for k in INDICATORS))
def flagship(spark, sf):
    """How does each asset's price move with each indicator?"""
    return rounded(layers.indicator_report(st.prices(spark, sf), st.series(spark, sf), INDICATORS, end=st.last_day(spark, sf)), "r", "r2")


# Ordered output ------------------------------------------------------------------

@query("l1_sort_series", with_(PRICES) + "SELECT asset_id, date, price_usd FROM prices ORDER BY date DESC, asset_id DESC")
def l1(spark, sf):
    return ordering.sort_series(st.prices(spark, sf).select("asset_id", "date", "price_usd"), ["date", "asset_id"], "desc")


@query("l2_page", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100 OFFSET 50")
def l2(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return ordering.page(orders, "o_totalprice", 100, 50, "desc", tie="o_orderkey")


@query("l2_page_after", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100 OFFSET 5000")
def l2_after(spark, sf):
    """The page behind the 5,000th row, found from that row's values."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    last = ordering.page(orders, "o_totalprice", 1, 4999, "desc", tie="o_orderkey").first()
    if last is None:
        return orders.limit(0)
    return ordering.page_after(orders, "o_totalprice", last.o_totalprice, 100, "desc", "o_orderkey", last.o_orderkey)


@query("l3_latest_block", with_(BLOCKS) + "SELECT * FROM blocks WHERE height = (SELECT max(height) FROM blocks)")
def l3(spark, sf):
    return network.latest_block(st.blocks(spark, sf))


@query("l4_search_catalog", """
SELECT p_partkey, p_name, p_type, p_retailprice FROM part
WHERE contains(lower(p_name), 'widget') OR contains(lower(p_type), 'widget')
ORDER BY p_retailprice DESC, p_partkey""")
def l4(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    return ordering.search_catalog(parts, "Widget", ["p_name", "p_type"], "p_retailprice", tie="p_partkey")


@query("l4_ranked_search", """
WITH docs AS (SELECT p_partkey AS key, regexp_extract_all(lower(concat_ws(' ', p_name, p_type)), '[\\p{L}\\p{N}]+') AS w FROM part),
queries AS (SELECT DISTINCT c_mktsegment || ' ' || n_name || ' ' || p_type AS text, p_type AS query_id
  FROM part, (SELECT min(c_mktsegment) AS c_mktsegment FROM customer), (SELECT min(n_name) AS n_name FROM nation)),
totals AS (SELECT count(*) AS n_docs, sum(len(w)) AS n_terms FROM docs WHERE len(w) > 0),
f AS (SELECT key, length, term, count(*) AS tf FROM (SELECT key, len(w) AS length, unnest(w) AS term FROM docs) GROUP BY ALL),
weights AS (SELECT term, ln(1 + (n_docs - count(*) + 0.5e0) / (count(*) + 0.5e0)) AS weight FROM f, totals GROUP BY term, n_docs),
q AS (SELECT query_id, term, count(*) AS times FROM (SELECT query_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS term FROM queries) GROUP BY ALL),
s AS (SELECT query_id, key, round(sum(times * weight * tf * 2.2e0 / (tf + 1.2e0 * (0.25e0 + 0.75e0 * length * n_docs / n_terms))), 9) AS score
  FROM q JOIN weights USING (term) JOIN f USING (term), totals GROUP BY ALL)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, key, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, key) QUALIFY row_number() OVER w <= 5""")
def l4_ranked(spark, sf):
    """The five most relevant parts for each type of part, as one searches a catalogue by words."""
    index, parts = scratch_dir(spark, "search-index"), table(spark, sf, "part")
    search.write_index(parts.select("p_partkey", "p_name", "p_type"), "p_partkey", ["p_name", "p_type"], index)
    segment = table(spark, sf, "customer").agg(F.min("c_mktsegment").alias("_s")).scalar()
    nation = table(spark, sf, "nation").agg(F.min("n_name").alias("_n")).scalar()
    queries = parts.select(F.col("p_type").alias("query_id"), F.concat_ws(" ", segment, nation, "p_type").alias("text")).distinct()
    return search.ranked_search(spark, index, queries, 5)
