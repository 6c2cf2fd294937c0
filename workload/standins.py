"""Prices, series and network records taken from the test tables.

Asset = order status, series = order priority, price = the day's last order total,
snapshots = events. The SQL forms are common table expressions of the same names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from macrotide.operators.joins import fact_prices
from macrotide.operators.series import daily_bars, daily_return
from macrotide.plans.layers import economic_wide
from macrotide.sources.tables import SERIES
from workload.registry import r6, rounded, table

# Which series each order priority stands for.
SERIES_OF = {
    "1-URGENT": "federal_funds_rate",
    "2-HIGH": "treasury_10y",
    "3-MEDIUM": "sofr_rate",
    "4-NOT SPECIFIED": "sp500_index",
    "5-LOW": "unemployment_rate",
}
INDICATORS = list(SERIES_OF.values())
# Two of them under names outside the catalogue.
UNKNOWN = {"sofr_rate": "coal_price", "unemployment_rate": "o'neil_index"}
# Which confirmation target each event type stands for.
TARGET_OF = {"view": 1, "click": 2, "signup": 3, "purchase": 6, "error": 144}


def whole_cents(col: str) -> F.Column:
    """Amounts as whole numbers, for the columns that hold such."""
    return F.floor(F.col(col) * 100 + 0.5)


def lookup(col: str, mapping: dict) -> F.Column:
    return F.expr(_case(col, mapping))


def _orders(spark: SparkSession, sf_dir: str, key: F.Column, name: str) -> DataFrame:
    """Order dates carry no time of day, so the order key decides which order is last."""
    return table(spark, sf_dir, "orders").select(key.alias(name), F.to_date("o_orderdate").alias("day"), "o_totalprice", "o_orderkey")


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums are rounded here and in the SQL alike, as their last digits depend on row order."""
    bars = daily_bars(_orders(spark, sf_dir, F.col("o_orderstatus"), "asset_id"), "asset_id", "day", "o_totalprice", "o_orderkey")
    return rounded(bars, "volume_usd")


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir, lookup("o_orderpriority", SERIES_OF), "series_key")
    bars = daily_bars(orders, "series_key", "day", "o_totalprice", "o_orderkey", price="numeric_value")
    return bars.select("series_key", "date", "numeric_value", "n_rows")


def open_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The series, with two keys that no catalogue holds."""
    return series(spark, sf_dir).select(
        F.coalesce(F.create_map(*[F.lit(x) for pair in UNKNOWN.items() for x in pair])[F.col("series_key")], "series_key").alias("series_key"),
        "date", "numeric_value",
    )


def returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_return(prices(spark, sf_dir), "asset_id")


def last_day(spark: SparkSession, sf_dir: str) -> F.Column:
    """Last order date, straight from its column: cheaper than from the daily bars."""
    return table(spark, sf_dir, "orders").agg(F.to_date(F.max("o_orderdate")).alias("_last")).scalar()


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = economic_wide(series(spark, sf_dir), INDICATORS, last_day(spark, sf_dir))
    return fact_prices(returns(spark, sf_dir), wide)


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as blocks: key = height, total in cents = size, customer = transactions."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderkey").alias("height"),
        F.col("o_orderdate").alias("block_ts"), F.col("o_custkey").alias("tx_count"),
        whole_cents("o_totalprice").alias("size"), F.col("o_totalprice").alias("difficulty"),
    )


def days_to_events(spark: SparkSession, sf_dir: str) -> F.Column:
    """Orders end years before the events begin: the days that take their last day to the last
    day of the events."""
    last_event = table(spark, sf_dir, "events").agg(F.to_date(F.max("ts")).alias("_a")).scalar()
    last_block = table(spark, sf_dir, "orders").agg(F.to_date(F.max("o_orderdate")).alias("_b")).scalar()
    return F.datediff(last_event, last_block)


def fees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").alias("snapshot_ts"), lookup("event_type", TARGET_OF).alias("target"),
        F.col("value").alias("fee_rate"),
    )


def _case(col: str, mapping: dict) -> str:
    def quoted(v: object) -> str:
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)

    return f"CASE {col} " + " ".join(f"WHEN {quoted(a)} THEN {quoted(b)}" for a, b in mapping.items()) + " END"


CENTS = "CAST(floor({0} * 1e2 + 5e-1) AS BIGINT)"
TOTAL_CENTS = CENTS.format("o_totalprice")

PRICES = f"""prices AS (
  SELECT o_orderstatus AS asset_id, CAST(o_orderdate AS DATE) AS date,
         last(o_totalprice ORDER BY o_orderdate, o_orderkey) AS price_usd,
         {r6('sum(o_totalprice)')} AS volume_usd, count(*) AS n_rows
  FROM orders GROUP BY 1, 2)"""

SERIES_ROWS = f"""series AS (
  SELECT {_case('o_orderpriority', SERIES_OF)} AS series_key, CAST(o_orderdate AS DATE) AS date,
         last(o_totalprice ORDER BY o_orderdate, o_orderkey) AS numeric_value, count(*) AS n_rows
  FROM orders GROUP BY 1, 2)"""

OPEN_SERIES = SERIES_ROWS + f""",
open_series AS (SELECT {_case('series_key', UNKNOWN).replace(' END', ' ELSE series_key END')} AS series_key, date, numeric_value FROM series)"""

CATALOG = "catalog(series_key, series_id, category) AS (VALUES " + ", ".join(map(str, SERIES)) + ")"

RETURNS = """returns AS (
  SELECT *, CASE WHEN lag(price_usd) OVER w > 0 THEN price_usd / lag(price_usd) OVER w - 1 END AS daily_return
  FROM prices WINDOW w AS (PARTITION BY asset_id ORDER BY date))"""

PEAKED = """peaked AS (
  SELECT *, max(price_usd) OVER w AS peak, price_usd / NULLIF(max(price_usd) OVER w, 0) - 1 AS drawdown
  FROM prices WINDOW w AS (PARTITION BY asset_id ORDER BY date ROWS UNBOUNDED PRECEDING))"""

VOLATILITY = """volatile AS (
  SELECT *, CASE WHEN count(daily_return) OVER w = 30 THEN stddev_samp(daily_return) OVER w END AS volatility
  FROM returns WINDOW w AS (PARTITION BY asset_id ORDER BY date ROWS 29 PRECEDING))"""

REGIMES = """cuts AS (
  SELECT asset_id, quantile_cont(volatility, 0.33) AS lo, quantile_cont(volatility, 0.67) AS hi
  FROM volatile GROUP BY asset_id),
regimes AS (
  SELECT v.*, CASE WHEN volatility <= lo THEN 'low' WHEN volatility <= hi THEN 'normal'
                   WHEN volatility IS NOT NULL THEN 'high' END AS regime
  FROM volatile v JOIN cuts USING (asset_id))"""

WIDE_FILLS = ", ".join(
    f"last_value({k} IGNORE NULLS) OVER (ORDER BY date ROWS UNBOUNDED PRECEDING) AS {k}" for k in INDICATORS
)
WIDE_PIVOTS = ", ".join(f"max(CASE WHEN series_key = '{k}' THEN numeric_value END) AS {k}" for k in INDICATORS)
WIDE = f"""calendar AS (
  SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM series),
pivoted AS (SELECT date, {WIDE_PIVOTS} FROM series GROUP BY date),
wide AS (SELECT date, {WIDE_FILLS} FROM calendar LEFT JOIN pivoted USING (date))"""

FACTS = "facts AS (SELECT r.*, " + ", ".join(f"w.{k}" for k in INDICATORS) + " FROM returns r LEFT JOIN wide w USING (date))"

BLOCKS = f"""blocks AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderkey AS height, o_orderdate AS block_ts, o_custkey AS tx_count,
         {TOTAL_CENTS} AS size, o_totalprice AS difficulty FROM orders)"""

MOVED_DAYS = """span AS (SELECT (SELECT max(CAST(ts AS DATE)) FROM events) - (SELECT max(CAST(block_ts AS DATE)) FROM blocks) AS days),
network_days AS (SELECT CAST(block_ts AS DATE) + CAST(days AS INTEGER) AS date, count(*) AS n_blocks, CAST(sum(tx_count) AS BIGINT) AS tx_count,
    CAST(sum(size) AS BIGINT) AS size, max(difficulty) AS difficulty FROM blocks, span GROUP BY 1)"""

FEES = f"""fees AS (
  SELECT event_id, ts AS snapshot_ts, {_case('event_type', TARGET_OF)} AS target, value AS fee_rate FROM events)"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def corr_sql(x: str, y: str) -> str:
    return f"CASE WHEN isnan(corr({x}, {y})) THEN NULL ELSE corr({x}, {y}) END"
