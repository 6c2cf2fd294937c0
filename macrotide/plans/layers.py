"""Silver and gold tables composed from the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from macrotide.operators.clean import filter_dates, latest_version, missing, negative, normalize_prices, quality_flags, typed_points, with_series_meta
from macrotide.operators.joins import densify, fact_network, fact_prices
from macrotide.operators.network import CONGESTION, congestion, daily_blocks, fee_history
from macrotide.operators.series import daily_return, forward_fill, rolling_volatility, volatility_regime
from macrotide.operators.stats import correlate_pairs, pivot_series
from macrotide.plans.gate import HasParent, Rule, Unique, write_checked
from macrotide.sources.bronze import Paths, read_price_batches, read_series_batches, read_with_rejects
from macrotide.sources.sinks import write_table
from macrotide.sources.tables import SERIES_KEYS, series_catalog


def price_rules() -> dict[str, Column]:
    return {
        "price_missing": missing("price_usd"),
        "price_negative": negative("price_usd"),
        "volume_missing": missing("volume_usd"),
        "date_missing": missing("date"),
    }


def series_rules() -> dict[str, Column]:
    return {"value_missing": missing("numeric_value"), "series_unknown": missing("series_id"), "date_missing": missing("date")}


def silver_prices(spark: SparkSession, path: Paths, lines: bool = False) -> DataFrame:
    """Landed price batches to one valid-or-flagged row per asset and day. Rows
    without a readable date are flagged and each of them stays."""
    return clean_prices(read_price_batches(spark, path, lines))


def clean_prices(records: DataFrame) -> DataFrame:
    typed = normalize_prices(records)
    return quality_flags(latest_version(typed, ["asset_id", "date"], "collection_timestamp", apart="date"), price_rules())


def silver_series(spark: SparkSession, path: Paths, lines: bool = False) -> DataFrame:
    """Landed series batches to one row per series and date, flagged where the value, the
    date or the series itself is unknown. Metadata is joined after the newest version is
    picked, so its text does not pass through the shuffle."""
    return clean_series(spark, read_series_batches(spark, path, lines))


def clean_series(spark: SparkSession, points: DataFrame) -> DataFrame:
    newest = latest_version(typed_points(points), ["series_key", "date"], "collection_timestamp", apart="date")
    return quality_flags(with_series_meta(newest, series_catalog(spark)), series_rules())


def silver_with_rejects(spark: SparkSession, kind: str, path: Paths, lines: bool = False) -> tuple[DataFrame, DataFrame]:
    """(silver rows, rejects) of ``prices`` or ``series``: every landed file is in one of them or in both."""
    rows, rejects = read_with_rejects(spark, kind, path, lines)
    return clean_prices(rows) if kind == "prices" else clean_series(spark, rows), rejects


def daily_fees(fees: DataFrame) -> DataFrame:
    """One row per day: the mean rate of each confirmation target, as a map, so that a day stays
    one row beside its blocks. A day has as many targets as the collector asks for."""
    days = fee_history(fees, "day")
    entry = F.struct(F.col("target"), F.col("fee_avg"))
    return days.where(F.col("target").isNotNull()).groupBy(F.to_date("period").alias("date")).agg(
        F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("fee_rates")
    )


def daily_mempool(mempool: DataFrame, thresholds: Mapping[str, float] = CONGESTION) -> DataFrame:
    """One row per day: snapshots, mean and peak load, and the level of the mean load."""
    days = congestion(mempool, thresholds, width="1 day")
    return days.select(
        F.to_date("window_start").alias("date"), "n_snapshots", F.col("load_avg").alias("mempool_avg"),
        F.col("load_max").alias("mempool_max"), F.col("level").alias("congestion"),
    )


def gold_network(blocks: DataFrame, fees: DataFrame, mempool: DataFrame, thresholds: Mapping[str, float] = CONGESTION) -> DataFrame:
    """``fact_network`` from the rows of landed files: one row for each day of the chain with its
    blocks, fee rates by target and mempool load. A block listed in several snapshots counts
    once, as its newest listing has it."""
    once = latest_version(blocks, "id", "snapshot_ts")
    return fact_network(daily_blocks(once), daily_fees(fees), daily_mempool(mempool, thresholds))


def refresh(
    table: DataFrame, path: str, start: str, end: str, order: str = "date", rules: Sequence[Rule | Unique | HasParent] = ()
) -> None:
    """Replace the days from ``start`` to ``end`` (both inclusive) of a gold table that is kept
    by day below ``path``, and no other day: a rerun of one day gives the same table. With ``rules``
    the days are replaced only if they keep all of them (``ChecksFailed`` otherwise)."""
    days = filter_dates(table, start, end, order).withColumn("day", F.col(order).cast("string"))
    if rules:
        write_checked(days, path, rules, "day")
    else:
        write_table(days, path, "day")


def economic_wide(series: DataFrame, keys: Sequence[str] = SERIES_KEYS, end: Column | str | None = None) -> DataFrame:
    """One row per calendar day with every series filled forward.

    The fill runs on the tall form, by series, before the pivot. Filling the wide table
    would need one window over all of its rows. Each series is carried to the common
    ``end``, by default the last date of all series as a scalar subquery.
    """
    points = series.filter(F.col("date").isNotNull()).select("series_key", "date", "numeric_value")
    if end is None:
        end = points.agg(F.max("date").alias("_last")).scalar()
    daily = densify(points, "series_key", end=end)
    filled = forward_fill(daily, "series_key", "numeric_value")
    return pivot_series(filled, keys)


def price_history(prices: DataFrame, key: str = "asset_id", window: int = 30) -> DataFrame:
    """Returns, rolling volatility and regime: one exchange and one sort for all three."""
    returned = daily_return(prices, key)
    return volatility_regime(rolling_volatility(returned, key, window), key)


def gold_prices(prices: DataFrame, series: DataFrame, keys: Sequence[str] = SERIES_KEYS, end: Column | str | None = None) -> DataFrame:
    """``fact_prices``: price history with the day's economic context."""
    return fact_prices(price_history(prices), economic_wide(series, keys, end))


def indicator_report(prices: DataFrame, series: DataFrame, keys: Sequence[str], key: str = "asset_id", end: Column | str | None = None) -> DataFrame:
    """How does each asset's price move with each indicator: r, r2 and sample size."""
    facts = gold_prices(prices, series, keys, end)
    return correlate_pairs(facts, [("price_usd", k) for k in keys], by=key).withColumnRenamed("y", "indicator").drop("x")
