"""Typed tables and the series catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The economic series that are collected, by category.
CATEGORIES = {
    "interest_rates": "Interest Rates",
    "sofr": "SOFR",
    "sp500": "S&P 500",
    "jobless_claims": "Jobless Claims",
}
SERIES = [
    ("federal_funds_rate", "FEDFUNDS", "interest_rates"),
    ("treasury_10y", "GS10", "interest_rates"),
    ("treasury_2y", "GS2", "interest_rates"),
    ("treasury_3m", "GS3M", "interest_rates"),
    ("prime_rate", "DPRIME", "interest_rates"),
    ("sofr_rate", "SOFR", "sofr"),
    ("sofr_30d_avg", "SOFR30DAYAVG", "sofr"),
    ("sofr_90d_avg", "SOFR90DAYAVG", "sofr"),
    ("sofr_180d_avg", "SOFR180DAYAVG", "sofr"),
    ("sofr_index", "SOFRINDEX", "sofr"),
    ("sp500_index", "SP500", "sp500"),
    ("initial_claims", "ICSA", "jobless_claims"),
    ("continued_claims", "CCSA", "jobless_claims"),
    ("initial_claims_4w_avg", "ICSA4W", "jobless_claims"),
    ("unemployment_rate", "UNRATE", "jobless_claims"),
]
SERIES_KEYS = [key for key, _, _ in SERIES]


def series_catalog(spark: SparkSession) -> DataFrame:
    """Name, id and category of every collected series. Built from SQL values, whose
    exact size the optimizer knows, so joins with it broadcast without a hint."""
    rows = ", ".join(f"('{key}', '{sid}', '{category}', '{CATEGORIES[category]}')" for key, sid, category in SERIES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(series_key, series_id, category, category_label)")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A silver or gold table."""
    return spark.read.parquet(path)
