"""Registration of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from macrotide.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


@cache
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Its files are listed and its schema read once per session."""
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


def r6(expression: str) -> str:
    """SQL rounding; adding zero turns a negative zero into zero."""
    return f"(round({expression}, 6) + 0e0)"
