"""Data-quality checks: each gives the failing rows; ``verdict`` sums them up."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macrotide.functions import safe_div, seconds_between
from macrotide.operators.common import Names, as_list
from macrotide.operators.joins import orphans


def check_unique(df: DataFrame, keys: Names) -> DataFrame:
    """Keys held by more than one row, with the number of rows."""
    return df.groupBy(*as_list(keys)).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def check_fk(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    return orphans(child, parent, fk, pk)


def check_not_null(df: DataFrame, cols: Names) -> DataFrame:
    return df.filter(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in as_list(cols)]))


def check_range(df: DataFrame, col: str, lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Rows outside [lo, hi]; nulls are left to ``check_not_null``."""
    outside = F.lit(False)
    if lo is not None:
        outside = outside | (F.col(col) < F.lit(lo))
    if hi is not None:
        outside = outside | (F.col(col) > F.lit(hi))
    return df.filter(outside)


def check_accepted(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return df.filter(~F.col(col).isin(*values))


def check_freshness(df: DataFrame, key: Names, ts: str, asof: datetime | str, max_age_hours: int) -> DataFrame:
    """Newest row of each key, its age at ``asof`` in whole hours, and whether it is too old,
    judged to the second."""
    asof = F.lit(str(asof)).cast("timestamp_ntz")
    newest = df.groupBy(*as_list(key)).agg(F.max(ts).cast("timestamp_ntz").alias("newest"))
    seconds = seconds_between("newest", asof)
    return newest.withColumns(
        {"age_hours": F.floor(seconds / 3600).cast("bigint"), "is_stale": seconds > max_age_hours * 3600}
    )


def check_outliers(df: DataFrame, key: Names, col: str, k: float = 4.0) -> DataFrame:
    """Rows more than ``k`` deviations from their key's mean, with the ``z`` score.

    Rows with a null key are a group like any other. The statistics are one row per key;
    adaptive execution joins them by broadcast once it has measured that they are small.
    """
    keys = as_list(key)
    named = [F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]
    stats = df.groupBy(*named).agg(F.avg(col).alias("_mean"), F.stddev_samp(col).alias("_sd"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)])
    scored = df.join(stats, same).withColumn("z", safe_div(F.col(col) - F.col("_mean"), "_sd"))
    return scored.filter(F.abs("z") > k).select(*df.columns, "z")


def completeness(df: DataFrame, key: Names, order: str = "date", cols: Names = ()) -> DataFrame:
    """Observed over expected days of each key and the non-null share of each column.
    Rows are reduced to (key, day) first, so repeated days count once."""
    keys, cols = as_list(key), as_list(cols)
    days = df.groupBy(*keys, F.to_date(order).alias("_day")).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(f"_n_{c}") for c in cols]
    )
    summed = days.groupBy(*keys).agg(
        F.count("_day").alias("observed_days"),
        (F.datediff(F.max("_day"), F.min("_day")) + 1).cast("bigint").alias("expected_days"),
        *[safe_div(F.sum(f"_n_{c}"), F.sum("_rows")).alias(f"{c}_share") for c in cols],
    )
    return summed.withColumn("day_share", safe_div("observed_days", "expected_days"))


def reconcile_counts(df: DataFrame, declared: str = "declared_count", actual: str = "actual_count") -> DataFrame:
    """Batches whose declared count is not the number of records they hold."""
    return df.filter(~F.col(declared).eqNullSafe(F.col(actual)))


def run_completeness(log: DataFrame, files: DataFrame) -> DataFrame:
    """Data types a run claims in its ledger but has no file for: (run, data_type).
    ``files`` has one row per landed file: collection_timestamp, data_type."""
    claimed = log.select("collection_timestamp", F.explode("data_types_collected").alias("data_type"))
    landed = files.select("collection_timestamp", "data_type")
    return claimed.join(landed, ["collection_timestamp", "data_type"], "left_anti")


def verdict(failing: DataFrame, check: str) -> DataFrame:
    """One row: the check, its number of failing rows, and whether it passed."""
    counted = failing.agg(F.count(F.lit(1)).alias("n_failing"))
    return counted.select(F.lit(check).alias("check"), "n_failing", (F.col("n_failing") == 0).alias("passed"))
