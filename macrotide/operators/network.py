"""Network statistics: blocks, fees, mempool."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macrotide.operators.common import Names, as_list

# Mempool congestion levels by transaction count: the lower bound of each level.
CONGESTION = {"low": 0, "medium": 20_000, "high": 80_000}


def daily_blocks(df: DataFrame, ts: str = "block_ts") -> DataFrame:
    """Per day: blocks, transactions, total and mean size, peak difficulty."""
    return df.groupBy(F.to_date(ts).alias("date")).agg(
        F.count(F.lit(1)).alias("n_blocks"), F.sum("tx_count").alias("tx_count"), F.sum("size").alias("size"),
        F.avg("size").alias("avg_size"), F.max("difficulty").alias("difficulty"),
    )


def fee_history(df: DataFrame, grain: str = "day", ts: str = "snapshot_ts", target: str = "target", fee: str = "fee_rate") -> DataFrame:
    """Fee range and mean per confirmation target and period."""
    period = F.date_trunc(grain, F.col(ts)).cast("timestamp_ntz").alias("period")
    return df.groupBy(period, target).agg(
        F.min(fee).alias("fee_min"), F.avg(fee).alias("fee_avg"), F.max(fee).alias("fee_max"), F.count(fee).alias("n")
    )


def congestion_level(df: DataFrame, thresholds: Mapping[str, float] = CONGESTION, load: str = "count", into: str = "level") -> DataFrame:
    """Level of each snapshot: the highest threshold that the load reaches."""
    label = F.lit(None).cast("string")
    for name, bound in sorted(thresholds.items(), key=lambda item: item[1]):
        label = F.when(F.col(load) >= F.lit(bound), name).otherwise(label)
    return df.withColumn(into, label)


def congestion(
    df: DataFrame, thresholds: Mapping[str, float] = CONGESTION, ts: str = "snapshot_ts", load: str = "count", width: str = "1 hour"
) -> DataFrame:
    """Snapshots per level, with mean and peak load, for each tumbling window."""
    levelled = congestion_level(df, thresholds, load)
    counts = [F.count_if(F.col("level") == name).alias(f"n_{name}") for name in thresholds]
    windowed = levelled.groupBy(F.window(ts, width).alias("_w")).agg(
        F.count(F.lit(1)).alias("n_snapshots"), F.avg(load).alias("load_avg"), F.max(load).alias("load_max"), *counts
    )
    hourly = congestion_level(windowed, thresholds, "load_avg")
    return hourly.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *hourly.columns[1:])


def latest_block(df: DataFrame, by: Names = (), tie: Names = ("block_ts", "id")) -> DataFrame:
    """The block of greatest height; of two blocks of one height (a reorganisation) the one
    with the larger ``tie`` columns, as far as ``df`` has them."""
    by = as_list(by)
    rest = [c for c in df.columns if c not in by]
    rank = F.struct("height", *[c for c in as_list(tie) if c in df.columns])
    return df.groupBy(*by).agg(F.max_by(F.struct(*rest), rank).alias("_b")).select(*by, "_b.*")
