"""Window operators over one series per key.

All of them expect day grain: one row per key and date, as ``daily_bars`` yields. A
key then holds at most one row per calendar day however many raw rows it had, so its
window always fits a task. Operators of one key and order share an exchange and a
sort when they are chained.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from macrotide.functions import recency, safe_div
from macrotide.operators.common import Names, as_list, by_key, running, trailing
from macrotide.operators.prefix import Running, prefix_scan


def daily_bars(
    df: DataFrame, key: Names, ts: str, value: str, tie: str | None = None, *,
    price: str = "price_usd", volume: str = "volume_usd", count: str = "n_rows",
) -> DataFrame:
    """Raw rows to one row per key and day: last value, sum and count
    of the rows that have a value; a day without any has no row.

    The partial aggregate leaves one row per key, day and task, so a key with a third
    of all rows is spread over every scan task before anything is shuffled.
    """
    return (
        df.filter(F.col(value).isNotNull())
        .groupBy(*as_list(key), F.to_date(ts).alias("date"))
        .agg(
            F.max_by(value, recency(df, ts, tie)).alias(price),
            F.sum(value).alias(volume),
            F.count(F.lit(1)).alias(count),
        )
    )


def previous(col: str, key: Names, order: str, k: int = 1) -> Column:
    return F.lag(col, k).over(by_key(key, order))


def daily_return(df: DataFrame, key: Names, price: str = "price_usd", order: str = "date", into: str = "daily_return") -> DataFrame:
    """Return against the previous row (not the previous calendar day); null on the
    first row and where the previous price is not positive."""
    before = previous(price, key, order)
    return df.withColumn(into, F.when(before > 0, F.col(price) / before - 1))


def daily_change_pct(df: DataFrame, key: Names, price: str = "price_usd", order: str = "date", into: str = "change_pct") -> DataFrame:
    return daily_return(df, key, price, order, into).withColumn(into, F.col(into) * 100)


def forward_fill(df: DataFrame, key: Names, cols: Names, order: str = "date") -> DataFrame:
    """Last non-null value at or before each row."""
    frame = running(key, order)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(frame) for c in as_list(cols)})


def forward_fill_blocks(df: DataFrame, key: Names | None, cols: Names, order: str = "date", pieces: int | None = None) -> DataFrame:
    """``forward_fill`` for a series too long for one task or for a table without any key: a
    prefix scan, so that every task has the same share of the rows."""
    return prefix_scan(df, key, order, {c: Running("last", c) for c in as_list(cols)}, pieces)


def rolling_volatility(df: DataFrame, key: Names, n: int = 30, returns: str = "daily_return", order: str = "date", into: str = "volatility") -> DataFrame:
    """Sample deviation of the last ``n`` returns; null until the frame holds ``n``."""
    frame = trailing(key, order, n)
    full = F.count(returns).over(frame) == n
    return df.withColumn(into, F.when(full, F.stddev_samp(returns).over(frame)))


def moving_averages(df: DataFrame, key: Names, spans: Sequence[int] = (7, 30, 90), price: str = "price_usd", order: str = "date") -> DataFrame:
    """``ma_<span>`` columns over the last rows; null until the frame is full."""
    columns = {}
    for span in spans:
        frame = trailing(key, order, span)
        columns[f"ma_{span}"] = F.when(F.count(price).over(frame) == span, F.avg(price).over(frame))
    return df.withColumns(columns)


def momentum(df: DataFrame, key: Names, k: int = 10, price: str = "price_usd", order: str = "date", into: str = "momentum") -> DataFrame:
    """Relative change against the ``k``-th row before."""
    return df.withColumn(into, safe_div(price, previous(price, key, order, k)) - 1)


def drawdown(df: DataFrame, key: Names, price: str = "price_usd", order: str = "date") -> DataFrame:
    """Running ``peak`` and ``drawdown`` below it (zero or negative)."""
    peaked = df.withColumn("peak", F.max(price).over(running(key, order)))
    return peaked.withColumn("drawdown", safe_div(price, "peak") - 1)


def drawdown_blocks(df: DataFrame, key: Names | None, price: str = "price_usd", order: str = "date", pieces: int | None = None) -> DataFrame:
    """``drawdown`` of a series of any length, as ``forward_fill_blocks``."""
    peaked = prefix_scan(df, key, order, {"peak": Running("max", price)}, pieces)
    return peaked.withColumn("drawdown", safe_div(price, "peak") - 1)


def indicator_trend(df: DataFrame, key: Names = "series_key", value: str = "numeric_value", order: str = "date") -> DataFrame:
    """``change`` against the previous point and its direction."""
    changed = df.withColumn("change", F.col(value) - previous(value, key, order))
    direction = (
        F.when(F.col("change") > 0, "up").when(F.col("change") < 0, "down").when(F.col("change") == 0, "flat")
    )
    return changed.withColumn("trend", direction)


def gaps(df: DataFrame, key: Names, order: str = "date", into: str = "gap_days") -> DataFrame:
    """Days since the previous row of the key; 1 means no gap."""
    return df.withColumn(into, F.datediff(order, previous(order, key, order)))


def volatility_regime(df: DataFrame, key: Names, lo: float = 0.33, hi: float = 0.67, volatility: str = "volatility", into: str = "regime") -> DataFrame:
    """``low``, ``normal`` or ``high`` by the key's own volatility percentiles. The cut
    points are a window over the key's days, so no join follows."""
    cuts = F.percentile(volatility, F.array(F.lit(lo), F.lit(hi))).over(by_key(key))
    label = (
        F.when(F.col(volatility) <= F.col("_cuts")[0], "low")
        .when(F.col(volatility) <= F.col("_cuts")[1], "normal")
        .when(F.col(volatility).isNotNull(), "high")
    )
    return df.withColumn("_cuts", cuts).withColumn(into, label).drop("_cuts")


def volume_confirmation(df: DataFrame, key: Names, n: int = 30, returns: str = "daily_return", volume: str = "volume_usd", order: str = "date") -> DataFrame:
    """Is the price move backed by volume above its ``n``-row average? Adds
    ``avg_volume`` (null until the frame is full) and ``confirmation``: ``up``, ``down``,
    ``unconfirmed`` or null where either side is unknown."""
    frame = trailing(key, order, n)
    averaged = df.withColumn(
        "avg_volume", F.when(F.count(volume).over(frame) == n, F.avg(volume).over(frame))
    )
    heavy = F.col(volume) > F.col("avg_volume")
    label = (
        F.when(heavy & (F.col(returns) > 0), "up")
        .when(heavy & (F.col(returns) < 0), "down")
        .when(heavy.isNotNull() & F.col(returns).isNotNull(), "unconfirmed")
    )
    return averaged.withColumn("confirmation", label)


def trend_signal(df: DataFrame, key: Names, fast: int = 7, slow: int = 30, price: str = "price_usd", order: str = "date") -> DataFrame:
    """Moving-average crossover: ``position`` is ``above`` or ``below`` (fast against
    slow), ``signal`` is ``buy`` or ``sell`` on the row where it flips."""
    averaged = moving_averages(df, key, (fast, slow), price, order)
    above = F.col(f"ma_{fast}") > F.col(f"ma_{slow}")
    placed = averaged.withColumn("position", F.when(above, "above").when(~above, "below"))
    before = previous("position", key, order)
    signal = (
        F.when((F.col("position") == "above") & (before == "below"), "buy")
        .when((F.col("position") == "below") & (before == "above"), "sell")
    )
    return placed.withColumn("signal", signal)
