"""Aggregations: pivots, counts, risk and correlation statistics."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from macrotide.functions import percent, safe_corr, safe_div
from macrotide.operators.common import Names, as_list, by_key, quoted
from macrotide.operators.comoments import comoments
from macrotide.operators.series import daily_change_pct, drawdown

Pair = tuple[str, str]


def pivot_series(df: DataFrame, keys: Sequence[str], by: Names = "date", series: str = "series_key", value: str = "numeric_value") -> DataFrame:
    """Tall to wide, one column per series key. Conditional maxima need one exchange;
    ``pivot()`` would plan two."""
    wide = [F.max(F.when(F.col(series) == F.lit(k), F.col(value))).alias(k) for k in keys]
    return df.groupBy(*as_list(by)).agg(*wide)


def series_counts(df: DataFrame, category: str = "category", series: str = "series_key") -> DataFrame:
    """Points per series, with totals: ``level`` is ``series``, ``category`` or ``all``.
    The rollup runs on the per-series counts, so its row expansion never sees raw rows."""
    points = df.groupBy(category, series).agg(F.count(F.lit(1)).alias("_points"))
    totals = points.rollup(category, series).agg(
        F.sum("_points").alias("n_points"), F.count(F.lit(1)).alias("n_series"), F.grouping_id().alias("_level")
    )
    level = F.when(F.col("_level") == 0, "series").when(F.col("_level") == 1, "category").otherwise("all")
    return totals.select(level.alias("level"), category, series, "n_points", "n_series")


def series_bounds(df: DataFrame, key: Names = "series_key", value: str = "numeric_value", order: str = "date") -> DataFrame:
    """First and last point of each series."""
    return df.groupBy(*as_list(key)).agg(
        F.min(order).alias("first_date"), F.min_by(value, order).alias("first_value"),
        F.max(order).alias("last_date"), F.max_by(value, order).alias("last_value"),
    )


def batch_bounds(df: DataFrame, batch: Names, order: str = "date") -> DataFrame:
    return df.groupBy(*as_list(batch)).agg(
        F.min(order).alias("first_date"), F.max(order).alias("last_date"), F.count(F.lit(1)).alias("record_count")
    )


def success_rate(df: DataFrame, ok: str = "ok", by: Names = ()) -> DataFrame:
    """Attempts, successes and their share in percent; null when nothing was tried."""
    good = F.count_if(F.coalesce(F.col(ok), F.lit(False)))
    counted = df.groupBy(*as_list(by)).agg(F.count(F.lit(1)).alias("attempts"), good.alias("successes"))
    return counted.withColumn("success_rate", percent("successes", "attempts"))


def return_stats(df: DataFrame, key: Names, returns: str = "daily_return") -> DataFrame:
    """Count, mean, deviation, extremes and quartiles of day-grain returns."""
    quartiles = F.percentile(returns, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    stats = df.groupBy(*as_list(key)).agg(
        F.count(returns).alias("n"), F.avg(returns).alias("mean"), F.stddev_samp(returns).alias("stddev"),
        F.min(returns).alias("min"), F.max(returns).alias("max"), quartiles.alias("_q"),
    )
    named = {"q25": F.col("_q")[0], "median": F.col("_q")[1], "q75": F.col("_q")[2]}
    return stats.withColumns(named).drop("_q")


def sharpe(df: DataFrame, key: Names, rf: float = 0.0, periods: int | None = None, returns: str = "daily_return") -> DataFrame:
    """Mean excess return over deviation, scaled by the root of ``periods`` if given."""
    ratio = safe_div(F.avg(returns) - F.lit(rf), F.stddev_samp(returns))
    if periods is not None:
        ratio = ratio * F.sqrt(F.lit(float(periods)))
    return df.groupBy(*as_list(key)).agg(F.count(returns).alias("n"), ratio.alias("sharpe"))


def max_drawdown(df: DataFrame, key: Names, price: str = "price_usd", order: str = "date") -> DataFrame:
    """Deepest fall below the running peak and the first day it was reached."""
    fallen = drawdown(df, key, price, order)
    return fallen.groupBy(*as_list(key)).agg(
        F.min("drawdown").alias("max_drawdown"),
        F.min_by(order, F.when(F.col("drawdown").isNotNull(), F.struct("drawdown", order))).alias("trough_date"),
    )


def histogram(df: DataFrame, col: str, lo: float, hi: float, bins: int) -> DataFrame:
    """Counts per bin, empty bins included. Bin 0 lies below ``lo``, bin ``bins + 1`` at
    or above ``hi``."""
    placed = F.width_bucket(F.col(col), F.lit(float(lo)), F.lit(float(hi)), F.lit(bins))
    counts = df.filter(F.col(col).isNotNull()).groupBy(placed.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(bins + 2).select(F.col("id").alias("bin"))
    step = (hi - lo) / bins
    return every.join(counts, "bin", "left").select(
        "bin",
        F.when(F.col("bin") > 0, F.lit(float(lo)) + (F.col("bin") - 1) * F.lit(step)).alias("bin_from"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
    )


def _both(x: str, y: str) -> Column:
    return F.count(F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), F.lit(1)))


def correlate(df: DataFrame, x: str, y: str, by: Names = ()) -> DataFrame:
    """Correlation ``r``, ``r2`` and sample size of two columns."""
    stats = df.groupBy(*as_list(by)).agg(safe_corr(x, y).alias("r"), _both(x, y).alias("n"))
    return stats.select(*as_list(by), "r", (F.col("r") * F.col("r")).alias("r2"), "n")


_COLUMN_PAIRS = 8


def correlate_pairs(df: DataFrame, pairs: Sequence[Pair], by: Names = ()) -> DataFrame:
    """``correlate`` for many pairs in one aggregate and one exchange: rows (by, x, y, r, r2, n).

    A few pairs are columns of one aggregate, whose results are turned into rows. More than that
    exceed what Spark compiles and go through ``comoments``. Input rows are not multiplied either way.
    """
    by = as_list(by)
    if len(pairs) <= _COLUMN_PAIRS:
        stats = [c for i, (x, y) in enumerate(pairs) for c in (safe_corr(x, y).alias(f"_r{i}"), _both(x, y).alias(f"_n{i}"))]
        each = F.array(*[F.struct(F.lit(i).alias("_pair"), F.col(f"_r{i}").alias("r"), F.col(f"_n{i}").alias("n")) for i in range(len(pairs))])
        found = df.groupBy(*by).agg(*stats).select(*by, F.inline(each))
    else:
        xs, ys = (list(dict.fromkeys(pair[side] for pair in pairs)) for side in (0, 1))
        number = {(xs.index(x), ys.index(y)): i for i, (x, y) in enumerate(pairs)}
        at = F.lit([number.get((i, j), -1) for i in range(len(xs)) for j in range(len(ys))])
        found = comoments(df, xs, ys, by).withColumn("_pair", at[F.col("x") * len(ys) + F.col("y")]).filter(F.col("_pair") >= 0)
    names = [F.lit([pair[side] for pair in pairs])[F.col("_pair")] for side in (0, 1)]
    return found.select(
        *by, names[0].alias("x"), names[1].alias("y"), "r", (F.col("r") * F.col("r")).alias("r2"), "n"
    )


def correlation_matrix(
    df: DataFrame, cols: Sequence[str], on: str = "levels", key: Names | None = None, order: str = "date", by: Names = ()
) -> DataFrame:
    """Full matrix in tall form, symmetric, with the diagonal. ``on="returns"`` takes
    relative changes against the previous row of ``key`` first."""
    if on not in ("levels", "returns"):
        raise ValueError(f"on must be 'levels' or 'returns', not {on!r}")
    if on == "returns":
        if key is None:
            raise ValueError("on='returns' needs the key of the series")
        window = by_key(key, order)
        changes = {c: F.lag(c).over(window) for c in cols}
        df = df.withColumns({c: F.when(before > 0, F.col(c) / before - 1) for c, before in changes.items()})
    half = [*combinations(cols, 2), *((c, c) for c in cols)]
    upper = correlate_pairs(df, half, by)
    swapped = F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y")))
    once = F.array(F.struct("x", "y"))
    sides = F.explode(F.when(F.col("x") == F.col("y"), once).otherwise(swapped)).alias("_p")
    return upper.select(*as_list(by), sides, "r", "r2", "n").select(*as_list(by), "_p.x", "_p.y", "r", "r2", "n")


def correlation_by_regime(df: DataFrame, regime: str, pairs: Sequence[Pair], by: Names = ()) -> DataFrame:
    """Correlations within each regime: of all rows together, or for each ``by`` apart."""
    return correlate_pairs(df.filter(F.col(regime).isNotNull()), pairs, by=[*as_list(by), regime])


def lagged_correlation(
    df: DataFrame, x: str, y: str, lags: Sequence[int], key: Names, order: str = "date", by: Names = ()
) -> DataFrame:
    """Correlation of ``y`` with ``x`` of k rows before, for each k: rows (by, lag, r, r2, n), of
    all keys together unless ``by`` names columns. All lags share one window, all correlations
    one aggregate."""
    by = as_list(by)
    over = f"OVER (PARTITION BY {', '.join(map(quoted, as_list(key)))} ORDER BY {quoted(order)})"
    shifted = df.selectExpr(*map(quoted, by), quoted(y), *[f"lag({quoted(x)}, {k}) {over} AS _x{k}" for k in lags])
    pairs = correlate_pairs(shifted, [(f"_x{k}", y) for k in lags], by=by)
    return pairs.select(*by, F.substring_index("x", "_x", -1).cast("int").alias("lag"), "r", "r2", "n")


def price_volume_corr(df: DataFrame, key: Names, price: str = "price_usd", volume: str = "volume_usd") -> DataFrame:
    return correlate(df, price, volume, by=key)


def regime_summary(df: DataFrame, key: Names, regime: str = "regime", returns: str = "daily_return") -> DataFrame:
    """Days and mean return in each regime."""
    return df.filter(F.col(regime).isNotNull()).groupBy(*as_list(key), regime).agg(
        F.count(F.lit(1)).alias("days"), F.avg(returns).alias("mean_return")
    )


def current_metrics(df: DataFrame, key: Names, price: str = "price_usd", order: str = "date") -> DataFrame:
    """Latest day, price and change in percent. The aggregate reuses the window's
    partitioning, so it adds no exchange."""
    changed = daily_change_pct(df, key, price, order)
    last = changed.groupBy(*as_list(key)).agg(F.max_by(F.struct(order, price, "change_pct"), order).alias("_last"))
    return last.select(*as_list(key), "_last.*")
