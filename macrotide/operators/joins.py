"""Joins, calendars and alignment in time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from macrotide.operators.clean import with_series_meta
from macrotide.operators.common import Names, as_list, by_key
from macrotide.operators.prefix import Running, prefix_scan
from macrotide.operators.series import indicator_trend


def fact_prices(prices: DataFrame, econ_wide: DataFrame, on: str = "date") -> DataFrame:
    """Prices with the economic context of their day. ``econ_wide`` has one row per day, which is checked as it
    is read: a second row of a day is an error, as it would double prices. Its size is bounded by the calendar and its
    columns then: while a millennium of it is small, it is broadcast and no price moves. Rows without a day
    join nothing."""
    rest = [c for c in econ_wide.columns if c != on]
    days = econ_wide.filter(F.col(on).isNotNull()).groupBy(on).agg(F.count(F.lit(1)).alias("_rows"), *[F.any_value(c).alias(c) for c in rest])
    doubled = F.raise_error(F.concat(F.lit("several rows of one day in the economic table: "), F.col(on).cast("string")))
    days = days.withColumn(on, F.when(F.col("_rows") == 1, F.col(on)).otherwise(doubled)).select(on, *rest)
    row_bytes = sum(_FIXED_BYTES.get(f.dataType.simpleString(), _BROADCAST_BYTES) for f in econ_wide.schema)
    small = row_bytes * 366 * 1000 <= _BROADCAST_BYTES
    return prices.join(F.broadcast(days) if small else days, on, "left")


_BROADCAST_BYTES = 256 << 20
_FIXED_BYTES = {"date": 16, "double": 16, "float": 16, "bigint": 16, "int": 16, "boolean": 16, "timestamp": 16, "timestamp_ntz": 16}


def densify(df: DataFrame, key: Names, order: str = "date", start: date | str | None = None, end: date | str | Column | None = None) -> DataFrame:
    """A row for every day from a key's first to its last, new rows null besides the
    key and date; ``start`` and ``end`` widen the range. Rows with a null date stay as they are.

    Each row yields the days up to the next row of its key, so one window does the
    work of a calendar join.
    """
    keys = as_list(key)
    window = by_key(keys, order)
    following = F.lead(order).over(window)
    lower = F.col(order)
    if start is not None:
        first = F.lag(order).over(window).isNull()
        lower = F.when(first, F.least(F.lit(str(start)).cast("date"), order)).otherwise(lower)
    upper = F.col(order)
    if end is not None:
        end = end if isinstance(end, Column) else F.lit(str(end))
        upper = F.greatest(end.cast("date"), order)
    # greatest() keeps rows that share a date as they are instead of counting backwards.
    upper = F.when(following.isNotNull(), F.greatest(F.date_sub(following, 1), F.col(order))).otherwise(upper)

    dated = F.col(order).isNotNull()
    spread = df.withColumns({"_lower": F.when(dated, lower), "_upper": F.when(dated, upper)}).withColumn(
        "_day", F.explode_outer(F.sequence("_lower", "_upper", F.expr("interval 1 day")))
    )
    own = F.col("_day").eqNullSafe(F.col(order))
    values = [
        F.col("_day").alias(order) if c == order
        else F.col(c) if c in keys
        else F.when(own, F.col(c)).alias(c)
        for c in df.columns
    ]
    return spread.select(*values)


def dim_economic(series: DataFrame, catalog: DataFrame) -> DataFrame:
    """Series points with catalogue metadata, change and trend."""
    return indicator_trend(with_series_meta(series, catalog)).select(
        "series_key", "series_id", "category", "date", "numeric_value", "change", "trend"
    )


def fact_network(blocks: DataFrame, fees: DataFrame, mempool: DataFrame) -> DataFrame:
    """Daily block statistics with the day's fees per target and mempool state."""
    return blocks.join(fees, "date", "left").join(mempool, "date", "left")


def asof_join(
    left: DataFrame, right: DataFrame, key: Names, ts: str, cols: Sequence[str], *,
    right_ts: str | None = None, pieces: int | None = None,
) -> DataFrame:
    """Each left row with ``cols`` of the latest right row of its key at or before it;
    null keys and times match nothing. Of right rows at one instant either may stand.

    Both sides are put in one time order and the last right row is carried forward to the left rows by a
    prefix scan: no range join, each side read by one scan, and a key with all rows is dealt over all tasks
    like any other. Only rows of one key at one instant stay together. Left rows that can match nothing
    pass by the exchange.
    """
    keys, cols = as_list(key), list(cols)
    right_ts = right_ts or ts
    other = [c for c in left.columns if c not in keys and c != ts]
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, ts]])
    left_rows = left.filter(known).select(*keys, F.col(ts).alias("_ts"), F.lit(1).alias("_side"), *other)
    right_rows = right.dropna(subset=[*keys, right_ts]).select(
        *keys, F.col(right_ts).alias("_ts"), F.lit(0).alias("_side"), F.struct(*cols).alias("_right")
    )
    both = left_rows.unionByName(right_rows, allowMissingColumns=True)
    found = prefix_scan(both, keys, ["_ts", "_side"], {"_found": Running("last", "_right")}, pieces)
    matched = found.filter(F.col("_side") == 1).select(
        *[F.col("_ts").alias(c) if c == ts else F.col(c) for c in left.columns],
        *[F.col(f"_found.{c}").alias(c) for c in cols],
    )
    nothing = [F.lit(None).cast(right.schema[c].dataType).alias(c) for c in cols]
    return matched.union(left.filter(~known).select(*left.columns, *nothing))


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Child rows whose key is set but has no parent. Only the parent's key column is
    read, and a null key is no orphan."""
    parents = parent.select(F.col(pk).alias(fk))
    return child.filter(F.col(fk).isNotNull()).join(parents, fk, "left_anti").select(*child.columns)


def missing_dates(df: DataFrame, key: Names, start: date | str, end: date | str, order: str = "date") -> DataFrame:
    """Days of the range that a key lacks, as a worklist of (key, date). The holes are
    read off neighbouring rows, so no calendar is built or joined."""
    keys = as_list(key)
    lo, hi = F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")
    days = df.filter(F.col(order).isNotNull()).select(*keys, order).distinct()
    window = by_key(keys, order)

    def hole(first: Column, last: Column) -> Column:
        return F.when(first <= last, F.sequence(first, last, F.expr("interval 1 day")))

    after_last = F.coalesce(F.date_sub(F.lead(order).over(window), 1), hi)
    holes = days.select(
        *keys,
        hole(F.greatest(F.date_add(order, 1), lo), F.least(after_last, hi)).alias("_after"),
        F.when(F.lag(order).over(window).isNull(), hole(lo, F.least(F.date_sub(order, 1), hi))).alias("_before"),
    )
    empty = F.array().cast("array<date>")
    each = F.concat(F.coalesce("_before", empty), F.coalesce("_after", empty))
    return holes.select(*keys, F.explode(each).alias(order))


def network_stats(sources: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row with the latest record of each source, from ``name -> (rows, time column)``.

    The sources are stacked and reduced by one aggregate, so no single-row cross join
    is planned and each task sends one row.
    """
    names = list(sources)
    tagged = [
        df.select(F.lit(name).alias("_source"), F.col(ts).cast("timestamp_ntz").alias("_at"), F.struct(*df.columns).alias(name))
        for name, (df, ts) in sources.items()
    ]
    stacked = tagged[0]
    for part in tagged[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked.agg(
        *[F.max_by(name, F.when(F.col("_source") == name, F.col("_at"))).alias(name) for name in names]
    )


def align(a: DataFrame, b: DataFrame, on: str = "date") -> DataFrame:
    """Two series side by side on their common days."""
    return a.join(b, on, "inner")


def lag_align(df: DataFrame, x: str, y: str, k: int, key: Names, order: str = "date") -> DataFrame:
    """``y`` beside ``x`` of ``k`` rows before; the rows are days after ``densify``."""
    lagged = F.lag(x, k).over(by_key(key, order))
    return df.select(*as_list(key), order, lagged.alias(f"{x}_lag{k}"), y)
