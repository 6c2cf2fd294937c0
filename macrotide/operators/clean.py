"""Projections, filters and version handling (bronze to silver)."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from macrotide.functions import map_get, parse_day, parse_iso, safe_double, slug
from macrotide.functions.time import DAY_FIRST
from macrotide.operators.common import Names, as_list

# The currency whose amounts are kept and the stand-in for "no value".
CURRENCY = "usd"
NO_VALUE = "N/A"


def normalize_prices(df: DataFrame, currency: str = CURRENCY) -> DataFrame:
    """Landed price records to typed rows. Records without market data are dropped;
    a missing or non-numeric amount is null and the record stays."""

    def amount(field: str) -> Column:
        return safe_double(map_get(f"market_data.{field}", currency, NO_VALUE))

    return df.filter(F.col("market_data").isNotNull()).select(
        "asset_id",
        parse_day("date", DAY_FIRST).alias("date"),
        amount("current_price").alias("price_usd"),
        amount("market_cap").alias("market_cap_usd"),
        amount("total_volume").alias("volume_usd"),
        parse_iso("collection_timestamp").alias("collection_timestamp"),
    )


def typed_points(df: DataFrame) -> DataFrame:
    return df.select(
        "series_key",
        parse_day("date").alias("date"),
        safe_double("value").alias("numeric_value"),
        parse_iso("collection_timestamp").alias("collection_timestamp"),
    )


def normalize_series(df: DataFrame, catalog: DataFrame) -> DataFrame:
    """Landed series points to typed rows, with id and category from the catalogue."""
    return with_series_meta(typed_points(df), catalog)


def with_series_meta(df: DataFrame, catalog: DataFrame) -> DataFrame:
    """Series id and category of each series key. A key outside the catalogue keeps its rows,
    with both null. No hint: the optimizer knows the catalogue's size and broadcasts it while
    it is small."""
    meta = catalog.select("series_key", "series_id", "category")
    kept = [c for c in df.columns if c not in ("series_id", "category")]
    return df.select(*kept).join(meta, "series_key", "left")


def category_of_slug(df: DataFrame, catalog: DataFrame, col: str = "category") -> DataFrame:
    """Rewrite a landing folder name (lower case, underscores) to the category key."""
    names = catalog.select(slug("category_label").alias("_slug"), F.col("category").alias("_category")).distinct()
    joined = df.join(names, slug(col) == F.col("_slug"), "left")
    return joined.withColumn(col, F.coalesce("_category", slug(col))).drop("_slug", "_category")


def filter_dates(df: DataFrame, start: date | str | None, end: date | str | None, col: str = "date") -> DataFrame:
    """Rows from ``start`` to ``end``, both inclusive; None leaves a side open. The
    bounds are cast to the column's type so that they reach the Parquet scan."""
    kind = df.schema[col].dataType.simpleString()
    bounds = []
    if start is not None:
        bounds.append(F.col(col) >= F.lit(str(start)).cast(kind))
    if end is not None and kind == "date":
        bounds.append(F.col(col) <= F.lit(str(end)).cast(kind))
    elif end is not None:
        bounds.append(F.col(col) < F.date_add(F.lit(str(end)).cast("date"), 1).cast(kind))
    return df.filter(reduce(lambda a, b: a & b, bounds)) if bounds else df


def trailing_days(df: DataFrame, asof: date | str, n: int = 365, col: str = "date") -> DataFrame:
    """The ``n`` days up to ``asof``, both ends inclusive (``n + 1`` days)."""
    asof = date.fromisoformat(str(asof))
    return filter_dates(df, date.fromordinal(asof.toordinal() - n), asof, col)


def quality_flags(df: DataFrame, rules: Mapping[str, Column], into: str = "quality_flags") -> DataFrame:
    """Array of the names of the rules a row breaks, and ``is_valid`` when it is empty.
    A rule that evaluates to null counts as not broken."""
    names = [F.when(F.coalesce(broken, F.lit(False)), F.lit(name)) for name, broken in rules.items()]
    return df.withColumn(into, F.array_compact(F.array(*names))).withColumn("is_valid", F.size(into) == 0)


def missing(col: str) -> Column:
    return F.col(col).isNull()


def negative(col: str) -> Column:
    return F.col(col) < 0


def available_series(payloads: DataFrame) -> DataFrame:
    """Series whose collection succeeded: payload present, with a point count."""
    return payloads.filter(F.col("payload").isNotNull() & F.col("payload.count").isNotNull())


def snapshot_sizes(df: DataFrame, col: str, n: int) -> DataFrame:
    """``list_size`` of each snapshot and whether it is ``over_limit``, with ``n`` entries or
    more (null for a null list). All rows stay; what to do with large ones is the caller's choice."""
    size = F.when(F.col(col).isNotNull(), F.size(col))
    return df.withColumn("list_size", size).withColumn("over_limit", F.col("list_size") >= n)


def scatter(df: DataFrame, x: str, y: str) -> DataFrame:
    """Points that have both values."""
    return df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).select(F.col(x).alias("x"), F.col(y).alias("y"))


def sample_interval(df: DataFrame, start: date | str, n: int, end: date | str | None = None, col: str = "date") -> DataFrame:
    """Every ``n``-th day counted from ``start``."""
    first = F.lit(str(start)).cast("date")
    return filter_dates(df, start, end, col).filter(F.datediff(F.col(col), first) % n == 0)


def blocks_from(df: DataFrame, height: int) -> DataFrame:
    """Blocks at or below a start height; zero is a height like any other."""
    return df.filter(F.col("height") <= F.lit(height))


# Types that an aggregation buffer can update in place; the value stands before all others.
LOWEST = {
    "date": "date'0001-01-01'", "timestamp": "timestamp'0001-01-01'", "timestamp_ntz": "timestamp_ntz'0001-01-01'",
    "int": "-2147483648", "bigint": "-9223372036854775808L", "double": "double('-Infinity')",
}


def latest_version(df: DataFrame, keys: Names, order: Names, apart: Names = ()) -> DataFrame:
    """One row per key: the row with the largest ``order`` columns, compared in turn;
    nulls rank lowest, and of equal ranks either row may stand. Rows with a null in one of
    the ``apart`` keys are versions of nothing: each stays.

    ``max_by`` keeps one row per key and task before the shuffle, so a key with very
    many versions costs no more than any other. With fixed-width columns and a single
    order column it stays a hash aggregate: every column is then picked by the same
    comparison, so the parts of a row stay together.
    """
    keys, order = as_list(keys), as_list(order)
    if apart:
        unknown = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in as_list(apart)])
        numbered = df.withColumn("_apart", F.when(unknown, F.monotonically_increasing_id()))
        return latest_version(numbered, [*keys, "_apart"], order).select(*df.columns)
    rest = [c for c in df.columns if c not in keys]
    kinds = {c: df.schema[c].dataType.simpleString() for c in df.columns}
    if len(order) == 1 and all(kinds[c] in LOWEST for c in {*rest, *order}):
        rank = F.coalesce(F.col(order[0]), F.expr(LOWEST[kinds[order[0]]]))
        picked = df.groupBy(*keys).agg(*[F.max_by(c, rank).alias(c) for c in rest])
        return picked.select(*df.columns)
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return newest.select(*keys, "_row.*").select(*df.columns)


def union_categories(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def merge_versions(old: DataFrame, new: DataFrame, keys: Names, order: Names) -> DataFrame:
    """Union of two collections with the newest version of each key."""
    return latest_version(old.unionByName(new), keys, order)
