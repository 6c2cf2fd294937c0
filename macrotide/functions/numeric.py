"""Null-safe numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def finite(c: Column | str) -> Column:
    """The value, or null for NaN and the infinities (NaN sorts above +Inf)."""
    c = column(c)
    return F.when(F.abs(c) < F.lit(float("inf")), c)


def safe_double(c: Column | str) -> Column:
    """Number held as text or number; ``'N/A'`` and other non-numbers become null."""
    return finite(column(c).try_cast("double"))


def safe_long(c: Column | str) -> Column:
    return column(c).try_cast("bigint")


def safe_div(a: Column | str, b: Column | str) -> Column:
    return F.try_divide(column(a), column(b))


def percent(part: Column | str, whole: Column | str) -> Column:
    return safe_div(part, whole) * F.lit(100.0)


def safe_corr(x: Column | str, y: Column | str) -> Column:
    """Pearson correlation of the rows that have both values; null if either side
    is constant (the built-in raises a division error there)."""
    x, y = column(x), column(y)
    both = x.isNotNull() & y.isNotNull()
    px, py = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_samp(px, py), F.stddev_samp(px) * F.stddev_samp(py))


def recency(df: DataFrame, ts: str, tie: str | None = None) -> Column:
    """Ordering of the rows of one day for "latest wins": later ``ts``, then larger ``tie``.

    Aggregation buffers of fixed width keep ``max_by`` in a hash aggregate, which a time
    alone allows. A date does not order the rows of its day, so the tie-break stands
    alone there. Only a time with a tie-break needs a struct, for which Spark sorts each
    task's rows ahead of the partial aggregate.
    """
    if tie is None:
        return F.col(ts)
    return F.col(tie) if isinstance(df.schema[ts].dataType, T.DateType) else F.struct(ts, tie)
