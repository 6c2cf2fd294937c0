"""Sorted output, pages and ranked search."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from macrotide.operators.common import Names, as_list


def _directed(cols: Sequence[str], order: str) -> list[Column]:
    if order not in ("asc", "desc"):
        raise ValueError(f"order must be 'asc' or 'desc', not {order!r}")
    return [F.col(c).asc_nulls_last() if order == "asc" else F.col(c).desc_nulls_last() for c in cols]


def sort_series(df: DataFrame, by: Names = "date", order: str = "asc") -> DataFrame:
    return df.orderBy(*_directed(as_list(by), order))


def page(df: DataFrame, by: Names, limit: int, offset: int = 0, order: str = "asc", tie: Names = ()) -> DataFrame:
    """``limit`` rows after the first ``offset``; ``tie`` makes the order total. Rows up to
    ``offset + limit`` meet in one task, so use ``page_after`` to go far."""
    ordered = df.orderBy(*_directed(as_list(by), order), *[F.col(c) for c in as_list(tie)])
    return ordered.offset(offset).limit(limit)


def page_after(df: DataFrame, by: str, last: object, limit: int, order: str = "asc", tie: str | None = None, last_tie: object = None) -> DataFrame:
    """The page that follows the row with the values ``last`` (and ``last_tie``): a filter that
    reaches the scan and one top-k of ``limit`` rows, however far the page is. ``last`` is not
    null; rows with a null in ``by`` are on no page."""
    later = F.col(by) > F.lit(last) if order == "asc" else F.col(by) < F.lit(last)
    if tie is not None:
        later = later | ((F.col(by) == F.lit(last)) & (F.col(tie) > F.lit(last_tie)))
    return page(df.filter(later), by, limit, 0, order, tie or ())


def search_catalog(
    df: DataFrame, text: str, in_cols: Names, by: str, order: str = "desc", tie: Names = (), limit: int | None = None, offset: int = 0
) -> DataFrame:
    """Rows with ``text`` in any of the columns, ignoring case, ranked by ``by``: all of them,
    or a page if ``limit`` is given."""
    found = F.lit(False)
    for c in as_list(in_cols):
        found = found | F.coalesce(F.contains(F.lower(c), F.lit(text.lower())), F.lit(False))
    if limit is None:
        ranked = df.filter(found).orderBy(*_directed(as_list(by), order), *as_list(tie))
        return ranked.offset(offset) if offset else ranked
    return page(df.filter(found), by, limit, offset, order, tie)
