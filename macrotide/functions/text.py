"""Text and map helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from macrotide.functions.numeric import column


def slug(c: Column | str) -> Column:
    """Lower case, spaces to underscores."""
    return F.replace(F.lower(column(c)), F.lit(" "), F.lit("_"))


def map_get(m: Column | str, key: str, default: object = None) -> Column:
    """Map value, or ``default`` when the map, the key or the value is missing."""
    return F.coalesce(F.try_element_at(column(m), F.lit(key)), F.lit(default))


def comma_list(c: Column | str) -> Column:
    return F.array_join(column(c), ",")


def byte_length(c: Column | str) -> Column:
    return F.octet_length(column(c))


def bool_text(c: Column | str) -> Column:
    return F.lower(column(c).cast("string"))
