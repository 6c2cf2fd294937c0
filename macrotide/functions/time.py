"""Date and time text. Every parser gives null, never an error, on bad input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from macrotide.functions.numeric import column

# The date and time formats of the landing files.
DAY_FIRST = "dd-MM-yyyy"
ISO_DAY = "yyyy-MM-dd"
COMPACT_DAY = "yyyyMMdd"
SNAPSHOT = "yyyyMMdd_HHmmss"


def parse_day(c: Column | str, fmt: str = ISO_DAY) -> Column:
    return F.try_to_date(column(c), fmt)


def format_day(c: Column | str, fmt: str = ISO_DAY) -> Column:
    return F.date_format(column(c), fmt)


def parse_iso(c: Column | str) -> Column:
    """ISO-8601 local time, no zone."""
    return column(c).try_cast("timestamp_ntz")


def format_iso(c: Column | str) -> Column:
    return F.date_format(column(c), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def parse_snapshot(c: Column | str) -> Column:
    """``yyyyMMdd_HHmmss``, read without any zone."""
    pattern = r"^(\d{4})(\d{2})(\d{2})_(\d{2})(\d{2})(\d{2})$"
    return F.regexp_replace(column(c), pattern, "$1-$2-$3 $4:$5:$6").try_cast("timestamp_ntz")


def format_snapshot(c: Column | str) -> Column:
    return F.date_format(column(c), SNAPSHOT)


EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def from_epoch(seconds: Column | str) -> Column:
    """Zoneless UTC time of a Unix time in seconds, whatever the session zone."""
    return F.expr(EPOCH) + F.make_dt_interval(secs=column(seconds))


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Exact seconds from one time to another, as a decimal. The difference of two
    zoneless times is an interval, so no session zone and no clock change enters."""
    return (column(end) - column(start)).cast("interval second").cast("decimal(18,6)")
