"""Column helpers. All return ``Column`` and stay inside generated code."""

from macrotide.functions.numeric import (
    finite,
    percent,
    recency,
    safe_corr,
    safe_div,
    safe_double,
    safe_long,
)
from macrotide.functions.text import (
    bool_text,
    byte_length,
    comma_list,
    map_get,
    slug,
)
from macrotide.functions.time import (
    format_day,
    format_iso,
    format_snapshot,
    from_epoch,
    parse_day,
    parse_iso,
    parse_snapshot,
    seconds_between,
)

__all__ = [
    "bool_text", "byte_length", "comma_list", "finite",
    "format_day", "format_iso", "format_snapshot", "from_epoch", "map_get", "parse_day", "parse_iso",
    "parse_snapshot", "percent", "recency", "safe_corr", "safe_div", "safe_double", "safe_long",
    "seconds_between", "slug",
]
