"""Column expressions; every one of them runs inside the JVM."""

from .dates import calendar_columns, month_id, parse_timestamp
from .numbers import parse_number, percent, ratio
from .text import blank_to_null, null_tokens, strip, title_case

__all__ = [
    "blank_to_null",
    "calendar_columns",
    "month_id",
    "null_tokens",
    "parse_number",
    "parse_timestamp",
    "percent",
    "ratio",
    "strip",
    "title_case",
]
