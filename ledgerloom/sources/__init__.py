from .feeds import (
    overlong_rows,
    read_extract,
    read_history,
    read_sales,
    tag_history_sheet,
    tag_sales,
    unify,
)

__all__ = [
    "overlong_rows",
    "read_extract",
    "read_history",
    "read_sales",
    "tag_history_sheet",
    "tag_sales",
    "unify",
]
