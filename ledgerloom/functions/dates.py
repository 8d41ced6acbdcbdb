"""Dates parsed from text, and calendar attributes."""

import re
from functools import reduce
from operator import and_

from pyspark.sql import functions as F

from ..constants import DATE_FORMATS


def parse_timestamp(col, formats=DATE_FORMATS):
    """First of ``formats`` that reads the text, in the session's zone (UTC).

    A layout is only tried where all its separators occur in the text: a
    failed parse raises inside the JVM, which costs more than the parse.
    """

    def attempt(layout):
        parsed = F.try_to_timestamp(col, F.lit(layout))
        found = [F.contains(col, F.lit(mark)) for mark in _separators(layout)]
        return F.when(reduce(and_, found), parsed) if found else parsed

    return F.coalesce(*[attempt(layout) for layout in formats])


def _separators(layout):
    """The literal texts that ``layout`` requires: not those inside brackets."""
    inner = None
    while layout != inner:
        inner, layout = layout, re.sub(r"\[[^\[\]]*\]", "", layout)
    quoted = re.findall(r"'([^']+)'", layout)
    bare = re.sub(r"'[^']*'", "", layout)
    return sorted(set(quoted + re.findall(r"[^A-Za-z\[\]']", bare)))


def month_id(day):
    """Year and month as one integer, e.g. 201012."""
    return (F.year(day) * 100 + F.month(day)).cast("int")


def calendar_columns(day):
    """Attributes of the calendar dimension, in table order."""
    # Weeks start on Monday; days before the first Monday are week 0.
    week = F.floor((F.dayofyear(day) + 6 - F.weekday(day)) / 7)
    return [
        F.year(day).cast("smallint").alias("year"),
        F.quarter(day).cast("smallint").alias("quarter"),
        F.month(day).cast("smallint").alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        week.cast("smallint").alias("week"),
        F.dayofmonth(day).cast("smallint").alias("day"),
        F.weekday(day).cast("smallint").alias("day_of_week"),
        (F.weekday(day) >= 5).alias("is_weekend"),
    ]
