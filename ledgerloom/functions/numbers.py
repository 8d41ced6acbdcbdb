"""Numbers parsed from text, and exact ratios."""

from pyspark.sql import functions as F

NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def parse_number(col):
    """Text to double; null where the text is not a finite decimal number.

    A bare cast also takes ``1d``, ``nan`` and ``inf``.
    """
    value = F.when(col.rlike(NUMBER), col.try_cast("double"))
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def ratio(part, whole, digits=2):
    """``part / whole`` in decimals, rounded half up."""
    return F.round(part.cast("decimal(22,4)") / whole.cast("decimal(22,4)"), digits)


def percent(part, whole, digits=2):
    """``100 * part / whole`` rounded half up, or 0 unless ``whole`` is positive."""
    quotient = part.cast("decimal(22,4)") / whole.cast("decimal(22,4)")
    share = F.when(whole > 0, quotient * 100).otherwise(F.lit(0))
    return F.round(share, digits)
