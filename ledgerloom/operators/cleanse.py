"""Typed columns out of the text feed."""

from pyspark.sql import functions as F

from ..constants import ANONYMOUS, DATE_FORMATS
from ..functions import parse_number, parse_timestamp, strip

OVERWRITTEN = ["stock_code", "description", "quantity", "invoice_date", "unit_price"]


def normalise_code(feed):
    """Product codes in upper case without white space around; null is blank."""
    code = F.coalesce("stock_code", F.lit(""))
    return feed.withColumn("stock_code", F.upper(strip(code)))


def cleanse(feed, date_formats=DATE_FORMATS):
    """Normalise the code and parse date and numbers.

    ``_raw`` keeps the texts this replaces; it is pruned away unless used.

    Parsed values leave through a one-row generator. Filters on them (the
    reject rules) stay above it; in a plain projection the optimizer would
    copy the parsing into every such filter and run it again each time.
    """
    parsed = F.struct(
        parse_number(F.col("quantity")).alias("quantity"),
        parse_timestamp(F.col("invoice_date"), date_formats).alias("invoice_date"),
        parse_number(F.col("unit_price")).alias("unit_price"),
    )
    kept = ["invoice_no", "description", "customer_id", "country", "_source"]
    kept += [c for c in ["_sheet"] if c in feed.columns]
    return normalise_code(feed.withColumn("_raw", F.struct(*OVERWRITTEN))).select(
        *kept, "stock_code", "_raw", F.inline(F.array(parsed))
    )


def normalise_customer(rows):
    """Missing or blank ids become the anonymous customer; ``17850.0`` is 17850."""
    stripped = strip(F.col("customer_id"))
    known = F.when(~stripped.isin("", "nan"), stripped)
    # Nothing white is left at the end, so this is the pattern \.0$ without its price.
    whole = F.substring(stripped, F.lit(1), F.length(stripped) - 2)
    known = F.when(F.endswith(stripped, F.lit(".0")), whole).otherwise(known)
    return rows.withColumn("customer_id", F.coalesce(known, F.lit(ANONYMOUS)))
