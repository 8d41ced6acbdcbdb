"""From the unified feed to sales, returns and rejects, all lazy."""

from pyspark.sql import functions as F

from ..constants import DATE_FORMATS, SOURCE_PRIORITY
from ..operators.catalogue import assign_categories, canonical_descriptions, with_canonical
from ..operators.cleanse import cleanse, normalise_customer
from ..operators.dedup import deduplicate
from ..operators.route import accepted, rejected, validate
from ..operators.star import returns_of, sales_of, split_revenue


def route(feed, date_formats=DATE_FORMATS):
    """Typed rows with ``_reject_reason``; narrow, no shuffle."""
    return validate(cleanse(feed, date_formats))


def keep(routed, priority=SOURCE_PRIORITY):
    """Accepted rows: customers normalised, deduplicated, typed, with revenue.

    Descriptions stay out of this: nothing here needs them, and joining them
    first would leave rows partitioned by product alone for what follows.
    """
    rows = normalise_customer(accepted(routed).drop("_raw", "_reject_reason", "description"))
    return split_revenue(deduplicate(rows, priority=priority))


def transform(feed, run_date, date_formats=DATE_FORMATS, priority=SOURCE_PRIORITY):
    """(sales, returns, rejects) with canonical descriptions."""
    routed = route(feed, date_formats)
    canonical = canonical_descriptions(routed)
    kept = with_canonical(keep(routed, priority), canonical)
    rejects = with_canonical(rejected(routed), canonical).withColumn(
        "_pipeline_run_date", F.lit(run_date)
    )
    return sales_of(kept), returns_of(kept), rejects


def transform_and_classify(feed, run_date, **options):
    """As ``transform``, with a category on sales and returns."""
    sales, returns, rejects = transform(feed, run_date, **options)
    return assign_categories(sales), assign_categories(returns), rejects
