"""Validation: every row gets at most one reject reason."""

from pyspark.sql import functions as F

from ..constants import (
    BAD_CODE,
    BAD_DATE,
    BAD_NUMBER,
    BAD_PRICE,
    UNKNOWN_REASON,
    UNKNOWN_SOURCE,
)
from ..functions import blank_to_null


def validate(rows):
    """Add ``_reject_reason``: the first rule the row fails, or null."""
    quantity, price = F.col("quantity"), F.col("unit_price")
    reason = (
        F.when(F.col("invoice_date").isNull(), BAD_DATE)
        .when(quantity.isNull() | price.isNull(), BAD_NUMBER)
        .when((quantity > 0) & (price <= 0), BAD_PRICE)
        .when(F.length("stock_code") == 0, BAD_CODE)
    )
    return rows.withColumn("_reject_reason", reason)


def accepted(rows):
    return _side(rows, False)


def rejected(rows):
    return _side(rows, True)


def _side(rows, reject):
    """One side of validated rows; staged rows are partitioned by side."""
    if "is_rejected" in rows.columns:
        return rows.filter(F.col("is_rejected") == reject).drop("is_rejected")
    reason = F.col("_reject_reason")
    return rows.filter(reason.isNotNull() if reject else reason.isNull())


def reject_entries(rejects, run_date):
    """Rejected rows in the shape of the audit log, ids aside.

    ``raw_data`` is the row as JSON, nulls included; below ``_raw`` it has the
    texts as they arrived.
    """
    as_text = F.to_json(F.struct(*rejects.columns), {"ignoreNullFields": "false"})
    return rejects.select(
        F.coalesce("_source", F.lit(UNKNOWN_SOURCE)).alias("source"),
        blank_to_null(F.col("invoice_no")).alias("raw_invoice_no"),
        blank_to_null(F.col("stock_code")).alias("raw_product_code"),
        as_text.alias("raw_data"),
        F.coalesce("_reject_reason", F.lit(UNKNOWN_REASON)).alias("reject_reason"),
        F.lit(run_date).cast("date").alias("pipeline_run_date"),
    )
