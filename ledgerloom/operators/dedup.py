"""One row per key, the best source first."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..constants import SOURCE_PRIORITY

TIE_BREAK = ["invoice_date", "quantity", "unit_price", "customer_id", "country"]


def priority_rank(col, priority=SOURCE_PRIORITY):
    """Position in ``priority``; null for anything not listed."""
    rank = F.lit(None).cast("int")
    for position, name in reversed(list(enumerate(priority))):
        rank = F.when(col == name, position).otherwise(rank)
    return rank


def first_per_key(rows, keys, order):
    """The first row of each key under ``order``; null keys are equal.

    Filtering the row number to 1 lets Spark cut every map partition to one
    row per key before the shuffle, so a hot key moves one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = rows.withColumn("_position", F.row_number().over(window))
    return ranked.filter(F.col("_position") == 1).drop("_position")


def deduplicate(
    rows,
    keys=("invoice_no", "stock_code"),
    source="_source",
    priority=SOURCE_PRIORITY,
    tie_break=TIE_BREAK,
):
    """Keep one row per key: best source, unknown sources last, then tie-breaks."""
    order = [priority_rank(F.col(source), priority).asc_nulls_last()]
    order += [F.col(name).asc_nulls_last() for name in tie_break]
    return first_per_key(rows, keys, order)
