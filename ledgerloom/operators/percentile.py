"""Percentiles of any number of rows.

``exact_percentiles`` runs jobs and returns numbers, ``percentile_in_plan`` is
exact too but stays part of the plan, and quantile sketches are small, can be
stored and merged, and are right up to a stated rank.
"""

from decimal import Decimal, localcontext

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import use_checkpoints

# Digits of the interpolation: more than two values of a Spark decimal need.
DIGITS = 80


def exact_percentiles(rows, columns, fraction, tie_break):
    """Linearly interpolated percentile of each column, as exact decimals.

    ``rows`` is read once per column: pass a table or a checkpointed frame.
    ``tie_break`` columns spread equal values. None without a value.
    """
    return {c: _by_rank(rows, c, Decimal(str(fraction)), tie_break) for c in columns}


def _by_rank(rows, column, fraction, tie_break):
    """Sort, then fetch the one or two values around the wanted rank."""
    use_checkpoints(rows.sparkSession)
    known = rows.filter(F.col(column).isNotNull())
    ordered = known.orderBy(column, *tie_break).select(F.col(column).alias("value"))
    # Fixed partitions from here on: the ids below must not change between reads.
    placed = ordered.checkpoint().select("value", F.monotonically_increasing_id().alias("id"))
    # One row per partition: where it starts and how many values it has.
    sizes = sorted(
        placed.groupBy(F.spark_partition_id().alias("part"))
        .agg(F.min("id").alias("start"), F.count("*").alias("n"))
        .collect()
    )
    total = sum(size.n for size in sizes)
    if total == 0:
        return None
    with localcontext(prec=DIGITS):
        rank = fraction * (total - 1)
        low = int(rank)
        ids = [_id_at(sizes, r) for r in (low, min(low + 1, total - 1))]
        found = {row.id: row.value for row in placed.filter(F.col("id").isin(ids)).collect()}
        below, above = (Decimal(str(found[i])) for i in ids)
        return below + (above - below) * (rank - low)


def _id_at(sizes, rank):
    for size in sizes:
        if rank < size.n:
            return size.start + rank
        rank -= size.n
    raise IndexError(rank)


# In the plan ---------------------------------------------------------------

ACCURACY = 100_000


def percentile_in_plan(rows, column, fraction, accuracy=ACCURACY):
    """One row with ``value``, the interpolated percentile, exact; null without a value.

    No job runs before the answer is asked for. An approximate percentile, whose
    rank is off by at most one row in ``accuracy``, is taken on both sides at ten
    times that distance. Only the values between them, one row in ``accuracy / 20``,
    are then ranked together; of the others it matters how many are below. If the
    wanted rank were not between them, the plan would stop with an error.
    """
    fraction = Decimal(str(fraction))
    known = rows.filter(F.col(column).isNotNull()).select(F.col(column).alias("x"))
    margin = Decimal(10) / accuracy
    sides = [float(max(fraction - margin, 0)), float(min(fraction + margin, 1))]
    ends = known.agg(F.percentile_approx("x", sides, accuracy).alias("ends"), F.count("*").alias("n"))
    low, high = [ends.select(F.get("ends", F.lit(i))).scalar() for i in (0, 1)]
    few = ends.select(F.col("n") <= accuracy).scalar()  # then ten distances may be less than a row
    between = (
        known.filter((F.col("x") <= high) | few)
        .groupBy(F.when((F.col("x") >= low) | few, F.col("x")).alias("x"))
        .agg(F.count("*").alias("rows"))
    )
    upto = Window.orderBy(F.asc_nulls_first("x")).rowsBetween(Window.unboundedPreceding, 0)
    last = (ends.select("n").scalar() - 1).cast("decimal(19,0)")
    rank = last * F.lit(fraction)
    whole = F.floor(rank)
    ranked = between.withColumn("upto", F.sum("rows").over(upto))
    found = ranked.agg(
        F.coalesce(F.sum(F.when(F.col("x").isNull(), F.col("rows"))), F.lit(0)).alias("below"),
        F.min(F.when(F.col("upto") > whole, F.col("x"))).alias("lower"),
        F.min(F.when(F.col("upto") > F.least(whole + 1, last), F.col("x"))).alias("upper"),
        F.sum("rows").alias("seen"),
    )
    missed = (F.col("below") > whole) | F.col("lower").isNull() | F.col("upper").isNull()
    value = F.col("lower") + (F.col("upper") - F.col("lower")) * (rank - whole)
    stop = F.raise_error(F.lit("the wanted rank is not between the approximate ones")).cast("double")
    return found.select(
        F.when(F.col("seen").isNull(), F.lit(None)).when(missed, stop.cast("int")).otherwise(value).alias("value")
    )


# Sketches --------------------------------------------------------------------

SKETCH_K = 2048
# One-sided rank error at 99 % confidence that a sketch of this k promises (measured in the tests).
RANK_ERROR = 0.002


def quantile_sketch(column, k=SKETCH_K):
    """The mergeable quantile sketch of a column, as an aggregate."""
    return F.kll_sketch_agg_double(F.col(column).cast("double"), F.lit(k))


def quantile_sketches(rows, keys, column, k=SKETCH_K):
    """One mergeable quantile sketch of ``column`` per group, from one aggregation."""
    return rows.groupBy(*keys).agg(quantile_sketch(column, k).alias("sketch"))


def merged_sketches(sketches, keys=(), k=SKETCH_K):
    """Sketches of coarser groups, without reading the rows again."""
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def sketched_quantile(sketch, fraction):
    """A value whose rank is ``fraction``, up to ``RANK_ERROR``."""
    return F.kll_sketch_get_quantile_double(sketch, F.lit(float(fraction)))
