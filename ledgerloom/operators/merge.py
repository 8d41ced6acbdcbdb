"""Rerun-safe merges, as joins of the stored rows with the new ones."""

from functools import reduce
from operator import and_

from pyspark.sql import functions as F

from ..constants import ANONYMOUS
from .dedup import first_per_key


def upsert(stored, new, keys, update):
    """New version of ``stored``: matched rows take ``update`` columns from ``new``.

    Keys are unique on both sides and ``new`` has all columns of ``stored``.
    One full outer join, so each side is shuffled once.
    """
    old = stored.withColumn("_old", F.lit(True)).alias("old")
    fresh = new.withColumn("_new", F.lit(True)).alias("new")
    joined = old.join(fresh, _match(keys), "full_outer")

    def merged(name):
        if name in update:
            taken = F.when(F.col("_new"), F.col(f"new.{name}")).otherwise(F.col(f"old.{name}"))
        else:
            taken = F.when(F.col("_old"), F.col(f"old.{name}")).otherwise(F.col(f"new.{name}"))
        return taken.alias(name)

    return joined.select(*[merged(name) for name in stored.columns])


def changed_rows(stored, new, keys, compare):
    """Rows of ``new`` that are not stored yet or differ from the stored row in a column of ``compare``.

    Keys are unique on both sides.
    """
    old = stored.select(*keys, *compare, F.lit(True).alias("_old")).alias("old")
    same = reduce(and_, [F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in compare])
    joined = new.alias("new").join(old, _match(keys), "left")
    return joined.filter(F.col("_old").isNull() | ~same).select("new.*")


def key_part(keys, parts):
    """The part, from 0 to ``parts`` - 1, that a row belongs to by the hash of its key."""
    return F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")


def absent_rows(stored, new, keys, order=None, null_safe=False):
    """Rows of ``new`` to insert: one per key, and only keys not stored yet.

    Without ``order`` the keys of ``new`` must be unique already. Keys that
    may be null need ``null_safe``, or a rerun would insert them again.
    """
    if order is not None:
        new = first_per_key(new, keys, order)
    known = stored.select(*keys).alias("old")
    return new.alias("new").join(known, _match(keys, null_safe), "left_anti")


def possible_matches(stored, new, column, places=1 << 20):
    """Rows of ``stored`` that may have a value of ``column`` in ``new``; nulls may match nulls.

    Values are compared by a hash with ``places`` results, so what is broadcast
    has at most that many numbers (16 MB), however large ``new`` is. For stored
    rows that are not bucketed by the key; with more new values than places it
    keeps nearly all of them.
    """
    place = F.pmod(F.xxhash64(column), F.lit(places)).cast("int").alias("_place")
    wanted = new.select(place).distinct()
    return stored.withColumn("_place", place).join(F.broadcast(wanted), "_place", "left_semi").drop("_place")


def key_names(keys):
    return [f"key_{name}" for name in keys]


def key_columns(keys, values=None):
    """Each key as a text that is never null and that only equal keys share.

    Null keys then meet like others, and plain equality lets a join use how the
    stored keys are bucketed. ``values``: what keys are that are not columns yet.
    """
    values = [(values or {}).get(name, F.col(name)).cast("string") for name in keys]
    return [
        F.when(value.isNull(), "n").otherwise(F.concat(F.lit("v"), value)).alias(alias)
        for value, alias in zip(values, key_names(keys))
    ]


def in_range(stored, new, column):
    """The rows of ``stored`` whose ``column`` is within the range it has in ``new``.

    The two ends enter as literals, so the scan of a table sorted by ``column``
    skips whole files and row groups.
    """
    low, high = new.agg(F.min(column), F.max(column)).first()
    return stored.filter(F.col(column).between(F.lit(low), F.lit(high)))


def unknown_keys(stored_keys, new, keys, values=None):
    """Rows of ``new``, with their key columns, whose key is not among ``stored_keys``.

    Only ``new`` is moved where the stored keys are bucketed by all key columns.
    """
    return new.select("*", *key_columns(keys, values)).join(stored_keys, key_names(keys), "left_anti")


def _match(keys, null_safe=False):
    sides = [(F.col(f"old.{k}"), F.col(f"new.{k}")) for k in keys]
    return reduce(and_, [a.eqNullSafe(b) if null_safe else a == b for a, b in sides])


def with_surrogate_key(rows, name, highest):
    """Add unique ids above ``highest``; like a sequence, they have gaps."""
    return rows.withColumn(name, F.lit(highest + 1) + F.monotonically_increasing_id())


def anonymous_customer(spark):
    """The customer every store starts with: no country, flagged anonymous."""
    return spark.range(1).select(
        F.lit(ANONYMOUS).alias("customer_id"),
        F.lit(None).cast("string").alias("country"),
        F.lit(True).alias("is_anonymous"),
    )
