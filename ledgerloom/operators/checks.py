"""The table constraints, as queries that return what breaks them."""

from functools import reduce

from pyspark.sql import functions as F

from ..schemas import MONEY, PRICE, TEXT_LENGTHS, required_columns


def duplicate_keys(rows, keys):
    """Keys that occur more than once; keys with a null never clash."""
    whole = rows.dropna(how="any", subset=list(keys))
    return whole.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def orphan_keys(rows, column, parent, parent_key=None):
    """Values of ``column`` without a parent row, and how often they occur.

    Collapsed to distinct values before the join, so hot values do not skew it.
    """
    used = rows.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    known = parent.select(F.col(parent_key or column).alias(column))
    return used.join(known, column, "left_anti")


def count_failures(rules):
    """One counting column per rule; a rule is a condition that is true on failure."""
    return [F.count_if(failed).alias(name) for name, failed in rules.items()]


def violations(rows, rules):
    """(rule, violations), one row per rule, from one pass over ``rows``."""
    return rows.agg(*count_failures(rules)).unpivot([], list(rules), "rule", "violations")


def null_rules(columns):
    return {c: F.col(c).isNull() for c in columns}


def range_rules(types):
    """Numbers that do not fit the type of their column."""
    return {
        c: F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull() for c, kind in types.items()
    }


def length_rules(lengths):
    return {c: F.length(c) > n for c, n in lengths.items()}


def table_rules(table):
    """Null and length rules of a stored table."""
    nulls = {f"null:{c}": t for c, t in null_rules(required_columns(table)).items()}
    return nulls | {f"length:{c}": t for c, t in length_rules(TEXT_LENGTHS[table]).items()}


def fact_rules(kept):
    """What the fact table demands of the rows about to be loaded."""
    names = {"stock_code": "product_code", "_source": "source"}
    required = required_columns("fact_transactions")
    lengths = TEXT_LENGTHS["fact_transactions"]
    rules = {}
    for column in kept.columns:
        stored = names.get(column, column)
        if stored in required and stored != "gross_revenue":
            rules[f"null:{column}"] = F.col(column).isNull()
        if stored in lengths:
            rules[f"length:{column}"] = F.length(column) > lengths[stored]
    revenue = F.coalesce("gross_revenue", "return_amount")
    numbers = {
        "quantity": F.col("quantity").try_cast("int"),
        "unit_price": F.col("unit_price").try_cast(PRICE),
        "revenue": revenue.try_cast(MONEY),
    }
    return rules | {f"range:{name}": value.isNull() for name, value in numbers.items()}


def orphan_counts(rows, parents):
    """(rule, keys, rows): how many values of each column, in how many rows, have no parent.

    ``parents`` maps a column to (frame, key column). Each column is read alone
    and collapses to its distinct values before these become texts; all of them
    meet the parents' keys in one join. A null has no parent to look for.
    """
    def entry(column, name):
        return [F.lit(f"orphan:{column}").alias("rule"), F.col(name).cast("string").alias("value")]

    def stacked(frames):
        return reduce(lambda a, b: a.unionByName(b), frames)

    used = stacked(
        rows.select(c).groupBy(c).agg(F.count("*").alias("n")).select(*entry(c, c), "n") for c in parents
    ).filter("value IS NOT NULL")
    known = stacked(frame.select(*entry(column, key)) for column, (frame, key) in parents.items())
    orphans = used.join(known, ["rule", "value"], "left_anti")
    return orphans.groupBy("rule").agg(F.count("*").alias("keys"), F.sum("n").alias("rows"))


def key_violations(rows, unique, parents):
    """``orphan_counts`` and, as one more rule, the keys of ``rows`` that occur more than once."""
    twice = duplicate_keys(rows, unique).agg(F.count("*").alias("keys"), F.sum("n").alias("rows"))
    twice = twice.filter("keys > 0").select(F.lit(f"duplicate:{','.join(unique)}").alias("rule"), "*")
    return orphan_counts(rows, parents).unionByName(twice)
