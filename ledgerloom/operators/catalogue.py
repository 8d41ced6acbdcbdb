"""Canonical product names and categories."""

import re

from pyspark.sql import functions as F

from ..constants import CATEGORY_KEYWORDS, UNCATEGORIZED, UNKNOWN
from ..functions import blank_to_null, strip, title_case


def spellings(rows):
    """Rows per product and description as written; ``accepted`` if any row is.

    This is the only pass over all rows: it collapses them before the shuffle,
    so title-casing and what follows see each spelling once.
    """
    usable = F.col("_reject_reason").isNull() if "_reject_reason" in rows.columns else F.lit(True)
    return (
        rows.select(
            "stock_code",
            blank_to_null(strip(F.col("description"))).alias("spelling"),
            usable.alias("accepted"),
        )
        .groupBy("stock_code", "spelling")
        .agg(F.count("*").alias("n"), F.bool_or("accepted").alias("accepted"))
    )


def _most_frequent(spelled):
    """Per product the commonest title-cased name; the smallest one on ties.

    Two steps, so that no task ever holds all names of one product.
    """
    named = (
        spelled.withColumn("name", title_case(F.col("spelling")))
        .groupBy("stock_code", "name")
        .agg(F.sum("n").alias("n"), F.bool_or("accepted").alias("accepted"))
    )
    best = F.min_by("name", F.struct(F.col("name").isNull(), -F.col("n"), F.col("name")))
    return named.groupBy("stock_code").agg(
        best.alias("description"), F.bool_or("accepted").alias("accepted")
    )


def canonical_descriptions(rows):
    """(stock_code, description) for every product that has any description."""
    described = spellings(rows).filter(F.col("spelling").isNotNull())
    return _most_frequent(described).select("stock_code", "description")


def with_canonical(rows, canonical):
    """Replace ``description`` by the product's canonical one, else UNKNOWN."""
    return (
        rows.drop("description")
        .join(canonical, "stock_code", "left")
        .withColumn("description", F.coalesce("description", F.lit(UNKNOWN)))
    )


def category_of(description, keywords=CATEGORY_KEYWORDS):
    """First category with a keyword anywhere inside the description."""
    lowered = F.lower(description)
    category = F.when(F.upper(description).isin("", UNKNOWN), UNCATEGORIZED)
    for name, words in keywords.items():
        category = category.when(lowered.rlike("|".join(map(re.escape, words))), name)
    return category.otherwise(UNCATEGORIZED)


def assign_categories(rows, keywords=CATEGORY_KEYWORDS):
    return rows.withColumn("category", category_of(F.col("description"), keywords))


def category_histogram(rows, products):
    """Rows per transaction type and category, from rows without a category."""
    per_product = rows.groupBy("stock_code", "transaction_type").agg(F.count("*").alias("n"))
    return (
        per_product.join(products, F.col("stock_code") == F.col("product_code"))
        .groupBy("transaction_type", "category")
        .agg(F.sum("n").alias("n"))
    )


def choose_names(routed):
    """(stock_code, description, accepted) per product, from validated rows.

    Names are chosen over all rows, rejected ones too; ``accepted`` tells
    whether any row of the product is.
    """
    return _most_frequent(spellings(routed))


def products_from(names):
    """Products with an accepted row, named and categorised.

    Dropping duplicates never drops a product, so this needs neither the
    deduplicated rows nor a join with them.
    """
    chosen = names.filter("accepted").select(
        "stock_code", F.coalesce("description", F.lit(UNKNOWN)).alias("description")
    )
    return assign_categories(chosen).withColumnsRenamed(
        {"stock_code": "product_code", "description": "canonical_name"}
    )


def build_products(routed):
    return products_from(choose_names(routed))


def description_variants(rows, products):
    """Products written in more than one way, and in how many."""
    counted = (
        spellings(rows)
        .filter(F.col("spelling").isNotNull())
        .groupBy(F.col("stock_code").alias("product_code"))
        .agg(F.count("*").alias("variantes"))
        .filter("variantes > 1")
    )
    return counted.join(products, "product_code").select(
        "product_code", "canonical_name", "variantes", "category"
    )
