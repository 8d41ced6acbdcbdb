"""Rows of the star schema."""

from pyspark.sql import functions as F

from ..constants import ANONYMOUS, RETURN, SALE
from ..functions import calendar_columns, month_id
from ..schemas import MONEY, PRICE
from .dedup import first_per_key, priority_rank
from .merge import key_part


def split_revenue(rows):
    """Add day, transaction type and unsigned revenue to accepted rows."""
    quantity, price = F.col("quantity"), F.col("unit_price")
    sold = quantity > 0
    return rows.withColumns(
        {
            "date_id": F.to_date("invoice_date"),
            "transaction_type": F.when(sold, SALE).otherwise(RETURN),
            "gross_revenue": F.when(sold, quantity * price),
            "return_amount": F.when(~sold, F.abs(quantity) * price),
        }
    )


def sales_of(rows):
    return rows.filter(F.col("transaction_type") == SALE).drop("return_amount")


def returns_of(rows):
    return rows.filter(F.col("transaction_type") == RETURN).drop("gross_revenue")


def build_customers(rows):
    """One row per customer with the first country seen, sales before returns."""
    order = [
        (F.col("transaction_type") == RETURN).asc(),
        priority_rank(F.col("_source")).asc_nulls_last(),
        *[
            F.col(name).asc_nulls_last()
            for name in ("invoice_date", "invoice_no", "stock_code", "country")
        ],
    ]
    return first_per_key(rows, ["customer_id"], order).select(
        "customer_id", "country", (F.col("customer_id") == ANONYMOUS).alias("is_anonymous")
    )


def build_dates(rows):
    days = rows.select("date_id").filter(F.col("date_id").isNotNull()).distinct()
    return days.select("date_id", *calendar_columns(F.col("date_id")))


def fact_values(null_invoice_text=None):
    """Columns of a fact, by name, over kept rows; see ``build_fact``."""
    invoice = F.col("invoice_no")
    if null_invoice_text is not None:
        invoice = F.coalesce(invoice, F.lit(null_invoice_text))
    revenue = F.coalesce(F.col("gross_revenue"), -F.col("return_amount"))
    return {
        "invoice_no": invoice,
        "product_code": F.col("stock_code"),
        "customer_id": F.col("customer_id"),
        "date_id": F.col("date_id"),
        "invoice_date": F.col("invoice_date"),
        # Truncated towards zero; the revenue uses the full quantity.
        "quantity": F.col("quantity").try_cast("int"),
        "unit_price": F.col("unit_price").try_cast(PRICE),
        "gross_revenue": revenue.try_cast(MONEY),
        "transaction_type": F.col("transaction_type"),
        "country": F.col("country"),
        "source": F.col("_source"),
    }


def build_fact(rows, null_invoice_text=None):
    """Fact rows without surrogate key and load time.

    Revenue is negative for returns, so that its sum is the net. A number that
    does not fit its column becomes null, which the checks report. A missing
    invoice number stays null unless ``null_invoice_text`` is given.
    """
    return rows.select(*[value.alias(name) for name, value in fact_values(null_invoice_text).items()])


def build_fact_from_split(sales, returns, null_invoice_text=None):
    """As ``build_fact``, from separate frames of sales and returns."""
    return build_fact(sales.unionByName(returns, allowMissingColumns=True), null_invoice_text)


SUMS = {
    "gross_revenue": MONEY,
    "return_amount": MONEY,
    "net_revenue": MONEY,
    "total_sales_qty": "int",
    "total_return_qty": "int",
}


def _share_values():
    """What a fact adds to the sums of its day and product; returns count with their absolute value."""
    sale = F.col("transaction_type") == SALE
    back = F.col("transaction_type") == RETURN
    revenue, quantity = F.col("gross_revenue"), F.col("quantity")

    def share(condition, value):
        return F.when(condition, value).otherwise(F.lit(0))

    return {
        "gross_revenue": share(sale, revenue),
        "return_amount": share(back, F.abs(revenue)),
        "net_revenue": revenue,
        "total_sales_qty": share(sale, quantity),
        "total_return_qty": share(back, F.abs(quantity)),
    }


def daily_shares(fact):
    """The shares of each fact, with its day and product."""
    return fact.select("date_id", "product_code", *[v.alias(name) for name, v in _share_values().items()])


def _summed(shares, *others, dealt=()):
    totals = [F.sum(name).cast(kind).alias(name) for name, kind in SUMS.items()]
    return shares.groupBy(*dealt, "date_id", "product_code").agg(*totals, *others).drop(*dealt)


def build_daily_revenue(fact):
    """Daily sums per product."""
    return _summed(daily_shares(fact))


def merge_daily_revenue(stored, new, now=None, parts=None):
    """Stored daily sums plus those of new facts, in one aggregation.

    Sums add up, so facts that are summed already need not be read again.
    ``now`` becomes the ``updated_at`` of days and products with new facts.

    With ``parts``, rows meet by month and by one of so many parts of the
    products: what is then written by month lies together and is not moved
    again. Facts become shares behind that shuffle, as they are narrower.
    """
    updated = [] if now is None else [F.max("updated_at").alias("updated_at")]
    if parts is not None:
        both, dealt = _dealt(stored, new, now, parts)
        return _summed(both, *updated, dealt=dealt)
    shares = daily_shares(new)
    if now is None:
        return _summed(stored.select(*shares.columns).unionByName(shares))
    both = stored.select(*shares.columns, "updated_at").unionByName(shares.withColumn("updated_at", now))
    return _summed(both, *updated)


def _dealt(stored, new, now, parts):
    """(shares of both, columns by which they were dealt)."""
    old = stored.select("date_id", "product_code", F.struct(*SUMS, *([] if now is None else ["updated_at"])).alias("_sums"))
    fresh = new.select("date_id", "product_code", "gross_revenue", "transaction_type", "quantity")
    both = fresh.unionByName(old, allowMissingColumns=True)
    dealt = {"_month": month_id(F.col("date_id")), "_part": key_part(["product_code"], parts)}
    both = both.withColumns(dealt).repartition(*dealt)
    values = _share_values() | ({} if now is None else {"updated_at": now})
    summed = F.col("_sums").isNotNull()
    shares = [F.when(summed, F.col(f"_sums.{name}")).otherwise(value).alias(name) for name, value in values.items()]
    return both.select(*dealt, "date_id", "product_code", *shares), list(dealt)


# Relative standard error of a distinct count from a sketch of 2^12 registers: 1.04 / 2^6.
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def build_daily_invoices(fact):
    """Sales per day, country and kind of customer, with a mergeable sketch of their invoices."""
    anonymous = (F.col("customer_id") == ANONYMOUS).alias("is_anonymous")
    return (
        fact.filter(F.col("transaction_type") == SALE)
        .groupBy("date_id", "country", anonymous)
        .agg(
            F.count("*").alias("lines"),
            F.sum("gross_revenue").alias("gross_revenue"),
            F.sum("quantity").alias("units"),
            F.hll_sketch_agg("invoice_no", F.lit(SKETCH_BITS)).alias("invoices"),
        )
    )


def merge_daily_invoices(stored, delta):
    """Sums add up and sketches of the same size unite; neither needs the facts again."""
    return (
        stored.select(*delta.columns)
        .unionByName(delta)
        .groupBy("date_id", "country", "is_anonymous")
        .agg(
            F.sum("lines").alias("lines"),
            F.sum("gross_revenue").cast("decimal(24,4)").alias("gross_revenue"),
            F.sum("units").alias("units"),
            F.hll_union_agg("invoices").alias("invoices"),
        )
    )
