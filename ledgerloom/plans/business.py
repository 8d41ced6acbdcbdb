"""The business questions, over the tables of the star schema.

Every question takes ``tables``, a mapping from table name to frame. Measures
are summed per join key before a dimension is joined: the join then sees one
row per key, however hot the key. Ties are broken by product code.
"""

from pyspark.sql import functions as F

from ..constants import ANONYMOUS, ANONYMOUS_LABEL, IDENTIFIED_LABEL, SALE
from ..functions import percent, ratio
from ..operators.percentile import (
    SKETCH_K,
    percentile_in_plan,
    quantile_sketch,
    sketched_quantile,
)

MEASURES = [
    "gross_revenue",
    "return_amount",
    "net_revenue",
    "total_sales_qty",
    "total_return_qty",
]


def _sums(*names):
    return [F.sum(name).alias(name) for name in names]


def _money(name):
    return F.round(name, 2)


def q1_monthly_net(tables):
    """Gross, returns, net and units per month."""
    daily = tables["agg_daily_revenue"].groupBy("date_id").agg(*_sums(*MEASURES[:4]))
    return (
        daily.join(tables["dim_date"], "date_id")
        .groupBy("year", "month", "month_name")
        .agg(
            _money(F.sum("gross_revenue")).alias("ventas_brutas"),
            _money(F.sum("return_amount")).alias("devoluciones"),
            _money(F.sum("net_revenue")).alias("ventas_netas"),
            F.sum("total_sales_qty").alias("unidades_vendidas"),
        )
        .orderBy("year", "month")
    )


def product_totals(tables, *measures):
    """Measures per product, with its name and category."""
    totals = tables["agg_daily_revenue"].groupBy("product_code").agg(*_sums(*measures))
    names = tables["dim_products"].select("product_code", "canonical_name", "category")
    return totals.join(names, "product_code")


def q2_category_returns(tables):
    """Gross revenue, returns and return rate per category."""
    totals = product_totals(tables, "gross_revenue", "return_amount")
    gross, back = F.sum("gross_revenue"), F.sum("return_amount")
    return (
        totals.groupBy("category")
        .agg(
            _money(gross).alias("revenue_bruto"),
            _money(back).alias("total_devoluciones"),
            percent(back, gross).alias("tasa_devolucion_pct"),
        )
        .orderBy(F.desc("revenue_bruto"), "category")
    )


def q3a_top_net_revenue(tables, k=10):
    """Products with the highest net revenue."""
    return (
        product_totals(tables, "gross_revenue", "return_amount", "net_revenue")
        .select(
            "product_code",
            "canonical_name",
            "category",
            _money("gross_revenue").alias("revenue_bruto"),
            _money("return_amount").alias("devoluciones"),
            _money("net_revenue").alias("revenue_neto"),
        )
        .orderBy(F.desc("revenue_neto"), "product_code")
        .limit(k)
    )


def q3b_top_return_rate(tables, k=10, min_sold=10):
    """Products with the highest share of returned units."""
    return (
        product_totals(tables, "total_sales_qty", "total_return_qty")
        .filter(F.col("total_sales_qty") >= min_sold)
        .select(
            "product_code",
            "canonical_name",
            "category",
            F.col("total_sales_qty").alias("unidades_vendidas"),
            F.col("total_return_qty").alias("unidades_devueltas"),
            percent(F.col("total_return_qty"), F.col("total_sales_qty")).alias(
                "tasa_devolucion_pct"
            ),
        )
        .orderBy(F.desc("tasa_devolucion_pct"), "product_code")
        .limit(k)
    )


def _tickets(lines, revenue, line, invoice):
    """Invoices, lines, revenue and mean tickets of a group of fact lines.

    Spark counts distinct invoices after spreading rows by (group, invoice).
    """
    invoices = F.countDistinct("invoice_no")
    return [
        invoices.alias("num_facturas"),
        lines.alias("num_lineas"),
        _money(revenue).alias("revenue_total"),
        ratio(revenue, lines).alias(line),
        ratio(revenue, F.nullif(invoices, F.lit(0))).alias(invoice),
    ]


def q4_countries(tables):
    """Invoices, lines and mean tickets of sales per country."""
    tickets = _tickets(
        F.count("*"),
        F.sum("gross_revenue"),
        "ticket_promedio_por_linea",
        "ticket_promedio_por_factura",
    )
    return (
        tables["fact_transactions"]
        .filter((F.col("transaction_type") == SALE) & F.col("country").isNotNull())
        .groupBy("country")
        .agg(*tickets)
        .orderBy(F.desc("revenue_total"), "country")
    )


def q5_customer_segments(tables, salts=None):
    """Identified against anonymous customers.

    The anonymous customer holds a large part of all lines. Its dimension row
    is repeated per salt and its lines are spread over the salts by invoice:
    as many as there are shuffle partitions, if not given.
    """
    if salts is None:
        spark = tables["fact_transactions"].sparkSession
        salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    invoice_salt = F.pmod(F.xxhash64("invoice_no"), F.lit(salts)).cast("int")
    is_hot = F.col("customer_id") == ANONYMOUS
    lines = (
        tables["fact_transactions"]
        .filter(F.col("transaction_type") == SALE)
        .groupBy("customer_id", "invoice_no")
        .agg(
            F.count("*").alias("lines"),
            F.sum("gross_revenue").alias("revenue"),
            F.sum("quantity").alias("units"),
        )
        .withColumn("salt", F.when(is_hot, invoice_salt).otherwise(F.lit(0)))
    )
    every_salt = F.sequence(F.lit(0), F.when(is_hot, F.lit(salts - 1)).otherwise(F.lit(0)))
    customers = tables["dim_customers"].select(
        "customer_id", "is_anonymous", F.explode(every_salt).alias("salt")
    )
    count, revenue = F.sum("lines"), F.sum("revenue")
    segments = (
        lines.join(customers, ["customer_id", "salt"])
        .groupBy("is_anonymous")
        .agg(
            *_tickets(count, revenue, "ticket_promedio_linea", "ticket_promedio_factura"),
            ratio(F.sum("units"), count).alias("cantidad_promedio"),
        )
    )
    label = F.when(F.col("is_anonymous"), ANONYMOUS_LABEL).otherwise(IDENTIFIED_LABEL)
    measures = [c for c in segments.columns if c != "is_anonymous"]
    return segments.select("is_anonymous", label.alias("tipo_cliente"), *measures).orderBy(
        "is_anonymous"
    )


def q6a_product_count(tables):
    """Number of distinct product codes."""
    return tables["dim_products"].agg(
        F.countDistinct("product_code").alias("total_productos_unicos")
    )


def q6b_literal(tables, k=20):
    """Products with transactions; ``apariciones`` is always 1 by definition."""
    seen = (
        tables["fact_transactions"]
        .groupBy("product_code")
        .agg(F.countDistinct("product_code").alias("apariciones"), F.count("*").alias("n"))
        .filter("n > 0")
    )
    return (
        seen.join(tables["dim_products"], "product_code")
        .select("product_code", "canonical_name", "apariciones", "category")
        .orderBy(F.desc("apariciones"), "product_code")
        .limit(k)
    )


def q6b_variants(variants, k=20):
    """Products written in the most ways; see ``description_variants``."""
    return variants.orderBy(F.desc("variantes"), "product_code").limit(k)


RATE = "tasa_devolucion_pct"


def _review_totals(tables, min_sold):
    """Totals and return rate per product that sold enough."""
    totals = product_totals(tables, *MEASURES).filter(F.col("total_sales_qty") >= min_sold)
    return totals.withColumn(RATE, percent(F.col("total_return_qty"), F.col("total_sales_qty")))


def _exact(value):
    # Money and rates have two decimals, limits between two of them a few more.
    return value.cast("decimal(38,10)")


def _limits(totals, fraction):
    """The lowest revenue and return rate to review, as scalar subqueries of the plan."""
    money = totals.withColumn(RATE, F.col(RATE).cast("decimal(28,2)"))
    return {
        name: percentile_in_plan(money, name, fraction).select(_exact(F.col("value"))).scalar()
        for name in ("gross_revenue", RATE)
    }


def q7_limits(tables, min_sold=10, fraction=0.75):
    """The limits of ``q7_review_candidates``, in one row."""
    totals = _review_totals(tables, min_sold)
    limits = _limits(totals, fraction)
    return totals.sparkSession.range(1).select(
        *[value.cast("double").alias(name) for name, value in limits.items()]
    )


def q7_limits_sketch(tables, min_sold=10, fraction=0.75, k=SKETCH_K):
    """The limits up to the rank error of a sketch of size ``k``, from one pass over the totals."""
    names = ["gross_revenue", RATE]
    sketches = _review_totals(tables, min_sold).agg(*[quantile_sketch(name, k).alias(name) for name in names])
    return sketches.select(*[sketched_quantile(F.col(name), fraction).alias(name) for name in names])


def q7_review_candidates(tables, k=15, min_sold=10, fraction=0.75):
    """Top-quartile revenue and top-quartile return rate: candidates for review.

    A product exactly on a limit is one: limits are compared as decimals. No job
    runs before the answer is asked for.
    """
    chosen = _review_totals(tables, min_sold)
    for name, value in _limits(chosen, fraction).items():
        chosen = chosen.filter(_exact(F.col(name)) >= value)
    return (
        chosen.orderBy(F.desc("return_amount"), "product_code")
        .limit(k)
        .select(
            "product_code",
            "canonical_name",
            "category",
            _money("gross_revenue").alias("revenue_bruto"),
            _money("return_amount").alias("devoluciones"),
            _money("net_revenue").alias("revenue_neto"),
            RATE,
            F.col("total_sales_qty").alias("unidades_vendidas"),
            F.col("total_return_qty").alias("unidades_devueltas"),
        )
    )


# From stored invoice sketches, without reading facts --------------------------


def _sketch_tickets(line, invoice):
    invoices = F.hll_sketch_estimate(F.hll_union_agg("invoices"))
    return [
        invoices.alias("num_facturas"),
        F.sum("lines").alias("num_lineas"),
        _money(F.sum("gross_revenue")).alias("revenue_total"),
        ratio(F.sum("gross_revenue"), F.sum("lines")).alias(line),
        ratio(F.sum("gross_revenue"), F.nullif(invoices, F.lit(0))).alias(invoice),
    ]


def q4_countries_sketch(daily_invoices):
    """``q4_countries`` with invoices counted by merged sketches; all else is exact."""
    tickets = _sketch_tickets("ticket_promedio_por_linea", "ticket_promedio_por_factura")
    return (
        daily_invoices.filter(F.col("country").isNotNull())
        .groupBy("country")
        .agg(*tickets)
        .orderBy(F.desc("revenue_total"), "country")
    )


def q5_customer_segments_sketch(daily_invoices):
    """``q5_customer_segments`` with invoices counted by merged sketches; all else is exact."""
    tickets = _sketch_tickets("ticket_promedio_linea", "ticket_promedio_factura")
    units = ratio(F.sum("units"), F.sum("lines")).alias("cantidad_promedio")
    segments = daily_invoices.groupBy("is_anonymous").agg(*tickets, units)
    label = F.when(F.col("is_anonymous"), ANONYMOUS_LABEL).otherwise(IDENTIFIED_LABEL)
    measures = [c for c in segments.columns if c != "is_anonymous"]
    return segments.select("is_anonymous", label.alias("tipo_cliente"), *measures).orderBy("is_anonymous")


QUESTIONS = {
    "q1_monthly_net": q1_monthly_net,
    "q2_category_returns": q2_category_returns,
    "q3a_top_net_revenue": q3a_top_net_revenue,
    "q3b_top_return_rate": q3b_top_return_rate,
    "q4_countries": q4_countries,
    "q5_customer_segments": q5_customer_segments,
    "q6a_product_count": q6a_product_count,
    "q6b_literal": q6b_literal,
    "q7_limits": q7_limits,
    "q7_review_candidates": q7_review_candidates,
}
