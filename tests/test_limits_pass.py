"""The sketched limits of the review question, in one pass."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerloom.plans import business


def test_both_sketched_limits_come_from_one_pass(spark):
    day = dt.date(2024, 1, 1)
    kinds = "gross_revenue decimal(14,4), return_amount decimal(14,4), net_revenue decimal(14,4), total_sales_qty int, total_return_qty int"
    daily = [(day, f"p{i}", Decimal(i), Decimal(0), Decimal(i), 20, i % 5) for i in range(100)]
    products = spark.range(100).select(F.concat(F.lit("p"), "id").alias("product_code"), F.lit("n").alias("canonical_name"), F.lit("c").alias("category"))
    tables = {"agg_daily_revenue": spark.createDataFrame(daily, f"date_id date, product_code string, {kinds}"), "dim_products": products}
    limits = business.q7_limits_sketch(tables)
    assert "scalar-subquery" not in limits._jdf.queryExecution().optimizedPlan().toString()
    [found] = limits.collect()
    assert 73 <= found.gross_revenue <= 76 and found.tasa_devolucion_pct == 15
    nothing = {name: frame.limit(0) for name, frame in tables.items()}
    assert business.q7_limits_sketch(nothing).count() == 1
