"""Table schemas and the rules each table promises to keep."""

from pyspark.sql import types as T

from .constants import FEED_COLUMNS

PRICE = T.DecimalType(10, 4)
MONEY = T.DecimalType(14, 4)


def _table(*fields):
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


FEED = _table(*[(name, T.StringType()) for name in FEED_COLUMNS + ["_source"]])

DIM_PRODUCTS = _table(
    ("product_code", T.StringType()),
    ("canonical_name", T.StringType()),
    ("category", T.StringType()),
    ("is_active", T.BooleanType()),
    ("created_at", T.TimestampType()),
    ("updated_at", T.TimestampType()),
)

DIM_CUSTOMERS = _table(
    ("customer_id", T.StringType()),
    ("country", T.StringType()),
    ("is_anonymous", T.BooleanType()),
    ("created_at", T.TimestampType()),
)

DIM_DATE = _table(
    ("date_id", T.DateType()),
    ("year", T.ShortType()),
    ("quarter", T.ShortType()),
    ("month", T.ShortType()),
    ("month_name", T.StringType()),
    ("week", T.ShortType()),
    ("day", T.ShortType()),
    ("day_of_week", T.ShortType()),
    ("is_weekend", T.BooleanType()),
)

FACT_TRANSACTIONS = _table(
    ("transaction_id", T.LongType()),
    ("invoice_no", T.StringType()),
    ("product_code", T.StringType()),
    ("customer_id", T.StringType()),
    ("date_id", T.DateType()),
    ("invoice_date", T.TimestampType()),
    ("quantity", T.IntegerType()),
    ("unit_price", PRICE),
    ("gross_revenue", MONEY),
    ("transaction_type", T.StringType()),
    ("country", T.StringType()),
    ("source", T.StringType()),
    ("loaded_at", T.TimestampType()),
)

AGG_DAILY_REVENUE = _table(
    ("date_id", T.DateType()),
    ("product_code", T.StringType()),
    ("gross_revenue", MONEY),
    ("return_amount", MONEY),
    ("net_revenue", MONEY),
    ("total_sales_qty", T.IntegerType()),
    ("total_return_qty", T.IntegerType()),
    ("updated_at", T.TimestampType()),
)

# Optional, beside the daily sums: what counts invoices without reading facts.
AGG_DAILY_INVOICES = _table(
    ("date_id", T.DateType()),
    ("country", T.StringType()),
    ("is_anonymous", T.BooleanType()),
    ("lines", T.LongType()),
    ("gross_revenue", T.DecimalType(24, 4)),
    ("units", T.LongType()),
    ("invoices", T.BinaryType()),
)

REJECT_LOG = _table(
    ("reject_id", T.LongType()),
    ("source", T.StringType()),
    ("raw_invoice_no", T.StringType()),
    ("raw_product_code", T.StringType()),
    ("raw_data", T.StringType()),
    ("reject_reason", T.StringType()),
    ("pipeline_run_date", T.DateType()),
    ("logged_at", T.TimestampType()),
)

TABLES = {
    "dim_products": DIM_PRODUCTS,
    "dim_customers": DIM_CUSTOMERS,
    "dim_date": DIM_DATE,
    "fact_transactions": FACT_TRANSACTIONS,
    "agg_daily_revenue": AGG_DAILY_REVENUE,
    "reject_log": REJECT_LOG,
}

OPTIONAL_TABLES = {"agg_daily_invoices": AGG_DAILY_INVOICES}

UNIQUE_KEYS = {
    "dim_products": [["product_code"]],
    "dim_customers": [["customer_id"]],
    "dim_date": [["date_id"]],
    "fact_transactions": [["transaction_id"], ["invoice_no", "product_code", "source"]],
    "agg_daily_revenue": [["date_id", "product_code"]],
    "reject_log": [["reject_id"]],
}

FOREIGN_KEYS = {
    "fact_transactions": {
        "product_code": "dim_products",
        "customer_id": "dim_customers",
        "date_id": "dim_date",
    },
    "agg_daily_revenue": {"date_id": "dim_date", "product_code": "dim_products"},
}

NULLABLE = {
    "dim_products": [],
    "dim_customers": ["country"],
    "dim_date": [],
    "fact_transactions": ["country"],
    "agg_daily_revenue": [],
    "reject_log": ["raw_invoice_no", "raw_product_code", "raw_data"],
}

TEXT_LENGTHS = {
    "dim_products": {"product_code": 20, "canonical_name": 255, "category": 100},
    "dim_customers": {"customer_id": 20, "country": 100},
    "dim_date": {"month_name": 20},
    "fact_transactions": {
        "invoice_no": 20,
        "product_code": 20,
        "customer_id": 20,
        "transaction_type": 10,
        "country": 100,
        "source": 50,
    },
    "agg_daily_revenue": {"product_code": 20},
    "reject_log": {
        "source": 50,
        "raw_invoice_no": 50,
        "raw_product_code": 50,
        "reject_reason": 255,
    },
}


def required_columns(table):
    """Columns of ``table`` that must not be null."""
    return [f.name for f in TABLES[table] if f.name not in NULLABLE[table]]
