"""One query per operator, over the given tables.

Operators that come before the load read the feed directly; the others read
the staged tables and the star schema that a load of the feed leaves behind.
"""

from functools import reduce

from pyspark.sql import functions as F

from ledgerloom.constants import ANONYMOUS, FEED_COLUMNS, HISTORY_SOURCE
from ledgerloom.functions import (
    null_tokens,
    parse_number,
    parse_timestamp,
    strip,
    title_case,
)
from ledgerloom import sources
from ledgerloom.operators import catalogue, checks, merge, metrics, star
from ledgerloom.operators.percentile import RANK_ERROR
from ledgerloom.operators.cleanse import normalise_code, normalise_customer
from ledgerloom.operators.route import accepted, reject_entries, rejected
from ledgerloom.plans import business, transform

from .feed import feed, united_frames
from .extracts import broken_extract, many_sheets
from .loaded import RUN_DATE, loaded, loaded_twice
from .oracles import NUMBER_TEXTS, TOKEN_TEXTS



def _comparable(rows):
    """Decimals as doubles and small integers widened, as the SQL returns them."""

    def plain(name, kind):
        if kind.startswith("decimal"):
            return F.col(name).cast("double").alias(name)
        if kind == "smallint":
            return F.col(name).cast("int").alias(name)
        if kind == "timestamp":
            return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)
        return F.col(name)

    return rows.select(*[plain(name, kind) for name, kind in rows.dtypes])


def _lines(spark, folder):
    return spark.read.parquet(f"{folder}/lineitem.parquet")


def _picked(spark, folder, texts):
    """One of ``texts`` for every order line."""
    chosen = F.pmod(F.col("l_orderkey") + F.col("l_linenumber"), F.lit(len(texts)))
    options = F.array(*[F.lit(t) for t in texts])
    return _lines(spark, folder).select(F.get(options, chosen.cast("int")).alias("text"))


# Before the load -------------------------------------------------------------


def feed_union(spark, folder):
    return united_frames(spark, folder)


def null_token_texts(spark, folder):
    counted = _picked(spark, folder, TOKEN_TEXTS).groupBy("text").agg(F.count("*").alias("n"))
    value = null_tokens(F.col("text"))
    return counted.select(
        "text", value.alias("value"), F.coalesce(value, F.lit("missing")).alias("filled"), "n"
    )


def norm_code_title(spark, folder):
    rows = normalise_code(feed(spark, folder, ["invoice_no", "stock_code", "description"]))
    text = strip(F.coalesce("description", F.lit("")))
    return rows.select("invoice_no", "stock_code", title_case(text).alias("description"))


def parse_numbers(spark, folder):
    rows = feed(spark, folder, ["quantity", "unit_price"])
    both = rows.select(F.explode(F.array("quantity", "unit_price")).alias("text"))
    texts = both.unionByName(_picked(spark, folder, NUMBER_TEXTS))
    counted = texts.groupBy("text").agg(F.count("*").alias("n"))
    return counted.select("text", parse_number(F.col("text")).alias("value"), "n")


def parse_dates(spark, folder):
    rows = feed(spark, folder, ["invoice_no", "invoice_date"])
    moment = rows.select("invoice_no", parse_timestamp(F.col("invoice_date")).alias("invoice_date"))
    return _comparable(moment.withColumn("date_id", F.to_date("invoice_date")))


def customer_norm(spark, folder):
    rows = normalise_customer(feed(spark, folder, ["invoice_no", "customer_id"]))
    return rows.select(
        "invoice_no", "customer_id", (F.col("customer_id") == ANONYMOUS).alias("is_anonymous")
    )


def route_reasons(spark, folder):
    routed = transform.route(feed(spark, folder))
    return routed.select(
        "invoice_no", "stock_code", "_source", F.col("_reject_reason").alias("reject_reason")
    )


# Extracts, written from the given tables and read back ------------------------


def overlong_rows(spark, folder):
    """The lines of an extract that a read refuses."""
    found = sources.overlong_rows(spark, broken_extract(spark, folder, overlong=True))
    return found.select("line", F.col("fields").cast("int").alias("fields"), "expected")


def extract_read(spark, folder):
    """Two columns of an extract with short rows and separators in quotes."""
    rows = sources.read_sales(spark, broken_extract(spark, folder, overlong=False))
    return rows.select("invoice_no", "description", "country")


def sheet_counts(spark, folder):
    """Rows of each of many sheets with two kinds of headers."""
    rows = sources.read_history(spark, many_sheets(spark, folder), name_sheets=True)
    counts = rows.groupBy(F.col("_sheet").alias("sheet"))
    return counts.agg(F.count("*").alias("n"), F.count("country").alias("with_country"))


# Load results ----------------------------------------------------------------


def canonical_description(spark, folder):
    routed = loaded(spark, folder).routed
    named = catalogue.with_canonical(routed, catalogue.canonical_descriptions(routed))
    return named.select("invoice_no", "stock_code", "description")


def dedup_priority(spark, folder):
    kept = transform.keep(loaded(spark, folder).routed)
    return _comparable(
        kept.select(
            "invoice_no", "stock_code", "_source", "quantity", "unit_price", "customer_id",
            "country", "invoice_date",
        )
    )


def split_revenue(spark, folder):
    load = loaded(spark, folder)
    rows = catalogue.with_canonical(load.kept, load.names.drop("accepted"))
    both = star.sales_of(rows).unionByName(star.returns_of(rows), allowMissingColumns=True)
    return both.select(
        "invoice_no", "stock_code", "transaction_type", "description", "date_id",
        "gross_revenue", "return_amount",
    )


def reject_rows(spark, folder):
    """The audit log, its JSON unpacked again."""
    log = loaded(spark, folder).tables["reject_log"]
    fields = (
        "description string, quantity double, invoice_date timestamp, unit_price double, "
        "customer_id string, country string"
    )
    row = F.from_json("raw_data", fields)
    unpacked = log.select(
        "source", "raw_invoice_no", "raw_product_code", "reject_reason",
        F.col("pipeline_run_date").alias("run_date"), row.alias("row"),
    )
    return _comparable(unpacked.select("*", "row.*").drop("row"))


def run_metrics(spark, folder):
    load = loaded(spark, folder)
    return metrics.run_metrics(load.routed, load.kept)


def category_assign(spark, folder):
    products = loaded(spark, folder).tables["dim_products"]
    names = products.select(F.col("canonical_name").alias("description"))
    return catalogue.assign_categories(names).withColumnRenamed("description", "canonical_name")


def category_histogram(spark, folder):
    load = loaded(spark, folder)
    return catalogue.category_histogram(load.kept, load.tables["dim_products"])


def dim_products(spark, folder):
    return catalogue.build_products(loaded(spark, folder).routed)


def dim_customers(spark, folder):
    return loaded(spark, folder).tables["dim_customers"].drop("created_at")


def dim_date(spark, folder):
    return _comparable(star.build_dates(loaded(spark, folder).kept))


def fact_transactions(spark, folder):
    return _comparable(star.build_fact(loaded(spark, folder).kept))


def daily_revenue(spark, folder):
    fact = star.build_fact(loaded(spark, folder).kept)
    return _daily_comparable(star.build_daily_revenue(fact))


def _daily_comparable(daily):
    counts = {c: F.col(c).cast("bigint") for c in ("total_sales_qty", "total_return_qty")}
    return _comparable(daily.withColumns(counts))


# Merges: a store that was loaded with the history alone, then with both -------


def _history(load):
    """Staged routed and kept rows of an earlier load of the history feed."""
    routed = load.routed.filter(F.col("_source") == HISTORY_SOURCE)
    return routed, transform.keep(routed)


def _stored_customers(spark, kept):
    """Customers of a first load: the seeded row is there before any other."""
    fresh = star.build_customers(kept).filter(F.col("customer_id") != ANONYMOUS)
    return merge.anonymous_customer(spark).unionByName(fresh)


def merge_upsert_products(spark, folder):
    load = loaded(spark, folder)

    def at_load(rows, number):
        return rows.withColumns(
            {"created_by_load": F.lit(number), "updated_by_load": F.lit(number)}
        )

    stored = at_load(catalogue.build_products(_history(load)[0]), 1)
    fresh = at_load(catalogue.build_products(load.routed), 2)
    update = ["canonical_name", "category", "updated_by_load"]
    return merge.upsert(stored, fresh, ["product_code"], update)


def _inserted(stored, fresh, keys):
    new = merge.absent_rows(stored, fresh, keys).withColumn("load_no", F.lit(2))
    return stored.withColumn("load_no", F.lit(1)).unionByName(new)


def merge_insert_customers(spark, folder):
    load = loaded(spark, folder)
    stored = _stored_customers(spark, _history(load)[1])
    return _inserted(stored, star.build_customers(load.kept), ["customer_id"])


def merge_insert_dates(spark, folder):
    load = loaded(spark, folder)
    stored, fresh = [star.build_dates(kept) for kept in (_history(load)[1], load.kept)]
    return _comparable(_inserted(stored, fresh, ["date_id"]))


def _merged_facts(load):
    stored, fresh = [star.build_fact(kept) for kept in (_history(load)[1], load.kept)]
    return _inserted(stored, fresh, ["invoice_no", "product_code", "source"])


def merge_insert_facts(spark, folder):
    return _comparable(_merged_facts(loaded(spark, folder)))


def agg_refresh(spark, folder):
    return _daily_comparable(star.build_daily_revenue(_merged_facts(loaded(spark, folder))))


def store_insert_facts(spark, folder):
    """As ``merge_insert_facts``, but through the store: two loads, and what they published."""
    facts = loaded_twice(spark, folder).facts_by_load()
    return _comparable(facts.drop("transaction_id", "loaded_at", "month_id"))


def store_upsert_products(spark, folder):
    """As ``merge_upsert_products``, but through the store: parts of products after two loads."""
    products = loaded_twice(spark, folder).read("dim_products")
    kept_date = F.col("created_at") < F.col("updated_at")
    return products.select("product_code", "canonical_name", "category", kept_date.alias("updated_later"))


def store_agg_refresh(spark, folder):
    """As ``agg_refresh``, but through the store: sums of the first load, and the second's added."""
    daily = loaded_twice(spark, folder).read("agg_daily_revenue").drop("updated_at", "month_id")
    return _daily_comparable(daily)


def reject_append(spark, folder):
    load = loaded(spark, folder)
    first = reject_entries(rejected(_history(load)[0]), "2024-01-01")
    second = reject_entries(rejected(load.routed), "2024-01-02")
    log = first.unionByName(second)
    return log.groupBy(
        F.col("pipeline_run_date").alias("run_date"), "source", "reject_reason"
    ).agg(F.count("*").alias("n"))


# Checks ------------------------------------------------------------------------


def check_keys(spark, folder):
    rows = normalise_customer(accepted(loaded(spark, folder).routed))
    return checks.duplicate_keys(rows, ["invoice_no", "stock_code"])


def check_fk(spark, folder):
    """Facts of both feeds against the dimensions of the history alone."""
    load = loaded(spark, folder)
    routed, kept = _history(load)
    fact = star.build_fact(load.kept)
    parents = {
        "product_code": catalogue.build_products(routed),
        "customer_id": _stored_customers(spark, kept),
        "date_id": star.build_dates(kept),
    }
    found = [
        checks.orphan_keys(fact, column, parent).select(
            F.lit(column).alias("rule"), F.col(column).cast("string").alias("value"), "n"
        )
        for column, parent in parents.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), found)


def gate_violations(spark, folder):
    """What the gate of a load would refuse: facts of both feeds against the dimensions of the history, and repeated keys."""
    load = loaded(spark, folder)
    routed, kept = _history(load)
    fact = star.build_fact(load.kept)
    parents = {
        "product_code": (catalogue.build_products(routed), "product_code"),
        "customer_id": (_stored_customers(spark, kept), "customer_id"),
        "date_id": (star.build_dates(kept), "date_id"),
    }
    return checks.key_violations(fact, ["invoice_no", "customer_id"], parents)


def check_nulls(spark, folder):
    rows = loaded(spark, folder).routed
    spelled = rows.withColumn("spelling", F.nullif(strip(F.col("description")), F.lit("")))
    columns = [
        "invoice_no", "spelling", "quantity", "invoice_date", "unit_price", "customer_id",
        "country",
    ]
    return checks.violations(spelled, checks.null_rules(columns))


def check_range_length(spark, folder):
    rows = loaded(spark, folder).routed
    ranges = {"unit_price": "decimal(5,2)", "quantity": "decimal(3,2)"}
    lengths = {"invoice_no": 4, "stock_code": 5, "country": 8}
    return checks.violations(rows, checks.range_rules(ranges) | checks.length_rules(lengths))


# Business questions --------------------------------------------------------------


def _question(ask):
    def query(spark, folder):
        return _comparable(ask(loaded(spark, folder).tables))

    return query


def q6b_variants(spark, folder):
    load = loaded(spark, folder)
    variants = catalogue.description_variants(load.routed, load.tables["dim_products"])
    return business.q6b_variants(variants)


# Invoices within five standard errors of a sketch, which all but surely holds.
NEAR = 5 * star.SKETCH_ERROR


def _near(sketched, exact, keys):
    """The sketched answer, its invoices replaced by whether they are near the exact ones."""
    other = exact.select(*keys, F.col("num_facturas").alias("exact"))
    close = F.abs(F.col("num_facturas") - F.col("exact")) <= F.ceil(NEAR * F.col("exact"))
    invoice = [c for c in sketched.columns if c.endswith("factura")]
    return sketched.join(other, keys).withColumn("facturas_cerca", close).drop("exact", "num_facturas", *invoice)


def q4_countries_sketch(spark, folder):
    mart = loaded_twice(spark, folder)
    sketched = business.q4_countries_sketch(mart.read("agg_daily_invoices"))
    return _comparable(_near(sketched, business.q4_countries(mart.tables()), ["country"]))


def q5_customer_segments_sketch(spark, folder):
    mart = loaded_twice(spark, folder)
    sketched = business.q5_customer_segments_sketch(mart.read("agg_daily_invoices"))
    return _comparable(_near(sketched, business.q5_customer_segments(mart.tables()), ["is_anonymous"]))


def q7_limits_sketch(spark, folder):
    """Whether the ranks of the sketched limits are as near as promised: (limit, rows, near)."""
    tables = loaded(spark, folder).tables
    limits = business.q7_limits_sketch(tables)
    names = limits.columns
    # One pass over the totals for both limits, whose sketches are made from the same sums.
    limit = limits.select(F.struct(*[F.col(name).cast("double").alias(name) for name in names])).scalar()
    values = {name: F.col(name).cast("double") for name in names}
    counts = [F.count_if(value < limit[name]).alias(f"below_{name}") for name, value in values.items()]
    counts += [F.count_if(value <= limit[name]).alias(f"upto_{name}") for name, value in values.items()]
    found = business._review_totals(tables, 10).agg(F.count("*").alias("rows"), *counts)
    slack = F.ceil(RANK_ERROR * F.col("rows")) + 1

    def checked(name):
        near = (F.col(f"below_{name}") <= 0.75 * F.col("rows") + slack) & (F.col(f"upto_{name}") >= 0.75 * F.col("rows") - slack)
        return F.struct(F.lit(name).alias("limite"), "rows", near.alias("near"))

    return found.select(F.inline(F.array(*[checked(name) for name in names])))


QUERIES = {
    "feed_union": feed_union,
    "null_tokens": null_token_texts,
    "norm_code_title": norm_code_title,
    "parse_numbers": parse_numbers,
    "parse_dates": parse_dates,
    "canonical_description": canonical_description,
    "customer_norm": customer_norm,
    "route_reasons": route_reasons,
    "reject_rows": reject_rows,
    "run_metrics": run_metrics,
    "dedup_priority": dedup_priority,
    "split_revenue": split_revenue,
    "category_assign": category_assign,
    "category_histogram": category_histogram,
    "dim_products": dim_products,
    "dim_customers": dim_customers,
    "dim_date": dim_date,
    "fact_transactions": fact_transactions,
    "daily_revenue": daily_revenue,
    "merge_upsert_products": merge_upsert_products,
    "merge_insert_customers": merge_insert_customers,
    "merge_insert_dates": merge_insert_dates,
    "merge_insert_facts": merge_insert_facts,
    "agg_refresh": agg_refresh,
    "reject_append": reject_append,
    "overlong_rows": overlong_rows,
    "extract_read": extract_read,
    "sheet_counts": sheet_counts,
    "store_insert_facts": store_insert_facts,
    "store_agg_refresh": store_agg_refresh,
    "store_upsert_products": store_upsert_products,
    "gate_violations": gate_violations,
    "q4_countries_sketch": q4_countries_sketch,
    "q5_customer_segments_sketch": q5_customer_segments_sketch,
    "q7_limits_sketch": q7_limits_sketch,
    "check_keys": check_keys,
    "check_fk": check_fk,
    "check_nulls": check_nulls,
    "check_range_length": check_range_length,
    **{name: _question(ask) for name, ask in business.QUESTIONS.items()},
    "q6b_variants": q6b_variants,
}
