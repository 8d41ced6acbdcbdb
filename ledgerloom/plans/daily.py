"""The daily load: two extracts in, a refreshed star schema out."""

import logging
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..constants import ANONYMOUS, DATE_FORMATS, SOURCE_PRIORITY
from ..functions import month_id
from ..operators.catalogue import category_histogram, choose_names, products_from, with_canonical
from ..operators.checks import count_failures, fact_rules, orphan_counts
from ..operators.merge import (
    absent_rows,
    changed_rows,
    in_range,
    key_columns,
    key_names,
    unknown_keys,
    with_surrogate_key,
)
from ..operators.metrics import run_metrics, sheet_counts
from ..operators.route import reject_entries, rejected
from ..operators.star import (
    build_customers,
    build_daily_invoices,
    build_daily_revenue,
    build_dates,
    build_fact,
    fact_values,
    merge_daily_invoices,
    merge_daily_revenue,
    split_revenue,
)
from ..schemas import FOREIGN_KEYS, UNIQUE_KEYS
from ..session import configure
from ..sinks import Mart
from ..sinks.mart import DAILY, STORED
from ..sources import read_history, read_sales, unify
from .transform import keep, route

log = logging.getLogger(__name__)

FACT_KEY = ["invoice_no", "product_code", "source"]
STAGED = ["routed", "kept", "names", "new_rows", "products"]
# Columns that ``split_revenue`` adds.
REVENUE = ["date_id", "transaction_type", "gross_revenue", "return_amount"]


class ConstraintError(ValueError):
    """The new rows break a constraint of the fact table."""


@dataclass(frozen=True)
class LoadConfig:
    """Where a load reads and writes, and the choices it makes.

    ``rejects``: "append" logs rejects again on a rerun, "replace" swaps the
    run's own. ``strict``: stop before loading rows that break a constraint.
    ``keep_staging``: leave the run's staged tables after a load that succeeded
    (those of a load that failed always stay).
    """

    data_root: str
    mart_root: str
    sales_name: str = "sales.csv"
    history_name: str = "history"
    date_formats: list = field(default_factory=lambda: list(DATE_FORMATS))
    priority: list = field(default_factory=lambda: list(SOURCE_PRIORITY))
    fact_key: list = field(default_factory=lambda: list(FACT_KEY))
    null_invoice_text: str | None = None
    rejects: str = "append"
    strict: bool = True
    refresh_all_days: bool = False
    keep_staging: bool = False
    # Stamp every product of the feed as updated; otherwise only products that are new or changed are written.
    restamp_products: bool = True
    # Also keep invoice sketches per day, so that invoices are counted without reading facts.
    invoice_sketches: bool = False
    # Files over which the keys of all facts are spread; fixed once a store has been loaded.
    key_buckets: int = 64
    # Options of ``read_extract``: encoding, multiline.
    reader: dict = field(default_factory=dict)

    def __post_init__(self):
        if not set(FACT_KEY[:2]) <= set(self.fact_key):
            raise ValueError(f"fact_key must contain {FACT_KEY[:2]}: rows are unique by them")

    def input(self, name):
        return f"{self.data_root.rstrip('/')}/{name}"

    def staging(self, name, run_date):
        return f"{self.mart_root.rstrip('/')}/_staging/{name}/run={run_date}"


def run_daily_load(spark, config, run_date):
    """Load one day's extracts and return the run's row counts."""
    sales = read_sales(spark, config.input(config.sales_name), **config.reader)
    history = read_history(spark, config.input(config.history_name), name_sheets=True, **config.reader)
    return load_feed(spark, unify([sales, history]), config, run_date)


def load_feed(spark, feed, config, run_date):
    """Load a unified feed; safe to repeat.

    A rerun changes no table (rejects: see ``LoadConfig``). Staged tables cut
    the lineage: text is read and parsed once, rows are deduplicated once and
    names chosen once, and everything else reads those tables. What does not
    depend on each other is loaded at the same time; facts follow their
    dimensions. Facts, their keys and the daily sums become visible together,
    at the end: a load that is lost before that adds nothing to them, and its
    repetition starts from the same stored rows.

    The counts are also kept in the store (``Mart.run_log``), with rows per
    history sheet, rows inserted per table and products per category.
    """
    configure(spark)
    mart = Mart(spark, config.mart_root, config.key_buckets).create()
    number = mart.begin_load()
    return _load(mart, number, stage(feed, config, run_date), config, run_date)


def load_staged(spark, staged, config, run_date):
    """As ``load_feed``, from rows that ``stage`` or ``stage_routed`` has written, wherever they lie."""
    configure(spark)
    mart = Mart(spark, config.mart_root, config.key_buckets).create()
    return _load(mart, mart.begin_load(), staged, config, run_date)


def _load(mart, number, staged, config, run_date):
    rejects = with_canonical(rejected(staged.routed), staged.names.drop("accepted"))
    with ThreadPoolExecutor(4) as pool:
        jobs = {
            "dim_products": pool.submit(load_products, mart, staged.names, config, run_date),
            "dim_customers": pool.submit(load_customers, mart, staged.kept),
            "dim_date": pool.submit(load_dates, mart, staged.kept),
            "reject_log": pool.submit(load_rejects, mart, rejects, run_date, config.rejects),
        }
        written = {table: job.result() for table, job in jobs.items()}
    rows = new_rows(mart, staged.kept, config, run_date)
    new = build_fact(rows, config.null_invoice_text).select("*", *key_columns(config.fact_key))
    written["fact_transactions"], months = new.count(), []
    with ThreadPoolExecutor(5) as pool:
        counts = pool.submit(row_counts, staged)
        # Nothing of this is visible before the load is published, so the gate need not come first.
        jobs = []
        if written["fact_transactions"]:
            jobs = [
                pool.submit(check_parents, mart, new, config.strict),
                pool.submit(add_facts, mart, rows, config, number),
                pool.submit(add_keys, mart, new, key_names(config.fact_key), number, config.strict),
            ]
        if jobs or config.refresh_all_days:
            months = load_daily_revenue(mart, new, number, config.refresh_all_days)
        if config.invoice_sketches:
            load_daily_invoices(mart, new, months, number, config.refresh_all_days)
        for job in jobs:
            job.result()
    mart.publish_load(number)
    written["agg_daily_revenue"] = mart.daily_sums(months).count()

    metrics, others = counts.result()
    written = [("written", table, n) for table, n in sorted(written.items())]
    for stage_, name, n in [*metrics, *others, *written]:
        log.info("%s %s: %d", stage_, name, n)
    mart.log_run([*metrics, *others, *written], run_date, number)
    if not config.keep_staging:
        for name in STAGED:
            mart.remove(config.staging(name, run_date))
    return {(stage_, source): n for stage_, source, n in metrics}


def row_counts(staged):
    """(stage, name, n) of a run: per stage and source; per sheet and per category of products."""
    stages = run_metrics(staged.routed, staged.kept).orderBy("stage", "source").collect()
    sheets = sheet_counts(staged.routed).collect()
    products = products_from(staged.names).select("product_code", "category")
    sorts = category_histogram(staged.kept, products).orderBy("transaction_type", "category").collect()
    others = [("sheet", row.sheet, row.n) for row in sheets]
    others += [(f"category: {row.transaction_type.lower()}", row.category, row.n) for row in sorts]
    return [(row.stage, row.source, row.n) for row in stages], others


@dataclass(frozen=True)
class Staged:
    """The tables a load works from."""

    routed: DataFrame
    kept: DataFrame
    names: DataFrame


def stage(feed, config, run_date):
    """Write routed rows, kept rows and product names; return them as read back."""
    reject = F.col("_reject_reason").isNotNull()
    routed = _staged(
        # Accepted rows need their original texts no more.
        route(feed, config.date_formats).withColumns(
            {"is_rejected": reject, "_raw": F.when(reject, F.col("_raw"))}
        ),
        config.staging("routed", run_date),
        partition="is_rejected",
    )
    return stage_routed(routed, config, run_date)


def stage_routed(routed, config, run_date):
    """As ``stage``, from routed rows that are staged already, or some of them."""
    with ThreadPoolExecutor(1) as pool:
        choosing = pool.submit(
            _staged, choose_names(routed), config.staging("names", run_date)
        )
        kept, problems = keep(routed, config.priority), Observation()
        # What follows from the other columns of a row is not written, but made again when it is read.
        kept = _staged(
            kept.observe(problems, *count_failures(fact_rules(kept))).drop(*REVENUE),
            config.staging("kept", run_date),
        )
        kept = split_revenue(kept)
        names = choosing.result()
    _report(problems.get, config.strict)
    return Staged(routed, kept, names)


def _staged(rows, path, partition=None):
    """Write ``rows`` and read them back; empty input leaves an empty table."""
    writer = rows.write.options(**STORED).mode("overwrite")
    (writer.partitionBy(partition) if partition else writer).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _report(violations, strict):
    """Warn about values the fact table cannot hold; stop if ``strict``."""
    found = {rule: n for rule, n in violations.items() if n}
    for rule, count in found.items():
        log.warning("%s: %d rows", rule, count)
    # A missing invoice number is loaded and reported, never refused.
    blocking = {rule: n for rule, n in found.items() if rule != "null:invoice_no"}
    if strict and blocking:
        raise ConstraintError(f"rows that do not fit the fact table: {blocking}")


def load_products(mart, names, config, run_date):
    """Update or insert: name and category follow the newest feed. Returns how many products that were."""
    now = F.current_timestamp()
    fresh = products_from(names).withColumns(
        {"is_active": F.lit(True), "created_at": now, "updated_at": now}
    )
    described = ["canonical_name", "category"]
    if not config.restamp_products:
        fresh = changed_rows(mart.read("dim_products"), fresh, ["product_code"], described)
        fresh = _staged(fresh, config.staging("products", run_date))
    mart.merge("dim_products", fresh, ["product_code"], [*described, "updated_at"])
    return (names.filter("accepted") if config.restamp_products else fresh).count()


def load_customers(mart, kept):
    """Insert new customers; a stored one always wins.

    The anonymous customer is there from the start, so its many rows are
    dropped before anything is shuffled.
    """
    fresh = build_customers(kept).filter(F.col("customer_id") != ANONYMOUS)
    new = absent_rows(mart.read("dim_customers"), fresh, ["customer_id"])
    return _added(mart, "dim_customers", new.withColumn("created_at", F.current_timestamp()))


def load_dates(mart, kept):
    new = absent_rows(mart.read("dim_date"), build_dates(kept), ["date_id"])
    return _added(mart, "dim_date", new)


def _added(mart, table, rows):
    """Append and return how many rows that were; the counts come from file footers."""
    before = mart.read(table).count()
    mart.append(table, rows)
    return mart.read(table).count() - before


def new_rows(mart, kept, config, run_date):
    """The kept rows that become facts: those whose key is not stored yet.

    The stored keys are bucketed, so only the new rows are moved to meet them,
    and the range of the new invoices lets the scan skip the files of others.
    If no stored key is in that range, nothing is moved or staged.
    """
    names, values = key_names(config.fact_key), fact_values(config.null_invoice_text)
    if not mart.has_keys():
        return kept
    first = kept.select(key_columns(config.fact_key, values)[0])
    stored = in_range(mart.stored_keys(names), first, names[0])
    if stored.isEmpty():
        return kept
    new = unknown_keys(stored, kept, config.fact_key, values).drop(*REVENUE, *names)
    return split_revenue(_staged(new, config.staging("new_rows", run_date)))


def add_facts(mart, rows, config, number):
    """Write the facts of new rows. They are made behind the shuffle by month, as the rows are narrower."""
    now = F.current_timestamp()

    def made(laid):
        return build_fact(split_revenue(laid), config.null_invoice_text).withColumn("loaded_at", now)

    mart.add_facts(rows.withColumn("month_id", month_id(F.col("date_id"))).drop(*REVENUE), number, made)


def check_parents(mart, new, strict=True):
    """Refuse new facts that have no parent row."""
    parents = {
        column: (mart.read(table), UNIQUE_KEYS[table][0][0])
        for column, table in FOREIGN_KEYS["fact_transactions"].items()
    }
    found = orphan_counts(new, parents).collect()  # one row per rule
    _report({row.rule: row.rows for row in found}, strict)


def add_keys(mart, new, columns, number, strict=True):
    """Write the keys of new facts; refuse facts whose key is there twice. Keys with a null never clash."""
    unique = UNIQUE_KEYS["fact_transactions"][1]
    whole = reduce(and_, [F.col(c).isNotNull() for c in unique])
    _report({f"duplicate:{','.join(unique)}": mart.add_keys(new, columns, number, whole)}, strict)


def load_daily_revenue(mart, new, number, all_days=False):
    """Add the sums of the new facts to those of their months, as part of a load.

    Only the sums of touched months are read, and no stored fact. ``all_days``
    sums all facts again. Returns the touched months.

    Rows are dealt once, by month and by parts of its products, for adding up
    and for writing: some parts for each task, so that months of any size fill them.
    """
    now = F.current_timestamp()
    facts = mart.read("fact_transactions") if all_days else None
    every = new.select("date_id") if facts is None else new.select("date_id").union(facts.select("date_id"))
    # A calendar has few months, so their list is small.
    touched = every.select(month_id(F.col("date_id")).alias("month")).distinct().collect()
    months = sorted(row.month for row in touched)
    tasks = int(new.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = -(-4 * tasks // max(len(months), 1))
    if facts is None:
        daily = merge_daily_revenue(mart.daily_sums(months), new, now, parts)
    else:  # not published yet, so the stored facts are those of earlier loads
        daily = merge_daily_revenue(build_daily_revenue(facts), new, None, parts).withColumn("updated_at", now)
    if months:
        mart.write_sums(daily, number, DAILY, True)
    return months


def load_daily_invoices(mart, new, months, number, all_days=False):
    """Add the new facts to the invoice sketches of their months, as part of a load.

    A store that has facts but no sketches yet gets those of all its facts.
    """
    facts, table = mart.read("fact_transactions"), "agg_daily_invoices"
    if all_days or (mart.read(table).isEmpty() and not facts.isEmpty()):
        columns = ["date_id", "country", "customer_id", "transaction_type", "gross_revenue", "quantity", "invoice_no"]
        daily = build_daily_invoices(facts.select(*columns).unionByName(new.select(*columns)))
    else:
        daily = merge_daily_invoices(mart.daily_sums(months, table), build_daily_invoices(new))
    mart.write_sums(daily, number, table)


def load_rejects(mart, rejects, run_date, mode="append"):
    """Log the rejected rows of a run."""
    entries = reject_entries(rejects, run_date)
    entries = with_surrogate_key(entries, "reject_id", mart.highest("reject_log", "reject_id"))
    entries = entries.withColumn("logged_at", F.current_timestamp())
    if mode == "append":
        mart.append("reject_log", entries)
    elif mode == "replace":
        mart.replace_run("reject_log", "pipeline_run_date", run_date, entries)
    else:
        raise ValueError(f"rejects must be 'append' or 'replace', not {mode!r}")
    return rejects.count()
