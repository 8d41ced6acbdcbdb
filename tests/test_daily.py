import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.__main__ import main
from ledgerloom.constants import HISTORY_HEADERS, SALES_HEADERS
from ledgerloom.operators import checks, merge
from ledgerloom.plans import daily
from ledgerloom.plans.business import QUESTIONS
from ledgerloom.plans.daily import ConstraintError, LoadConfig, run_daily_load
from ledgerloom.schemas import FOREIGN_KEYS, TABLES, UNIQUE_KEYS
from ledgerloom.sinks import Mart
from verification.feed import raw_frames

SALES = [
    "1,p1a,red CUP,2,12/1/2010 8:26,1.50,7.0,Spain",
    "1,P1A,red cup,3,12/1/2010 8:26,1.50,7,Spain",
    "2, p2 ,NOTEBOOK,-1,1/5/2011 10:00,4,,France",
    ",P3,box,1,1/5/2011 10:00,4,8,France",
    "4,P9,box,x,1/5/2011 10:00,4,8,France",
]
HISTORY = [
    "1,P1A,blue cup,9,2010-12-01 08:26:00,1.50,7,Italy",
    "0,P1A,blue cup,9,2009-12-01 08:26:00,1.50,7,Italy",
]


def write_inputs(root, sales=SALES, history=HISTORY):
    root.mkdir(exist_ok=True)
    (root / "history").mkdir(exist_ok=True)
    (root / "sales.csv").write_text("\n".join([",".join(SALES_HEADERS), *sales]), "latin-1")
    sheet = "\n".join([",".join(HISTORY_HEADERS), *history])
    (root / "history" / "sheet1.csv").write_text(sheet, "latin-1")
    return str(root)


def contents(mart, skip=()):
    """All rows of all tables but the columns that change with every run."""
    changing = {"created_at", "updated_at", "loaded_at", "logged_at", "transaction_id", "reject_id"}
    found = {}
    for table, rows in mart.tables().items():
        if table not in skip:
            columns = [c for c in rows.columns if c not in changing]
            found[table] = sorted(rows.select(*columns).collect(), key=repr)
    return found


@pytest.fixture(scope="module")
def first(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("load")
    config = LoadConfig(write_inputs(root / "in"), str(root / "mart"), rejects="replace")
    metrics = run_daily_load(spark, config, "2024-01-01")
    return config, metrics


def test_row_counts(first):
    _, metrics = first
    assert metrics == {
        ("read", "sales_csv"): 5, ("read", "history_csv"): 2,
        ("rejected: quantity o unit_price no numérico", "sales_csv"): 1,
        ("accepted", "sales_csv"): 4, ("accepted", "history_csv"): 2,
        ("duplicate", "sales_csv"): 1, ("duplicate", "history_csv"): 1,
        ("sale", "sales_csv"): 2, ("return", "sales_csv"): 1, ("sale", "history_csv"): 1,
    }


def test_tables(spark, first):
    mart = Mart(spark, first[0].mart_root)
    products = mart.read("dim_products").select("product_code", "canonical_name", "category", "is_active")
    assert {tuple(r) for r in products.collect()} == {
        ("P1A", "Blue Cup", "HOGAR", True), ("P2", "Notebook", "PAPELERIA", True),
        ("P3", "Box", "HOGAR", True),
    }
    customers = mart.read("dim_customers").drop("created_at")
    assert {tuple(r) for r in customers.collect()} == {
        ("ANONYMOUS", None, True), ("7", "Spain", False), ("8", "France", False),
    }
    assert {r.date_id for r in mart.read("dim_date").collect()} == {
        dt.date(2009, 12, 1), dt.date(2010, 12, 1), dt.date(2011, 1, 5),
    }
    fact = mart.read("fact_transactions").select("invoice_no", "product_code", "quantity", "source")
    assert {tuple(r) for r in fact.collect()} == {
        ("1", "P1A", 2, "sales_csv"), ("2", "P2", -1, "sales_csv"), (None, "P3", 1, "sales_csv"),
        ("0", "P1A", 9, "history_csv"),
    }
    (reject,) = mart.read("reject_log").collect()
    assert (reject.raw_product_code, reject.pipeline_run_date) == ("P9", dt.date(2024, 1, 1))
    assert '"description":"Box"' in reject.raw_data and '"quantity":"x"' in reject.raw_data


def test_a_rerun_changes_nothing(spark, first):
    mart = Mart(spark, first[0].mart_root)
    before = contents(mart)
    created = mart.read("dim_products").agg(F.max("created_at")).first()
    run_daily_load(spark, first[0], "2024-01-01")
    assert contents(mart) == before
    after = mart.read("dim_products").agg(F.max("created_at"), F.min("updated_at")).first()
    assert after[0] == created[0] and after[1] > created[0]


def test_highest_number_comes_from_the_footers(spark, first):
    mart = Mart(spark, first[0].mart_root)
    ids = [r.transaction_id for r in mart.read("fact_transactions").collect()]
    assert mart.highest("fact_transactions", "transaction_id") == max(ids)
    assert Mart(spark, "/nowhere").highest("fact_transactions", "transaction_id") == 0


def test_tables_answer_sql(spark, first):
    Mart(spark, first[0].mart_root).register("shop_")
    (row,) = spark.sql(
        """
        SELECT p.category, SUM(a.net_revenue) AS net FROM shop_agg_daily_revenue a
        JOIN shop_dim_products p ON a.product_code = p.product_code
        GROUP BY p.category HAVING SUM(a.total_return_qty) > 0
        """
    ).collect()
    assert (row.category, float(row.net)) == ("PAPELERIA", -4.0)


def test_command_line(spark, tmp_path, capsys):
    data, mart = write_inputs(tmp_path / "in"), str(tmp_path / "mart")
    metrics = main(["load", "--data", data, "--mart", mart, "--date", "2024-01-01"])
    assert metrics["read", "sales_csv"] == 5
    main(["ask", "--mart", mart, "q6a_product_count"])
    assert capsys.readouterr().out.splitlines()[-2:] == ["total_productos_unicos", "3"]


def test_appended_rejects_repeat(spark, tmp_path):
    config = LoadConfig(write_inputs(tmp_path / "in"), str(tmp_path / "mart"))
    for day in ("2024-01-01", "2024-01-01", "2024-01-02"):
        run_daily_load(spark, config, day)
    mart = Mart(spark, config.mart_root)
    rejects = mart.read("reject_log")
    assert rejects.count() == 3 and rejects.select("reject_id").distinct().count() == 3
    assert mart.read("fact_transactions").count() == 4


def test_replaced_rejects_may_vanish(spark, tmp_path):
    root = tmp_path / "in"
    config = LoadConfig(write_inputs(root), str(tmp_path / "mart"), rejects="replace")
    run_daily_load(spark, config, "2024-01-01")
    run_daily_load(spark, config, "2024-01-02")
    write_inputs(root, SALES[:3])
    run_daily_load(spark, config, "2024-01-01")
    (reject,) = Mart(spark, config.mart_root).read("reject_log").collect()
    assert reject.pipeline_run_date == dt.date(2024, 1, 2)


def test_a_second_day_adds_and_updates(spark, tmp_path):
    root = tmp_path / "in"
    config = LoadConfig(write_inputs(root), str(tmp_path / "mart"))
    run_daily_load(spark, config, "2024-01-01")
    later = [
        "1,P1A,green CUP,5,12/1/2010 8:26,1.50,7,Portugal",
        "9,P1A,green CUP,5,12/2/2010 8:26,2,7,Portugal",
    ]
    write_inputs(root, later, [])
    run_daily_load(spark, config, "2024-01-02")
    mart = Mart(spark, config.mart_root)
    names = {r.product_code: r.canonical_name for r in mart.read("dim_products").collect()}
    assert names == {"P1A": "Green Cup", "P2": "Notebook", "P3": "Box"}
    countries = {r.customer_id: r.country for r in mart.read("dim_customers").collect()}
    assert countries["7"] == "Spain"
    daily = {
        (r.date_id.isoformat(), r.product_code): float(r.net_revenue)
        for r in mart.read("agg_daily_revenue").collect()
    }
    assert daily == {
        ("2009-12-01", "P1A"): 13.5, ("2010-12-01", "P1A"): 3.0, ("2010-12-02", "P1A"): 10.0,
        ("2011-01-05", "P2"): -4.0, ("2011-01-05", "P3"): 4.0,
    }


def test_sums_of_a_lost_load_are_made_up_for(spark, tmp_path, monkeypatch):
    config = LoadConfig(write_inputs(tmp_path / "in"), str(tmp_path / "mart"))
    with monkeypatch.context() as lost:
        lost.setattr(daily, "load_daily_revenue", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_daily_load(spark, config, "2024-01-01")
    other = write_inputs(tmp_path / "in2", ["9,P9,box,1,3/1/2012 9:00,3,8,Spain"], HISTORY[:0])
    run_daily_load(spark, LoadConfig(other, config.mart_root), "2024-01-02")
    mart = Mart(spark, config.mart_root)
    facts = mart.read("fact_transactions").agg(F.sum("gross_revenue")).first()[0]
    sums = mart.read("agg_daily_revenue").agg(F.sum("net_revenue")).first()[0]
    assert facts == sums and mart.ledger.lost() == []


def test_stored_facts_are_cut_before_they_are_shuffled(spark):
    stored = spark.range(10_000).select(F.col("id").cast("string").alias("invoice_no"))
    stored = stored.unionByName(spark.createDataFrame([(None,)], "invoice_no string"))
    new = spark.createDataFrame([("7",), (None,), ("new",), ("7",)], "invoice_no string")
    found = [row.invoice_no for row in merge.possible_matches(stored, new, "invoice_no").collect()]
    assert {"7", None} <= set(found) and len(found) < 200
    plan = merge.possible_matches(stored, new, "invoice_no")._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "broadcast" in plan


def test_ids_are_unique_over_loads_and_staging_is_removed(spark, tmp_path):
    config = LoadConfig(write_inputs(tmp_path / "in"), str(tmp_path / "mart"))
    run_daily_load(spark, config, "2024-01-01")
    write_inputs(tmp_path / "in", sales=[SALES[0].replace("1,", "77,", 1)])
    run_daily_load(spark, config, "2024-01-02")
    facts = Mart(spark, config.mart_root).read("fact_transactions")
    ids = [row.transaction_id for row in facts.collect()]
    assert None not in ids and len(ids) == len(set(ids)) and facts.where("invoice_no = '77'").count() == 1
    assert not list((tmp_path / "mart" / "_staging").rglob("*.parquet"))


def test_a_key_narrower_than_a_row_is_refused():
    with pytest.raises(ValueError, match="fact_key"):
        LoadConfig("in", "mart", fact_key=["invoice_no"])


def test_the_store_works_where_markers_are_switched_off(spark, tmp_path):
    marker = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    config = LoadConfig(write_inputs(tmp_path / "in"), str(tmp_path / "mart"))
    spark.conf.set(marker, "false")
    try:
        for day in ("2024-01-01", "2024-01-02"):
            run_daily_load(spark, config, day)
    finally:
        spark.conf.unset(marker)
    mart = Mart(spark, config.mart_root)
    assert mart.read("dim_products").count() > 0
    customers = mart.read("dim_customers")
    assert customers.count() == customers.select("customer_id").distinct().count()


def test_refreshing_touched_months_equals_refreshing_all(spark, tmp_path):
    found = []
    for name, everything in (("some", False), ("all", True)):
        root = tmp_path / name
        config = LoadConfig(write_inputs(root), str(tmp_path / f"{name}-mart"), refresh_all_days=everything)
        run_daily_load(spark, config, "2024-01-01")
        write_inputs(root, ["9,P1A,cup,5,12/2/2010 8:26,2,7,Spain"], [])
        run_daily_load(spark, config, "2024-01-02")
        found.append(contents(Mart(spark, config.mart_root)))
    assert found[0] == found[1]


def test_values_that_do_not_fit_stop_the_load(spark, tmp_path):
    bad = ["1,P1A,cup,3000000000,12/1/2010 8:26,1.50,7,Spain"]
    config = LoadConfig(write_inputs(tmp_path / "in", bad), str(tmp_path / "mart"))
    with pytest.raises(ConstraintError, match="range:quantity"):
        run_daily_load(spark, config, "2024-01-01")
    assert Mart(spark, config.mart_root).read("fact_transactions").count() == 0


def test_no_rejects_and_no_rows_are_fine(spark, tmp_path):
    config = LoadConfig(write_inputs(tmp_path / "in", [], []), str(tmp_path / "mart"))
    assert run_daily_load(spark, config, "2024-01-01") == {}
    tables = Mart(spark, config.mart_root).tables()
    assert {name: rows.count() for name, rows in tables.items()} == {
        name: int(name == "dim_customers") for name in TABLES
    }
    for ask in QUESTIONS.values():
        ask(tables).collect()


def test_options_null_invoice_text_and_layout(spark, tmp_path):
    config = LoadConfig(
        write_inputs(tmp_path / "in"), str(tmp_path / "mart"), null_invoice_text="None",
        date_formats=["M/d/yyyy H:mm"],
    )
    metrics = run_daily_load(spark, config, "2024-01-01")
    assert metrics["rejected: fecha inválida o no parseable", "history_csv"] == 2
    fact = Mart(spark, config.mart_root).read("fact_transactions")
    assert {r.invoice_no for r in fact.collect()} == {"1", "2", "None"}


def test_a_version_that_was_not_completed_is_ignored(spark, tmp_path):
    mart = Mart(spark, str(tmp_path / "mart"))
    row = spark.range(1).select(
        F.lit("A").alias("product_code"), F.lit("A").alias("canonical_name"),
        F.lit("HOGAR").alias("category"), F.lit(True).alias("is_active"),
        F.current_timestamp().alias("created_at"), F.current_timestamp().alias("updated_at"),
    )
    mart.replace("dim_products", row)
    mart.replace("dim_products", row)
    mart.replace("dim_products", row.union(row))
    folder = tmp_path / "mart" / "dim_products"
    assert sorted(p.name for p in folder.glob("version=*")) == [
        "version=000000002", "version=000000003",
    ]
    newest = tmp_path / "mart" / "dim_products" / "version=000000003" / "_SUCCESS"
    assert mart.read("dim_products").count() == 2
    newest.unlink()
    assert mart.read("dim_products").count() == 1


def test_loaded_tables_keep_their_promises(spark, tmp_path, folder):
    """A load of the given tables, from text files, breaks no constraint."""
    sales, sheets = raw_frames(spark, folder)
    for name, rows in {"sales.csv": sales, "history/1": sheets[0], "history/2": sheets[1]}.items():
        rows.write.csv(f"{tmp_path}/in/{name}", header=True)
    config = LoadConfig(f"{tmp_path}/in", f"{tmp_path}/mart")
    run_daily_load(spark, config, "2024-01-01")
    tables = Mart(spark, config.mart_root).tables()
    for table, rows in tables.items():
        for keys in UNIQUE_KEYS[table]:
            assert checks.duplicate_keys(rows, keys).count() == 0
        for column, parent in FOREIGN_KEYS.get(table, {}).items():
            assert checks.orphan_keys(rows, column, tables[parent]).count() == 0
        broken = checks.violations(rows, checks.table_rules(table)).filter("violations > 0")
        assert broken.collect() == []
    net = tables["agg_daily_revenue"].agg(F.sum("net_revenue")).first()[0]
    assert net == tables["fact_transactions"].agg(F.sum("gross_revenue")).first()[0]
