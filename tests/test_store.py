"""Loads through the store: bucketed keys, additive sums, the gate, the run log."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import checks, merge, star
from ledgerloom.plans import daily
from ledgerloom.plans.daily import ConstraintError, LoadConfig, run_daily_load
from ledgerloom.sinks import Mart
from ledgerloom.sinks.mart import PARTS

from test_daily import HISTORY, SALES, contents, write_inputs

KEY = daily.FACT_KEY


def keyed(spark, first, last, step=1):
    number = F.lpad(F.col("id").cast("string"), 9, "0")
    rows = spark.range(first, last, step).select(
        number.alias("invoice_no"), F.concat(F.lit("P"), F.col("id") % 7).alias("product_code"), F.lit("s").alias("source")
    )
    return rows.unionByName(rows.limit(1).withColumns({"invoice_no": F.lit(None).cast("string"), "product_code": F.lit("P0")}))


@pytest.fixture
def keys(spark, tmp_path):
    """A store with the keys of 200,000 facts, from two loads."""
    mart = Mart(spark, str(tmp_path / "mart"), buckets=8)
    for first, last in ((0, 100_000), (100_000, 200_000)):
        number = mart.begin_load()
        new = keyed(spark, first, last).select("*", *merge.key_columns(KEY))
        mart.add_keys(new, merge.key_names(KEY), number)
        mart.publish_load(number)
    return mart


def scanned_rows(frame):
    """Rows that came out of each file scan of the executed plan."""
    plan = frame._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "AdaptiveSparkPlan" in plan.nodeName() else plan
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("Scan parquet"):
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
        if node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
    return found


def test_stored_keys_are_not_moved(spark, keys, tmp_path):
    names = merge.key_names(KEY)
    keyed(spark, 150_000, 250_000).write.parquet(f"{tmp_path}/new")
    new = spark.read.parquet(f"{tmp_path}/new")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = merge.in_range(keys.stored_keys(names), new.select(merge.key_columns(KEY)[0]), names[0])
        found = merge.unknown_keys(stored, new, KEY)
        plan = found._jdf.queryExecution().executedPlan().toString()
        # The only exchange is that of the new rows, which come first in the plan.
        assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
        assert plan.index("Exchange") < plan.index(f"{tmp_path}/new") < plan.index("Bucketed: true")
        # Nulls are stored already, and so are the first 50,000.
        assert found.count() == 50_000
        assert {r.invoice_no for r in found.agg(F.min("invoice_no").alias("invoice_no")).collect()} == {"000200000"}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_three_million_new_invoices_still_prune(spark, keys):
    names = merge.key_names(KEY)
    new = keyed(spark, 1_000_000, 4_000_000).filter("invoice_no IS NOT NULL")
    stored = merge.in_range(keys.stored_keys(names), new.select(merge.key_columns(KEY)[0]), names[0])
    assert "PushedFilters: [IsNotNull(key_invoice_no), GreaterThanOrEqual" in stored._jdf.queryExecution().toString()
    assert stored.collect() == [] and scanned_rows(stored) == [0]
    # An overlap opens the files of one load only.
    new = keyed(spark, 150_000, 160_000).filter("invoice_no IS NOT NULL")
    stored = merge.in_range(keys.stored_keys(names), new.select(merge.key_columns(KEY)[0]), names[0])
    assert len(stored.collect()) == 10_000 and sum(scanned_rows(stored)) <= 100_001


def test_another_number_of_buckets_is_refused(spark, keys):
    with pytest.raises(ValueError, match="keys were written as"):
        Mart(spark, keys.root, buckets=16).stored_keys(merge.key_names(KEY))


LATER = [
    "1,P1A,green CUP,5,12/1/2010 8:26,1.50,7,Portugal",
    "9,P1A,green CUP,5,12/2/2010 8:26,2,7,Portugal",
    "9,P2,green CUP,-2,12/2/2010 8:26,2,7,Portugal",
    "10,P1A,cup,1,3/1/2012 8:26,2,7,Portugal",
]


@pytest.mark.parametrize("step", ["add_facts", "add_keys", "write_sums", "publish_load"])
def test_a_killed_and_repeated_load_adds_nothing_twice(spark, tmp_path, monkeypatch, step):
    config = LoadConfig(write_inputs(tmp_path / "in"), str(tmp_path / "mart"), rejects="replace", key_buckets=4)
    run_daily_load(spark, config, "2024-01-01")
    mart = Mart(spark, config.mart_root, 4)
    before = contents(mart, skip={"dim_products", "dim_customers", "dim_date", "reject_log"})
    write_inputs(tmp_path / "in", LATER, HISTORY[:1])
    with monkeypatch.context() as lost:
        real = getattr(Mart, step)

        def killed(self, *args):
            if step != "publish_load":
                real(self, *args)
            raise ZeroDivisionError

        lost.setattr(Mart, step, killed)
        with pytest.raises(ZeroDivisionError):
            run_daily_load(spark, config, "2024-01-02")
    assert contents(mart, skip={"dim_products", "dim_customers", "dim_date", "reject_log"}) == before
    # Facts of earlier loads are not needed for the new sums.
    with monkeypatch.context() as watched:
        read = Mart.read
        watched.setattr(Mart, "read", lambda self, t: read(self, t) if t != "fact_transactions" else 1 / 0)
        run_daily_load(spark, config, "2024-01-02")
    facts = mart.read("fact_transactions")
    assert facts.count() == 4 + 3
    assert facts.select("transaction_id").distinct().count() == 7
    sums = sorted(mart.read("agg_daily_revenue").drop("updated_at", "month_id").collect())
    assert sums == sorted(star.build_daily_revenue(facts).collect())
    assert mart.ledger.lost() == []


def test_untouched_months_keep_their_files(spark, tmp_path):
    config = LoadConfig(write_inputs(tmp_path / "in"), str(tmp_path / "mart"), key_buckets=4)
    run_daily_load(spark, config, "2024-01-01")
    folder = tmp_path / "mart" / "agg_daily_revenue"
    files = lambda: {str(p.relative_to(folder)) for p in folder.rglob("*.parquet")}
    first = files()
    write_inputs(tmp_path / "in", LATER[3:], HISTORY[1:])
    run_daily_load(spark, config, "2024-01-02")
    assert first < files() and {p.split("/")[0] for p in files() - first} == {"month_id=201203"}
    everything = files()
    run_daily_load(spark, config, "2024-01-03")
    assert files() == everything
    # All days anew: the same sums.
    sums = contents(Mart(spark, config.mart_root))["agg_daily_revenue"]
    anew = LoadConfig(config.data_root, config.mart_root, key_buckets=4, refresh_all_days=True)
    run_daily_load(spark, anew, "2024-01-04")
    assert contents(Mart(spark, config.mart_root))["agg_daily_revenue"] == sums


def test_orphans_stop_the_load(spark, tmp_path, monkeypatch):
    config = LoadConfig(write_inputs(tmp_path / "in"), str(tmp_path / "mart"), key_buckets=4)
    monkeypatch.setattr(daily, "load_dates", lambda mart, kept: 0)
    with pytest.raises(ConstraintError, match="orphan:date_id"):
        run_daily_load(spark, config, "2024-01-01")
    mart = Mart(spark, config.mart_root, 4)
    assert mart.read("fact_transactions").count() == 0 and mart.read("agg_daily_revenue").count() == 0
    lenient = LoadConfig(config.data_root, config.mart_root, key_buckets=4, strict=False)
    run_daily_load(spark, lenient, "2024-01-01")
    assert mart.read("fact_transactions").count() == 4


def test_repeated_keys_stop_the_load(spark, tmp_path, monkeypatch):
    config = LoadConfig(write_inputs(tmp_path / "in"), str(tmp_path / "mart"), key_buckets=4)
    keep = daily.keep
    monkeypatch.setattr(daily, "keep", lambda routed, priority: keep(routed, priority).transform(lambda k: k.union(k)))
    with pytest.raises(ConstraintError, match="duplicate:invoice_no,product_code,source"):
        run_daily_load(spark, config, "2024-01-01")
    assert Mart(spark, config.mart_root, 4).read("fact_transactions").count() == 0


def test_key_violations(spark):
    rows = spark.createDataFrame(
        [(1, "a"), (1, "a"), (2, "b"), (2, "c"), (None, "a"), (None, "a"), (3, None), (12, "x"), (1, "2x")],
        "number int, name string",
    )
    parents = {"number": (spark.createDataFrame([(1,), (2,)], "id int"), "id"), "name": (rows.filter("number < 3"), "name")}
    found = {r.rule: (r["keys"], r.rows) for r in checks.key_violations(rows, ["number", "name"], parents).collect()}
    assert found == {"duplicate:number,name": (1, 2), "orphan:number": (2, 2), "orphan:name": (1, 1)}
    assert checks.key_violations(rows.limit(0), ["number", "name"], parents).count() == 0


def test_the_run_log(spark, tmp_path):
    root = tmp_path / "in"
    write_inputs(root)
    (root / "history" / "sheet2.csv").write_text((root / "history" / "sheet1.csv").read_text())
    config = LoadConfig(str(root), str(tmp_path / "mart"), key_buckets=4)
    run_daily_load(spark, config, "2024-01-01")
    write_inputs(root, [*SALES, LATER[3]])
    run_daily_load(spark, config, "2024-01-02")
    log = Mart(spark, config.mart_root).run_log()
    first, second = [
        {(r.stage, r.name): r.n for r in log.filter(F.col("load_no") == n).collect()} for n in (1, 2)
    ]
    assert first["sheet", "sheet1.csv"] == first["sheet", "sheet2.csv"] == 2
    assert first["written", "fact_transactions"] == 4 and second["written", "fact_transactions"] == 1
    assert first["written", "dim_customers"] == 2 and second["written", "dim_customers"] == 0
    assert first["written", "reject_log"] == 1 and first["written", "dim_products"] == 3
    assert first["written", "dim_date"] == 3 and second["written", "dim_date"] == 1
    assert first["category: sale", "HOGAR"] == 3 and first["category: return", "PAPELERIA"] == 1
    assert log.select("run_date").distinct().count() == 2
    assert {r.run_date for r in log.collect()} == {dt.date(2024, 1, 1), dt.date(2024, 1, 2)}


# Products in parts ---------------------------------------------------------------------------


def products(spark, first, last, name="n"):
    now = F.current_timestamp()
    return spark.range(first, last).select(
        F.concat(F.lit("P"), "id").alias("product_code"), F.lit(name).alias("canonical_name"),
        F.lit("HOGAR").alias("category"), F.lit(True).alias("is_active"),
        now.alias("created_at"), now.alias("updated_at"),
    )


def files_of(mart):
    folder = Path(mart.path("dim_products"))
    return {str(p.relative_to(folder)) for p in folder.rglob("*.parquet")}


def merge_products(mart, rows):
    mart.merge("dim_products", rows, ["product_code"], ["canonical_name", "category", "updated_at"])


def named(mart):
    return {r.product_code: r.canonical_name for r in mart.read("dim_products").collect()}


def test_a_merge_writes_only_the_parts_it_touches(spark, tmp_path):
    mart = Mart(spark, str(tmp_path / "mart"))
    merge_products(mart, products(spark, 0, 500, "first"))
    before = files_of(mart)
    assert len({p.split("/")[1] for p in before}) == PARTS
    # One stored product and one that is new, each in its part.
    reading = mart.read("dim_products")
    merge_products(mart, products(spark, 499, 501, "second"))
    added = files_of(mart) - before
    assert before < files_of(mart) and {p.split("/")[0] for p in added} == {"version=000000002"}
    assert 1 <= len({p.split("/")[1] for p in added}) <= 2
    assert named(mart) == {f"P{i}": "first" for i in range(499)} | {"P499": "second", "P500": "second"}
    # Other parts are not opened by the merge, and what was read before is still there.
    assert reading.count() == 500
    part = F.expr(f"pmod(xxhash64(product_code), {PARTS})")
    wanted = {r[0] for r in products(spark, 499, 501).select(part).collect()}
    found = mart._read_parts("dim_products", wanted)
    assert {r[0] for r in found.select(part).distinct().collect()} == wanted
    row = mart.read("dim_products").filter("product_code = 'P499'").first()
    assert row.created_at < row.updated_at


def test_a_merge_of_nothing_writes_nothing(spark, tmp_path):
    mart = Mart(spark, str(tmp_path / "mart"))
    merge_products(mart, products(spark, 0, 0))
    assert files_of(mart) == set() and named(mart) == {}


def test_a_lost_merge_changes_nothing(spark, tmp_path):
    mart = Mart(spark, str(tmp_path / "mart"))
    merge_products(mart, products(spark, 0, 50, "first"))
    merge_products(mart, products(spark, 0, 20, "lost"))
    (Path(mart.path("dim_products")) / "version=000000002" / "_SUCCESS").unlink()
    assert set(named(mart).values()) == {"first"}
    merge_products(mart, products(spark, 30, 31, "second"))
    assert sorted(set(named(mart).values())) == ["first", "second"]
    assert {p.split("/")[0] for p in files_of(mart)} == {"version=000000001", "version=000000002"}


def test_outdated_parts_are_forgotten(spark, tmp_path):
    mart = Mart(spark, str(tmp_path / "mart"))
    mart.replace("dim_products", products(spark, 0, 100, "whole"))
    expected = {f"P{i}": "whole" for i in range(100)}
    for i in range(5):
        merge_products(mart, products(spark, 7, 8, f"v{i}"))
        assert named(mart) == expected | {"P7": f"v{i}"}
    parts = [p.split("/")[1] for p in files_of(mart)]
    touched = [p for p in set(parts) if parts.count(p) > 1]
    assert len(touched) == 1 and parts.count(touched[0]) == 2
    assert not [p for p in files_of(mart) if p.startswith("version=000000001")]
    # A whole version again: rows that it lacks stay away, also after further merges.
    mart.replace("dim_products", products(spark, 7, 8, "only"))
    for i in range(3):
        merge_products(mart, products(spark, 7, 9, f"w{i}"))
        assert named(mart) == {"P7": f"w{i}", "P8": f"w{i}"}


def test_an_unchanged_feed_may_rewrite_nothing(spark, tmp_path):
    root = tmp_path / "in"
    config = LoadConfig(write_inputs(root), str(tmp_path / "mart"), key_buckets=4, restamp_products=False)
    mart = Mart(spark, config.mart_root, 4)
    run_daily_load(spark, config, "2024-01-01")
    first, rows = files_of(mart), sorted(mart.read("dim_products").collect())
    run_daily_load(spark, config, "2024-01-02")
    assert files_of(mart) == first and sorted(mart.read("dim_products").collect()) == rows
    write_inputs(root, [*SALES[:3], "9,P2,blue box,1,1/5/2011 10:00,4,8,France", "9,P2,blue box,1,1/6/2011 10:00,4,8,France"])
    run_daily_load(spark, config, "2024-01-03")
    assert len(files_of(mart) - first) == 1
    after = {r.product_code: r for r in mart.read("dim_products").collect()}
    assert after["P2"].canonical_name == "Blue Box" and after["P2"].updated_at > after["P2"].created_at
    assert after["P1A"] in rows and after["P3"] in rows
    written = mart.run_log().filter("stage = 'written' AND name = 'dim_products'").orderBy("load_no").collect()
    assert [r.n for r in written] == [3, 0, 1]


def test_changed_rows(spark):
    schema = "k string, v string, w int"
    old = spark.createDataFrame([("a", "1", 1), ("b", None, 1), ("c", "1", 1)], schema)
    new = spark.createDataFrame([("a", "1", 2), ("b", None, 2), ("c", None, 2), ("d", None, 2)], schema)
    assert sorted(r.k for r in merge.changed_rows(old, new, ["k"], ["v"]).collect()) == ["c", "d"]
    assert merge.changed_rows(old.limit(0), new, ["k"], ["v"]).count() == 4
