"""Percentiles inside the plan, and sketches of quantiles and distinct counts."""

from decimal import Decimal
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import star
from ledgerloom.operators.percentile import (
    RANK_ERROR,
    exact_percentiles,
    merged_sketches,
    percentile_in_plan,
    quantile_sketches,
    sketched_quantile,
)
from ledgerloom.plans import business
from ledgerloom.plans.daily import LoadConfig, run_daily_load
from ledgerloom.sinks import Mart
from verification.extracts import broken_extract
from verification.loaded import loaded

from test_daily import HISTORY, write_inputs


@pytest.mark.parametrize(
    "values", [[], [3], [1, 2], [1, 2, 3, 4], [5] * 90 + [7], list(range(-50, 951)), [i * i % 53 for i in range(3000)]]
)
def test_percentile_in_plan_is_exact(spark, values):
    rows = spark.createDataFrame([(Decimal(v) / 4,) for v in values] + [(None,)], "x decimal(24,4)")
    for fraction in (0, 0.25, 0.75, 1):
        exact = exact_percentiles(rows, ["x"], fraction, ["x"])["x"]
        assert percentile_in_plan(rows, "x", fraction).first().value == exact


def test_only_the_middle_of_many_rows_is_ranked(spark):
    rows = spark.range(400_000).select((F.xxhash64("id") % 1_000_003).cast("decimal(20,0)").alias("x"))
    values = np.sort([int(r.x) for r in rows.collect()])
    found = percentile_in_plan(rows, "x", 0.75)
    assert float(found.first().value) == np.percentile(values, 75)


def test_the_review_question_starts_no_job_while_it_is_built(spark, folder):
    tables = loaded(spark, folder).tables
    spark.sparkContext.setJobGroup("review", "building")
    try:
        question = business.q7_review_candidates(tables)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("review")) == []
        assert question.count() > 0
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_merged_quantile_sketches_keep_their_rank(spark):
    rng = np.random.default_rng(0)
    values = np.concatenate([rng.lognormal(3, 2, 60_000), np.full(20_000, 42.0)])
    rows = spark.createDataFrame([(float(v), i % 40) for i, v in enumerate(values)], "x double, day int")
    days = quantile_sketches(rows, ["day"], "x")
    assert days.count() == 40
    ordered = np.sort(values)
    for fraction in (0.01, 0.25, 0.5, 0.75, 0.99):
        (found,) = merged_sketches(days).select(sketched_quantile("sketch", fraction).alias("x")).collect()
        low, high = np.searchsorted(ordered, [found.x], "left")[0], np.searchsorted(ordered, [found.x], "right")[0]
        slack = RANK_ERROR * len(values) + 1
        assert low - slack <= fraction * len(values) <= high + slack


def test_invoice_sketches_unite(spark, folder):
    fact = loaded(spark, folder).tables["fact_transactions"]
    halves = [fact.filter(F.col("transaction_id") % 2 == k) for k in (0, 1)]
    merged = star.merge_daily_invoices(*map(star.build_daily_invoices, halves))
    whole = star.build_daily_invoices(fact)
    ask = lambda rows: business.q4_countries_sketch(rows).collect()
    assert ask(merged) == ask(whole)
    exact = {r.country: r for r in business.q4_countries({"fact_transactions": fact}).collect()}
    errors = [abs(r.num_facturas / exact[r.country].num_facturas - 1) for r in ask(whole)]
    assert max(errors) < 5 * star.SKETCH_ERROR and np.sqrt(np.mean(np.square(errors))) < 2 * star.SKETCH_ERROR
    plan = business.q4_countries_sketch(merged)._jdf.queryExecution().optimizedPlan().toString()
    assert "hll_union_agg" in plan


def test_sketches_switched_on_later_cover_all_facts(spark, tmp_path, monkeypatch):
    write_inputs(tmp_path / "in")
    plain = LoadConfig(str(tmp_path / "in"), str(tmp_path / "mart"), key_buckets=4)
    run_daily_load(spark, plain, "2024-01-01")
    mart = Mart(spark, plain.mart_root, 4)
    assert mart.read("agg_daily_invoices").count() == 0
    later = LoadConfig(plain.data_root, plain.mart_root, key_buckets=4, invoice_sketches=True)
    for day, row in (("2024-01-02", "9,P1A,cup,5,12/2/2010 8:26,2,7,Spain"), ("2024-01-03", "8,P1A,cup,5,12/3/2010 8:26,2,7,Spain")):
        write_inputs(tmp_path / "in", [row], HISTORY[:1])
        run_daily_load(spark, later, day)
        question = business.q4_countries_sketch(mart.read("agg_daily_invoices"))
        assert question.collect() == business.q4_countries(mart.tables()).collect()


def test_files_of_a_made_extract_grow_in_number_with_its_table(spark, tmp_path):
    lines = spark.range(64).select(
        F.col("id").alias("l_orderkey"), F.col("id").alias("l_partkey"),
        F.lit(1).alias("l_linenumber"), F.lit("N").alias("l_returnflag"),
    )
    lines.repartition(8).write.parquet(f"{tmp_path}/lineitem.parquet")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # one task for each file
    try:
        path = broken_extract(spark, str(tmp_path), overlong=False)
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    files = list(Path(path.removeprefix("file:")).glob("*.csv"))
    assert len(files) == 8
    assert sum(len(file.read_text().splitlines()) - 1 for file in files) == 64
