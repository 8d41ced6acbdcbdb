"""What a load writes and moves, and how often."""

import datetime as dt
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from ledgerloom.operators import merge, star
from ledgerloom.plans.daily import REVENUE, LoadConfig, run_daily_load
from ledgerloom.sinks import Mart

from test_daily import write_inputs


@pytest.fixture
def written(monkeypatch):
    """The physical plan of what is written to each path from now on."""
    plans, real = {}, DataFrameWriter.parquet

    def parquet(self, path, *args, **options):
        plans[path] = self._df._jdf.queryExecution().executedPlan().toString()
        return real(self, path, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    return plans


def test_a_load_moves_and_writes_facts_once(spark, tmp_path, written):
    config = LoadConfig(write_inputs(tmp_path / "in"), str(tmp_path / "mart"), key_buckets=4, keep_staging=True)
    run_daily_load(spark, config, "2024-01-01")
    plans = {path.removeprefix(f"{config.mart_root}/"): plan for path, plan in written.items()}
    # No stored key is in their range, so new rows are neither moved to meet any nor staged.
    assert {path.split("/")[1] for path in plans if path.startswith("_staging/")} == {"routed", "kept", "names"}
    # Facts are made behind the shuffle that lays them out.
    above, _, below = plans["fact_transactions/load_no=1"].partition("Exchange")
    assert "gross_revenue" in above and "gross_revenue" not in below and "Exchange" not in below
    assert plans["agg_daily_revenue"].count("Exchange") == 1
    # What follows from other columns is not staged, and is there again when read.
    assert not set(REVENUE) & set(spark.read.parquet(config.staging("kept", "2024-01-01")).columns)
    # The same rows again: they meet the stored keys, and none of them is new.
    written.clear()
    run_daily_load(spark, config, "2024-01-02")
    assert config.staging("new_rows", "2024-01-02") in written
    assert spark.read.parquet(config.staging("new_rows", "2024-01-02")).count() == 0
    files = [p for table in ("fact_transactions", "agg_daily_revenue", "_fact_keys") for p in (tmp_path / "mart" / table).rglob("*.parquet")]
    assert {pq.ParquetFile(p).metadata.row_group(0).column(0).compression for p in files} == {"ZSTD"}


def test_sums_dealt_by_month_and_part_are_the_same(spark):
    day, money = dt.date(2024, 1, 31), Decimal("1.5000")
    schema = "date_id date, product_code string, gross_revenue decimal(14,4), transaction_type string, quantity int"
    facts = [(day, "a", money, "SALE", 2), (day, "a", -money, "RETURN", -1), (day, "b", None, "SALE", None), (None, "b", money, "SALE", 1)]
    new = spark.createDataFrame([*facts, (dt.date(2024, 2, 1), None, money, "RETURN", 1)], schema)
    kinds = "gross_revenue decimal(14,4), return_amount decimal(14,4), net_revenue decimal(14,4), total_sales_qty int, total_return_qty int"
    old = [(day, "a", money, money, money, 1, 2, dt.datetime(2020, 1, 1)), (day, "c", None, None, None, None, None, None)]
    stored = spark.createDataFrame(old, f"date_id date, product_code string, {kinds}, updated_at timestamp")
    now = F.lit("2024-02-02 00:00:00").cast("timestamp")
    rows = lambda frame: sorted(map(repr, frame.collect()))
    for kept in (stored, stored.limit(0)):
        dealt = star.merge_daily_revenue(kept, new, now, 3)
        assert rows(dealt) == rows(star.merge_daily_revenue(kept, new, now))
        assert rows(star.merge_daily_revenue(kept, new, None, 3)) == rows(star.merge_daily_revenue(kept, new))


def test_repeated_keys_are_counted_where_they_are_written(spark, tmp_path):
    mart, names = Mart(spark, str(tmp_path / "mart"), buckets=4), ["key_a", "key_b"]
    rows = spark.createDataFrame([("1", "x"), ("1", "x"), ("1", "x"), ("2", "x"), (None, "x"), (None, "x")], "a string, b string")
    keyed = rows.select("*", *merge.key_columns(["a", "b"]))
    assert not mart.has_keys()
    number = mart.begin_load()
    assert mart.add_keys(keyed, names, number, F.col("a").isNotNull()) == 3
    assert not mart.has_keys()
    mart.publish_load(number)
    assert mart.has_keys() and mart.stored_keys(names).count() == 6
    assert mart.add_keys(keyed.distinct(), names, mart.begin_load()) == 0
