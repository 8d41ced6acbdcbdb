"""What the queries over a load run of it."""

from datetime import datetime
from pathlib import Path

import pytest

from verification import loaded as module
from verification.queries import QUERIES


@pytest.fixture
def given(spark, tmp_path):
    """A folder with the tables the feed is made from: lines of 1997, of the overlapping year and of 1999."""
    days = [datetime(1997, 5, 1), datetime(1998, 5, 1), datetime(1999, 5, 1)]
    lines = [(i, 1 + i % 2, 1 + i % 3, float(i), "R" if i % 4 == 0 else "N", days[i % 3]) for i in range(5, 17)]
    tables = {
        "nation": ([(1, "FRANCE")], "n_nationkey int, n_name string"),
        "customer": ([(i, 1) for i in range(1, 6)], "c_custkey long, c_nationkey int"),
        "part": ([(1, "red cup", 2, 1.5), (2, "vase", 5, 2.5)], "p_partkey long, p_name string, p_size int, p_retailprice double"),
        "orders": ([(i, 1 + i % 5) for i in range(5, 17)], "o_orderkey long, o_custkey long"),
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_returnflag string, l_shipdate timestamp_ntz"),
    }
    for name, (rows, kind) in tables.items():
        spark.createDataFrame(rows, kind).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def _loads(monkeypatch):
    """Names of the steps that run from now on, in order."""
    done = []
    for name in ("stage", "stage_routed", "load_staged"):
        step = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *a, step=step, name=name: (done.append(name), step(*a))[1])
    return done


def test_staged_rows_need_no_store(spark, given, monkeypatch):
    done = _loads(monkeypatch)
    for name in ("split_revenue", "check_fk", "gate_violations", "agg_refresh"):
        QUERIES[name](spark, given).collect()
    load = module.loaded(spark, given)
    assert done == ["stage"]
    assert [p.name for p in Path(load.config.mart_root.removeprefix("file:")).iterdir()] == ["_staging"]
    # A query over stored tables runs the rest, once.
    for name in ("q3b_top_return_rate", "q1_monthly_net"):
        QUERIES[name](spark, given).collect()
    assert done == ["stage", "load_staged"]
    assert load.tables["fact_transactions"].count() == load.kept.count() > 0


def test_two_loads_read_texts_once(spark, given, monkeypatch):
    done = _loads(monkeypatch)
    stored = QUERIES["store_agg_refresh"](spark, given).collect()
    assert done == ["stage", "stage_routed", "load_staged", "load_staged"]
    assert sorted(stored) == sorted(QUERIES["agg_refresh"](spark, given).collect())
