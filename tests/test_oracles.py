"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from ledgerloom.operators.catalogue import with_canonical
from ledgerloom.operators.star import returns_of, sales_of
from ledgerloom.plans.transform import transform
from verification.compare import difference, open_database
from verification.feed import feed, united_frames
from verification.loaded import RUN_DATE, loaded
from verification.oracles import ORACLES
from verification.queries import QUERIES



@pytest.fixture(scope="module")
def database(folder):
    return open_database(folder)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= contract.queries().items()
    assert ORACLES.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, folder, database, name):
    assert difference(QUERIES[name](spark, folder), database, ORACLES[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_both_feeds_are_the_same(spark, folder):
    one, other = feed(spark, folder), united_frames(spark, folder)
    assert one.exceptAll(other).count() == 0 == other.exceptAll(one).count()


def test_lazy_transform_is_what_a_load_stages(spark, folder):
    load = loaded(spark, folder)
    sales, returns, rejects = transform(feed(spark, folder), RUN_DATE)
    named = with_canonical(load.kept, load.names.drop("accepted"))
    for mine, staged in ((sales, sales_of(named)), (returns, returns_of(named))):
        mine = mine.select(*staged.columns)
        assert mine.exceptAll(staged).count() == 0 == staged.exceptAll(mine).count()
    assert rejects.count() == load.tables["reject_log"].count()
