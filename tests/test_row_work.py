"""What a load does for every row of the feed."""

from pyspark.sql import functions as F

from ledgerloom.constants import ANONYMOUS, FEED_COLUMNS
from ledgerloom.operators.checks import orphan_counts
from ledgerloom.operators.cleanse import normalise_customer
from verification.feed import feed


def _plan(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_lines_meet_orders_that_have_their_customers(spark, folder):
    plan = [line for line in _plan(feed(spark, folder)).splitlines() if "Relation" in line]
    depth = lambda text: next(line.index("Relation") for line in plan if text in line)
    # Below the join with the parts, lines are in one join; orders are in two more.
    assert depth("l_orderkey") < depth("o_orderkey") < depth("c_custkey")


def test_sources_of_a_line_need_no_function_over_items(spark, folder):
    rows = feed(spark, folder)
    assert "lambda" not in _plan(rows)
    assert rows.columns == [*FEED_COLUMNS, "_source"]


def test_customers_without_a_pattern(spark):
    texts = ["17850.0", " 17850.0 ", ".0", "1.0.0", "17850", "0", "nan", " nan ", "nan.0", "", " ", "x.0\n ", "1\n.0", "é.0", "\U0001d5541.0", None]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, customer_id string")
    found = normalise_customer(frame)
    assert "regexp_replace" not in _plan(found)
    wanted = ["17850", "17850", "", "1.0", "17850", "0", ANONYMOUS, ANONYMOUS, "nan", ANONYMOUS, ANONYMOUS, "x", "1\n", "é", "\U0001d5541", ANONYMOUS]
    assert [r.customer_id for r in found.orderBy("i").collect()] == wanted


def test_orphans_are_counted_without_a_row_for_each_column(spark):
    rows = spark.sql("SELECT * FROM VALUES ('a', 1, DATE'2024-01-01'), ('a', 2, NULL), ('b', NULL, DATE'2024-01-02'), (NULL, 2, DATE'2024-01-02') t(p, c, d)")
    parents = {
        "p": (spark.sql("SELECT 'b' AS k"), "k"),
        "c": (spark.sql("SELECT 1 AS k"), "k"),
        "d": (spark.sql("SELECT DATE'2024-01-02' AS k UNION ALL SELECT NULL"), "k"),
    }
    found = orphan_counts(rows, parents)
    assert "Generate" not in _plan(found)
    assert {tuple(r) for r in found.collect()} == {("orphan:p", 1, 2), ("orphan:c", 1, 2), ("orphan:d", 1, 1)}
    assert orphan_counts(rows.filter(F.lit(False)), parents).collect() == []
