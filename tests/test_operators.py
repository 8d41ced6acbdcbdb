import datetime as dt
import json
import random
from decimal import Decimal

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.constants import (
    BAD_CODE,
    BAD_DATE,
    BAD_NUMBER,
    BAD_PRICE,
    FEED_COLUMNS,
)
from ledgerloom.operators import catalogue, checks, merge, star
from ledgerloom.operators.cleanse import cleanse, normalise_code, normalise_customer
from ledgerloom.operators.dedup import deduplicate, priority_rank
from ledgerloom.operators.percentile import exact_percentiles
from ledgerloom.operators.route import reject_entries, rejected, validate
from ledgerloom.plans.business import q7_limits, q7_review_candidates
from ledgerloom.plans.transform import keep, route, transform, transform_and_classify

RELAXED = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
FEED_SCHEMA = ", ".join(f"{c} string" for c in [*FEED_COLUMNS, "_source"])


def line(invoice="1", code="A", description="pen", quantity="2", date="12/1/2010 8:26",
         price="1.5", customer="7", country="X", source="sales_csv"):
    return (invoice, code, description, quantity, date, price, customer, country, source)


def make(spark, *lines):
    return spark.createDataFrame(list(lines), FEED_SCHEMA)


def reasons(spark, *lines):
    numbered = [(str(i), *entry[1:]) for i, entry in enumerate(lines)]
    rows = route(make(spark, *numbered)).orderBy(F.col("invoice_no").cast("int"))
    return [row._reject_reason for row in rows.collect()]


# Routing -----------------------------------------------------------------------


def test_reject_rules(spark):
    assert reasons(
        spark,
        line(),
        line(date="soon"),
        line(date=None),
        line(quantity="abc"),
        line(price=None),
        line(price="0"),
        line(price="-1"),
        line(quantity="-2", price="0"),
        line(quantity="0", price="-1"),
        line(code="  "),
        line(code=None),
        line(invoice=None),
    ) == [
        None, BAD_DATE, BAD_DATE, BAD_NUMBER, BAD_NUMBER, BAD_PRICE, BAD_PRICE, None, None,
        BAD_CODE, BAD_CODE, None,
    ]


def test_only_the_first_failing_rule_counts(spark):
    assert reasons(
        spark,
        line(date="x", quantity="y", price="-1", code=" "),
        line(quantity="y", price="-1", code=" "),
        line(price="-1", code=" "),
    ) == [BAD_DATE, BAD_NUMBER, BAD_PRICE]


@RELAXED
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["12/1/2010 8:26", "2009-12-01 07:45:00", "bad", None]),
            st.sampled_from(["1", "-1", "0", "x", None]),
            st.sampled_from(["1", "0", "-2", "y", None]),
            st.sampled_from(["A", " a ", "", None]),
            st.sampled_from(["sales_csv", "history_csv"]),
        ),
        min_size=1,
        max_size=25,
    )
)
def test_every_row_ends_up_in_exactly_one_place(spark, rows):
    lines = [
        line(invoice=str(i % 5), date=d, quantity=q, price=p, code=c, source=s)
        for i, (d, q, p, c, s) in enumerate(rows)
    ]
    sales, returns, rejects = transform(make(spark, *lines), "2024-01-01")
    expected = []
    kept = set()
    for i, (d, q, p, c, _) in enumerate(rows):
        code = (c or "").strip().upper()
        if d in ("bad", None):
            expected.append(BAD_DATE)
        elif q in ("x", None) or p in ("y", None):
            expected.append(BAD_NUMBER)
        elif float(q) > 0 and float(p) <= 0:
            expected.append(BAD_PRICE)
        elif not code:
            expected.append(BAD_CODE)
        else:
            kept.add((str(i % 5), code))
    assert sorted(r._reject_reason for r in rejects.collect()) == sorted(expected)
    keys = [(r.invoice_no, r.stock_code) for r in sales.unionByName(
        returns, allowMissingColumns=True).collect()]
    assert sorted(keys) == sorted(kept)


def test_reject_entries_keep_the_whole_row(spark):
    feed = make(spark, line(date="soon", code=" a ", invoice=""), line(code="  ", source=None))
    rows = reject_entries(rejected(route(feed)), "2024-02-03").orderBy("reject_reason").collect()
    assert [r.reject_reason for r in rows] == [BAD_DATE, BAD_CODE]
    assert [r.source for r in rows] == ["sales_csv", "unknown"]
    assert [r.raw_invoice_no for r in rows] == [None, "1"]
    assert [r.raw_product_code for r in rows] == ["A", None]
    assert rows[0].pipeline_run_date == dt.date(2024, 2, 3)
    data = json.loads(rows[0].raw_data)
    assert data["_raw"]["invoice_date"] == "soon" and data["_raw"]["stock_code"] == " a "
    assert "invoice_date" in data and data["invoice_date"] is None


# Customers, names, categories -----------------------------------------------------


def test_customers_are_normalised(one, spark):
    ids = ["17850", "17850.0", " 17850 ", "", "  ", "nan", None, "12.05", "a.0"]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(ids)], "i int, customer_id string")
    answer = normalise_customer(frame).orderBy("i").collect()
    assert [r.customer_id for r in answer] == [
        "17850", "17850", "17850", "ANONYMOUS", "ANONYMOUS", "ANONYMOUS", "ANONYMOUS", "12.05", "a",
    ]


def names(spark, *pairs):
    rows = normalise_code(make(spark, *[line(code=c, description=d) for c, d in pairs]))
    return {r.stock_code: r.description for r in catalogue.canonical_descriptions(rows).collect()}


def test_canonical_name_is_the_mode_and_the_smallest_on_ties(spark):
    found = names(
        spark, ("T", "b"), ("T", "a"), ("T", "A "), ("T", "B"), (" m", "red CUP"), ("M", "red cup"),
        ("m", "x"), ("E", None), ("E", "  "), ("", "loose"),
    )
    assert found == {"T": "A", "M": "Red Cup", "": "Loose"}


def test_spellings_of_a_rejected_row_count_but_make_no_product(spark):
    feed = make(
        spark,
        line(code="A", description="one"),
        line(code="A", description="two", quantity="x"),
        line(code="A", description="two", quantity="x"),
        line(code="B", description="gone", date="x"),
        line(code="C", description=None),
    )
    found = {tuple(r) for r in catalogue.build_products(route(feed)).collect()}
    assert found == {("A", "Two", "UNCATEGORIZED"), ("C", "UNKNOWN", "UNCATEGORIZED")}


def test_categories(one):
    cases = {
        "Gift Wrap": "HOGAR", "Led Light": "ELECTRONICA", "Cardigan": "PAPELERIA",
        "Opener": "PAPELERIA", "Sealed": "ELECTRONICA", "Warm Scarf": "ROPA", "Kite": "DEPORTES",
        "": "UNCATEGORIZED", "Unknown": "UNCATEGORIZED", "Zzz": "UNCATEGORIZED",
        None: "UNCATEGORIZED",
    }
    assert one(catalogue.category_of, list(cases)) == list(cases.values())


def test_category_histogram_counts_rows(spark):
    feed = make(
        spark, line("1", "A", "pen"), line("2", "A", "pen"), line("3", "B", "cup", quantity="-1")
    )
    routed = route(feed)
    rows = catalogue.category_histogram(keep(routed), catalogue.build_products(routed)).collect()
    assert {tuple(r) for r in rows} == {("SALE", "PAPELERIA", 2), ("RETURN", "HOGAR", 1)}


def test_variants(spark):
    routed = route(make(spark, line(description="a"), line(description=" A"), line(description="a ")))
    answer = catalogue.description_variants(routed, catalogue.build_products(routed)).collect()
    assert [tuple(r) for r in answer] == [("A", "A", 2, "UNCATEGORIZED")]


# Dedup -------------------------------------------------------------------------------


def test_best_source_wins_and_null_keys_are_equal(spark):
    rows = spark.createDataFrame(
        [
            ("1", "A", "history_csv", 1.0), ("1", "A", "sales_csv", 9.0),
            ("2", "A", "other", 3.0), ("2", "A", "history_csv", 4.0),
            (None, "A", "sales_csv", 6.0), (None, "A", "sales_csv", 5.0),
            ("3", "A", None, 7.0),
        ],
        "invoice_no string, stock_code string, _source string, quantity double",
    )
    kept = deduplicate(rows, tie_break=["quantity"])
    assert sorted((r.invoice_no or "-", r.quantity) for r in kept.collect()) == [
        ("-", 5.0), ("1", 9.0), ("2", 4.0), ("3", 7.0),
    ]
    assert kept.exceptAll(deduplicate(kept, tie_break=["quantity"])).count() == 0


def test_priority_rank_follows_the_given_list(one):
    rank = lambda c: priority_rank(c, ["b", "a"])
    assert one(rank, ["a", "b", "c", None]) == [1, 0, None, None]


def test_a_hot_key_is_cut_before_the_shuffle(spark):
    rows = spark.range(1000).select(
        F.hex(F.pmod("id", F.lit(1))).alias("invoice_no"), F.lit("A").alias("stock_code"),
        F.lit("sales_csv").alias("_source"), F.col("id").cast("double").alias("quantity"),
    )
    kept = deduplicate(rows, tie_break=["quantity"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below and "Partial" in below
    assert [r.quantity for r in kept.collect()] == [0.0]


# Star schema --------------------------------------------------------------------------


def test_fact_truncates_quantity_but_not_revenue(spark):
    kept = keep(route(make(
        spark, line("1", quantity="1.5", price="2.00"), line("2", quantity="0", price="3"),
        line("3", quantity="-2", price="-1"), line(None, quantity="1", price="2.55555"),
    )))
    rows = {r.invoice_no: r for r in star.build_fact(kept).collect()}
    assert (rows["1"].quantity, float(rows["1"].gross_revenue)) == (1, 3.0)
    assert (rows["2"].transaction_type, float(rows["2"].gross_revenue)) == ("RETURN", 0.0)
    assert (rows["3"].quantity, float(rows["3"].gross_revenue)) == (-2, 2.0)
    assert float(rows[None].unit_price) == 2.5556
    assert {r.invoice_no for r in star.build_fact(kept, "None").collect()} == {"1", "2", "3", "None"}


def test_fact_from_split_frames_is_the_same(spark):
    feed = make(spark, line("1"), line("2", quantity="-3"))
    sales, returns, _ = transform(feed, "2024-01-01")
    columns = star.build_fact(keep(route(feed))).columns
    split = star.build_fact_from_split(sales, returns).select(*columns)
    assert sorted(split.collect()) == sorted(star.build_fact(keep(route(feed))).collect())


def test_daily_sums_count_returns_with_absolute_values(spark):
    kept = keep(route(make(
        spark, line("1", quantity="2", price="5"), line("2", quantity="-1", price="4"),
        line("3", quantity="-1", price="-3"),
    )))
    (row,) = star.build_daily_revenue(star.build_fact(kept)).collect()
    sums = [float(row[c]) for c in ("gross_revenue", "return_amount", "net_revenue")]
    assert sums == [10.0, 7.0, 9.0]
    assert (row.total_sales_qty, row.total_return_qty) == (2, 2)


def test_first_country_comes_from_sales(spark):
    kept = keep(route(make(
        spark, line("1", quantity="-1", country="R", date="1/1/2010 1:00"),
        line("2", country="S", date="1/1/2011 1:00"), line("3", country="T", date="1/1/2012 1:00"),
        line("4", customer=None, country="U"),
    )))
    assert {tuple(r) for r in star.build_customers(kept).collect()} == {
        ("7", "S", False), ("ANONYMOUS", "U", True),
    }


def test_classified_frames_have_a_category(spark):
    sales, returns, rejects = transform_and_classify(
        make(spark, line("1", description="pen"), line("2", quantity="-1"), line(date="x")), "2024-01-01"
    )
    assert [r.category for r in sales.collect()] == ["PAPELERIA"]
    assert [r.return_amount for r in returns.collect()] == [1.5]
    assert [r._pipeline_run_date for r in rejects.collect()] == ["2024-01-01"]


# Merges ----------------------------------------------------------------------------------


def test_upsert_keeps_and_overwrites(spark):
    schema = "k string, name string, created int, updated int"
    old = spark.createDataFrame([("a", "old", 1, 1), ("b", "same", 1, 1)], schema)
    new = spark.createDataFrame([("a", None, 2, 2), ("c", "new", 2, 2)], schema)
    merged = merge.upsert(old, new, ["k"], ["name", "updated"])
    assert {tuple(r) for r in merged.collect()} == {
        ("a", None, 1, 2), ("b", "same", 1, 1), ("c", "new", 2, 2),
    }


def test_insert_if_absent(spark):
    schema = "k string, v int"
    old = spark.createDataFrame([("a", 1), (None, 1)], schema)
    new = spark.createDataFrame([("a", 2), ("b", 4), ("b", 3), (None, 5)], schema)
    order = [F.col("v").asc()]
    rows = merge.absent_rows(old, new, ["k"], order, null_safe=True)
    assert [tuple(r) for r in rows.collect()] == [("b", 3)]
    rows = merge.absent_rows(old, new, ["k"], order)
    assert {tuple(r) for r in rows.collect()} == {("b", 3), (None, 5)}


def test_surrogate_keys_are_unique_and_above_the_stored(spark):
    keyed = merge.with_surrogate_key(spark.range(50).toDF("n"), "id", 41)
    ids = [r.id for r in keyed.collect()]
    assert len(set(ids)) == 50 and min(ids) == 42


# Checks -----------------------------------------------------------------------------------


def test_checks_return_what_breaks_the_rules(spark):
    rows = spark.createDataFrame(
        [("a", 1.0), ("a", 2e10), (None, 3.0), (None, None), ("toolong", 5.0)], "k string, v double"
    )
    parent = spark.createDataFrame([("a",)], "k string")
    assert [tuple(r) for r in checks.duplicate_keys(rows, ["k"]).collect()] == [("a", 2)]
    assert [tuple(r) for r in checks.orphan_keys(rows, "k", parent).collect()] == [("toolong", 1)]

    def found(rules):
        return {r.rule: r.violations for r in checks.violations(rows, rules).collect()}

    assert found(checks.null_rules(["k", "v"])) == {"k": 2, "v": 1}
    assert found(checks.range_rules({"v": "int"})) == {"v": 1}
    assert found(checks.length_rules({"k": 3})) == {"k": 1}


def test_fact_rules_see_what_does_not_fit(spark):
    kept = keep(route(make(
        spark, line("1"), line("x" * 21), line("2", quantity="3e9"), line("3", price="1e7"),
        line(None), line("4", customer="c" * 30),
    )))
    rules = checks.fact_rules(kept)
    broken = {r.rule: r.violations for r in checks.violations(kept, rules).collect() if r.violations}
    assert broken == {
        "length:invoice_no": 1, "range:quantity": 1, "range:unit_price": 1, "null:invoice_no": 1,
        "length:customer_id": 1,
    }


# Percentiles --------------------------------------------------------------------------------


@pytest.mark.parametrize("fraction", [0.0, 0.5, 0.75, 1.0])
def test_percentiles_are_exact(spark, fraction):
    random.seed(3)
    # A third of the values are the same, as with a return rate of zero.
    values = [0.0 if n % 3 == 0 else random.gauss(0, 100) for n in range(301)]
    rows = spark.createDataFrame(list(enumerate(values)), "k int, v double").repartition(5)
    answer = exact_percentiles(rows, ["v"], fraction, ["k"])
    assert float(answer["v"]) == pytest.approx(np.percentile(values, fraction * 100), abs=1e-9)


def test_percentiles_of_nothing(spark):
    empty = spark.createDataFrame([], "k int, v double")
    assert exact_percentiles(empty, ["v"], 0.5, ["k"]) == {"v": None}


def test_a_product_on_the_limit_is_a_candidate(spark):
    # Five products: the fourth is the 75th percentile, also where a double is not exact.
    gross = ["1.00", "2.00", "3.00", "12345679.38", "99999999.99"]
    daily = [(f"P{n}", Decimal(g), Decimal("1.00"), Decimal(g), 10, n)
             for n, g in enumerate(gross)]
    tables = {
        "agg_daily_revenue": spark.createDataFrame(
            daily,
            "product_code string, gross_revenue decimal(18,2), return_amount decimal(18,2), "
            "net_revenue decimal(18,2), total_sales_qty int, total_return_qty int",
        ),
        "dim_products": spark.createDataFrame(
            [(d[0], d[0], "HOGAR") for d in daily],
            "product_code string, canonical_name string, category string",
        ),
    }
    assert [r.product_code for r in q7_review_candidates(tables).collect()] == ["P3", "P4"]
    assert q7_limits(tables).first().asDict() == {
        "gross_revenue": 12345679.38, "tasa_devolucion_pct": 30.0,
    }


def test_keywords_are_texts_and_not_patterns(spark):
    rows = spark.createDataFrame([("size 125",), ("size 1.5",), ("CCC",), ("C++",)], "d string")
    words = {"SIZE": ["1.5"], "LANGUAGE": ["c++"]}
    found = rows.select(catalogue.category_of(F.col("d"), words)).collect()
    assert [r[0] for r in found] == ["UNCATEGORIZED", "SIZE", "UNCATEGORIZED", "LANGUAGE"]


def test_review_candidates_are_those_of_both_top_quarters(spark):
    random.seed(5)
    daily = [
        (f"P{n}", float(random.randint(10, 999)), float(random.randint(0, 50)), 10.0,
         random.randint(8, 90), random.randint(0, 40))
        for n in range(60)
    ]
    tables = {
        "agg_daily_revenue": spark.createDataFrame(
            daily,
            "product_code string, gross_revenue double, return_amount double, net_revenue double, "
            "total_sales_qty int, total_return_qty int",
        ),
        "dim_products": spark.createDataFrame(
            [(d[0], d[0].lower(), "HOGAR") for d in daily],
            "product_code string, canonical_name string, category string",
        ),
    }
    small = q7_review_candidates(tables).collect()
    assert small

    sold = [d for d in daily if d[4] >= 10]
    rate = {d[0]: round(d[5] / d[4] * 100 + 1e-9, 2) for d in sold}
    gross_limit = np.percentile([d[1] for d in sold], 75)
    rate_limit = np.percentile(list(rate.values()), 75)
    wanted = [d for d in sold if d[1] >= gross_limit and rate[d[0]] >= rate_limit - 1e-9]
    wanted.sort(key=lambda d: (-d[2], d[0]))
    assert [r.product_code for r in small] == [d[0] for d in wanted[:15]]


def test_cleansed_values_are_parsed_once(spark):
    """Filters on parsed values must not copy the parsing below themselves."""
    rows = validate(cleanse(make(spark, line()))).filter("_reject_reason is null")
    plan = rows.select("quantity", "unit_price")._jdf.queryExecution().optimizedPlan().toString()
    filters = [row for row in plan.splitlines() if "Filter" in row]
    assert filters and not any("try_cast" in row or "RLIKE" in row for row in filters)
