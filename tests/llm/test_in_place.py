"""Stages that judge documents where they are, against joins of all rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import mixing, quality_model, simhash
from ledgerloom.llm.common import staged

SCHEMA = "doc_id long, text string, source string, note map<string,int>, row timestamp"


def rows(repeats):
    """Sources of unlike size, null ids and sources, and one row many times with unlike further columns."""
    made = [(i, f"w{i} " * (1 + i % 7), "abc"[i % 3], {"k": i}, None) for i in range(120)]
    made += [(None, f"n{i % 5} " * 3, "a", None, None) for i in range(20)]
    made += [(500, "one two three", None, {"k": i % 4}, None) for i in range(repeats)]
    return made + [(600, "", "a", None, None), (601, None, "b", None, None)]


def counted(frame):
    return Counter(str(r) for r in frame.collect())


@pytest.mark.parametrize("repeats", [0, 300])
@pytest.mark.parametrize("most", [1, 3])
def test_mixed_documents_are_those_the_plan_takes(spark, repeats, most):
    docs = spark.createDataFrame(rows(repeats), SCHEMA)
    found = mixing.mix_documents(docs, max_repeats=most)
    assert found.columns == docs.columns
    sizes = staged(mixing.sized(docs).drop("row"), "sizes")
    plan = mixing.plan_mix(sizes, max_repeats=most)
    by = ("doc_id", "source", "size", "tie")
    wanted = plan.attach(sizes).groupBy(*by).agg(F.sum("times").alias("n")).where("n > 0")
    again = mixing.sized(found).groupBy(*by).agg(F.count("*").alias("n"))
    assert counted(again.select(*by, "n")) == counted(wanted.select(*by, "n"))
    # No row is taken more often than it is there.
    there, taken = counted(docs), counted(found)
    assert all(taken[r] <= most * there[r] for r in taken)


def test_a_cut_among_equal_rows_takes_some_of_them(spark):
    docs = spark.createDataFrame([(1, "a b", "s", {"k": i}, None) for i in range(9)], SCHEMA)
    found = mixing.mix_documents(docs, max_repeats=1)
    assert counted(found) == counted(docs)
    half = docs.unionByName(spark.createDataFrame([(2, "c " * 90, "t", None, None)], SCHEMA))
    plan = mixing.plan_mix(staged(mixing.sized(half).drop("row"), "sizes"))
    times = plan.attach(mixing.sized(half).drop("row")).where("doc_id = 1").agg(F.sum("times")).first()[0]
    assert mixing.mix_documents(half).where("doc_id = 1").count() == times


def test_mix_of_documents_moves_no_text(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    plan = mixing.mix_documents(docs)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


@pytest.mark.parametrize("words", [1, 1 << 18])
def test_one_document_of_each_component_stays(spark, monkeypatch, words):
    """Also with so few marks that almost all rows are dealt."""
    monkeypatch.setattr(simhash, "MARK_WORDS", words)
    made = [r for r in rows(30) for _ in range(1 + (r[0] or 0) % 2)]
    made += [(1000 + i, "same words in every one of these", "a", None, None) for i in range(60)]
    docs = spark.createDataFrame(made, SCHEMA)
    found = simhash.drop_near_duplicates(docs)
    assert found.columns == docs.columns
    known = simhash.near_duplicates(docs)
    wanted = {r[0] for r in known.where("component_id IS NOT NULL").select("component_id").distinct().collect()}
    kept = found.collect()
    assert {r.doc_id for r in kept if r.doc_id is not None} == wanted
    prints = known.select("fp", "component_id").distinct()
    groups = simhash.classes(staged(known.select("doc_id", "fp"), "prints"))
    assert len(kept) == groups.select("root").distinct().count() and prints.count() > 0


def test_the_classifiers_passes_are_in_stages_of_their_own(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"some words {i}") for i in range(40)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) quality")
    seen = []
    collected = quality_model.moments
    monkeypatch.setattr(quality_model, "moments", lambda rows: (seen.append(rows), collected(rows))[1])
    quality_model.train(docs, labels)
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    # However small the labels are: beside a broadcast, a task would hold the workers of both passes.
    assert "BroadcastHashJoin" not in plan
    assert plan.index("ShuffledHashJoin") < plan.index("Exchange") < plan.index("MapInArrow")
