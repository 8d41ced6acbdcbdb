"""Hard negatives and whitening against brute force, with odd rows."""

from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.llm import hard_negatives, registry, whitening
from ledgerloom.llm.hard_negatives import usable

FOLDER = "/root/testdata/sf0.01"
NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, label int, x string, id string, number string"


def odd_rows():
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(5).round(2).tolist(), int(rng.integers(0, 3))) for i in range(120)]
    rows += [(200 + i, rows[0][1], i % 2) for i in range(40)]  # ties
    rows += [rows[0], rows[50], rows[50]]  # repeated rows, anchors too
    rows += [(300, [0.0] * 5, 1), (350, [0.0] * 5, 0), (400, [1.0, 2.0], 1), (450, [], 1)]
    rows += [(500, None, 1), (550, [1.0, None, 0.0, 0.0, 0.0], 1), (600, [NAN] * 5, 1), (650, [1.0, INF, 0.0, 0.0, 0.0], 0)]
    rows += [(None, [0.5] * 5, 1), (700, [0.5] * 5, None), (750, [0.25] * 5, 2)]
    return rows


def brute_negatives(rows):
    """All result rows of op11, by comparing everything."""
    held = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or not all(v is not None and np.isfinite(v) for v in vector):
            continue
        x = [int(np.floor(256 * float(np.float32(v)))) for v in vector] + [0] * (5 - len(vector))
        held.append((vec_id, (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label, x))
    key = lambda pair: (-pair[0], pair[1] is None, pair[1] or 0)
    out = []
    for a, (anchor, label, x) in enumerate(held):
        if anchor is None or anchor % 50:
            continue
        scores = [(sum(p * q for p, q in zip(x, y)), i, other) for b, (i, other, y) in enumerate(held) if b != a]
        positives = sorted(((s, i) for s, i, other in scores if other == label), key=key)[:5]
        for score, positive in positives:
            fits = [(s, i) for s, i, other in scores if other != label and 50 * score <= 100 * s <= 95 * score]
            for rank, (s, i) in enumerate(sorted(fits, key=key)[:3], 1):
                out.append((anchor, positive, rank, i, score, s))
    return out


def written(spark, tmp_path, rows):
    values = [(i, v, label, "x", "id", "n") for i, v, label in rows]
    spark.createDataFrame(values, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    return str(tmp_path)


def order(rows):
    return sorted(rows, key=lambda r: [(v is None, v or 0) for v in r])


@pytest.mark.parametrize("sizes", [{}, {"TILE": 16, "LEAF": 4, "FAN": 2, "WAVE": 3, "BLOCK": 2}])
def test_negatives_of_odd_rows(spark, tmp_path, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(hard_negatives, name, value)
    monkeypatch.setattr(hard_negatives.tiled, "__defaults__", (sizes.get("LEAF", hard_negatives.LEAF),))
    found = registry.QUERIES["op11_hard_negatives"](spark, written(spark, tmp_path, odd_rows())).collect()
    expected = brute_negatives(odd_rows())
    assert len(expected) > 30
    assert order(map(tuple, found)) == order(expected)


def test_empty_tables(spark, tmp_path):
    folder = written(spark, tmp_path, [])
    for name in ("op11_hard_negatives", "op13_whitened_embeddings"):
        frame = registry.QUERIES[name](spark, folder)
        assert frame.count() == 0 and "vec_id" in frame.columns or "anchor_id" in frame.columns


def test_boxes_bound_the_products_of_their_rows():
    rng = np.random.default_rng(0)
    x, labels = rng.integers(-300, 300, (700, 6)).astype(float), rng.integers(0, 4, 700)
    tree = hard_negatives.grown(x, labels, np.arange(700), np.arange(700))
    under = {}
    for node in range(len(tree["first"])):
        members = range(tree["first"][node], tree["last"][node])
        under[node] = list(members) if node < tree["leaves"] else [r for m in members for r in under[m]]
        part = tree["x"][under[node]]
        assert (tree["low"][node] == part.min(axis=0)).all() and (tree["high"][node] == part.max(axis=0)).all()
    assert sorted(under[len(tree["first"]) - 1]) == list(range(700))


def test_whitening_against_numpy(spark):
    found = registry.QUERIES["op13_whitened_embeddings"](spark, FOLDER).toPandas()
    found = found.sort_values(["vec_id", "component"])
    table = pd.read_parquet(f"{FOLDER}/embeddings.parquet").sort_values("vec_id")
    x = np.floor(1024 * np.stack(table.embedding).astype(float)).astype(np.int64) + 100_000
    n, apart = len(x), len(x) * x - x.sum(axis=0)
    assert (found.n == n).all() and len(found) == 8 * n
    assert (found.deviation.to_numpy().reshape(n, 8) == (apart**2).sum(axis=1)[:, None]).all()
    covariance = (apart / n).T @ (apart / n) / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    ours, theirs = found.whitened.to_numpy().reshape(n, 8), (apart / n) @ vectors / np.sqrt(values)
    signs = np.sign((ours * theirs).sum(axis=0))
    assert np.abs(ours - signs * theirs).max() < 1e-9
    share = found.explained.to_numpy().reshape(n, 8)[0]
    assert np.abs(share / (values / covariance.trace()) - 1).max() < 1e-9
    assert found.identity_error.max() < 1e-9 and found.identity_error.nunique() == 1


def test_whitening_of_odd_rows(spark, tmp_path):
    rows = [(i, v, label) for i, v, label in odd_rows()]
    found = registry.QUERIES["op13_whitened_embeddings"](spark, written(spark, tmp_path, rows)).toPandas()
    vectors = [v for _, v, _ in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    assert len(found) == 5 * len(vectors) and (found.n == len(vectors)).all()
    assert found.vec_id.isna().sum() == 5 and found.identity_error.max() < 1e-9
    x = [[int(np.floor(1024 * float(np.float32(c)))) + 100_000 for c in v] + [100_000] * (5 - len(v)) for v in vectors]
    sums = [sum(column) for column in zip(*x)]
    deviations = sorted(sum((len(x) * c - s) ** 2 for c, s in zip(row, sums)) for row in x)
    assert sorted(found[found.component == 1].deviation) == deviations
    # All rows alike: nothing varies, so no component is left.
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "vec_id long, vector array<double>")
    assert whitening.whitened(same)[0] is None
    # A dimension that is a copy of another: one component less.
    flat = spark.createDataFrame([(i, [float(i), float(i)]) for i in range(50)], "vec_id long, vector array<double>")
    assert len(whitening.whitened(flat)[1]) == 1


def test_moments_are_exact_beyond_doubles(spark):
    values = [(i, [float(2**33 + 3 * i), float(-(2**35) + i * i)]) for i in range(40)]
    frame = spark.createDataFrame(values, "vec_id long, vector array<double>")
    n, sums, scaled = whitening.moments(frame, 2)
    x = [[1024 * int(c) + 100_000 for c in v] for _, v in values]
    assert sums == [sum(c) for c in zip(*x)]
    for i in range(2):
        for j in range(2):
            exact = sum((r[i] - Fraction(sums[i], n)) * (r[j] - Fraction(sums[j], n)) for r in x) / n
            assert Fraction(scaled[i, j], n * n) == exact


def symmetric(values, seed):
    basis, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values),) * 2))
    return (basis * values) @ basis.T


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(-6, 6), min_size=1, max_size=9), st.integers(0, 10**6), st.integers(-7, 6))
def test_inertia_counts(values, seed, below):
    matrix = symmetric(np.array(values, float), seed)
    matrix = (matrix + matrix.T) / 2
    assert whitening.count_above(matrix, below + 0.5) == sum(v > below + 0.5 for v in values)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=2, max_size=9), st.integers(0, 10**6))
def test_leading_pairs_of_equal_and_zero_eigenvalues(values, seed):
    matrix = symmetric(np.array(values, float) + 1, seed)
    matrix = (matrix + matrix.T) / 2
    found, vectors = whitening.leading_pairs(matrix, len(values))
    assert np.abs(found - np.sort(np.array(values) + 1)[::-1]).max() < 1e-12
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-12


def test_usable(spark):
    rows = [([1.0],), ([],), (None,), ([None],), ([NAN],), ([-INF],)]
    frame = spark.createDataFrame(rows, "v array<double>").select(usable(F.col("v")).alias("ok"))
    assert [r.ok for r in frame.collect()] == [True, True, False, False, False, False]
