"""Whitening of vectors by their leading principal components, found by spectrum slicing.

The covariance is exact: whole vectors are centred at their mean rounded to
whole numbers before anything is multiplied, tasks sum whole products, and the
rest of the mean (under one half) is taken off in whole numbers too. So it does
not depend on the order of the rows, and reruns agree to the last bit. Only its
d * (d + 1) / 2 sums reach the driver, however many rows there are.

There the leading eigenpairs are sliced out one by one. By Sylvester's law of
inertia, the pivots of an LDL^T factorisation of V - s*I (symmetric pivoting,
blocks of one or two) tell how many eigenvalues lie above s. Bisection on these
counts leaves an interval that holds only the k-th eigenvalue, or one as narrow
as rounding allows, for equal eigenvalues. Rayleigh quotient iteration then
converges cubically from a vector of an inverse iteration inside that interval,
orthogonal to the vectors found before; a quotient that leaves the interval
sends it back to bisection. Two more counts, just below and above the value
found, certify that it is the k-th.

Defined cases: rows with a null vector or with null or non-finite entries are
dropped; shorter vectors count as padded with zeros; a null id is carried on;
repeated rows count as often as they occur and get equal results; components
whose eigenvalue is too small to be told from rounding (under ``NOTHING`` of the
trace) cannot be whitened and are left out, so constant vectors and empty tables give no row.
Entries that do not fit a double's whole numbers stop the job, a deviation that
does not fit a long is null. Other columns are not read.
"""

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import read_table, staged
from ledgerloom.llm.hard_negatives import usable, vectors_of

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
# Share of the trace below which rounding leaves an eigenvalue less than four sure digits.
NOTHING = 1e-9
WHOLE = 2.0**53


# Exact moments ---------------------------------------------------------------


def whole(column, width):
    """Entries as whole doubles: floor(SCALE * c) + SHIFT."""
    x = np.floor(SCALE * vectors_of(column, width)) + SHIFT
    if np.abs(x).max(initial=0) >= WHOLE:
        raise ValueError("entries too large for exact sums")
    return x


def exact_product(y):
    """y.T @ y in whole numbers: as doubles where all sums fit, else as Python integers."""
    if len(y) * np.abs(y).max(initial=0) ** 2 < WHOLE:
        return (y.T @ y).astype(np.int64).astype(object)
    y = y.astype(np.int64).astype(object)
    return y.T @ y


def summed(rows: DataFrame, per_batch, size) -> list[int]:
    """Whole sums, over all rows, of the ``size`` numbers that ``per_batch`` gives for a batch."""

    def work(batches):
        total = np.zeros(size, object)
        for batch in batches:
            total = total + per_batch(batch.column("vector"))
        values = pa.array([int(v) for v in total], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), values], ["place", "value"])

    found = rows.select("vector").mapInArrow(work, "place int, value decimal(38,0)")
    out = [0] * size
    for place, value in found.groupBy("place").agg(F.sum("value")).collect():  # ``size`` rows
        out[place] = int(value)
    return out


def moments(rows: DataFrame, width: int):
    """Number of rows n, sums S, and n * n times the covariance, all whole numbers."""

    def sums(column):
        x = whole(column, width)
        if len(x) * np.abs(x).max(initial=0) < WHOLE:
            total = x.sum(axis=0).astype(np.int64).astype(object)
        else:
            total = x.astype(np.int64).astype(object).sum(axis=0)
        return np.concatenate([[len(x)], total])

    n, *total = summed(rows, sums, width + 1)
    if not n:
        return 0, total, np.zeros((width, width), object)
    centre = [round(Fraction(s, n)) for s in total]
    shift = np.array(centre, np.float64)
    upper = np.triu_indices(width)
    products = summed(rows, lambda c: exact_product(whole(c, width) - shift)[upper], len(upper[0]))
    rest = [s - n * c for s, c in zip(total, centre)]
    covariance = np.zeros((width, width), object)
    for i, j, value in zip(*map(np.ndarray.tolist, upper), products):
        covariance[i, j] = covariance[j, i] = n * value - rest[i] * rest[j]
    return n, total, covariance


# Spectrum slicing ------------------------------------------------------------


def count_above(matrix, shift) -> int:
    """How many eigenvalues of a symmetric matrix are above ``shift``: positive pivots of LDL^T."""
    a = matrix - shift * np.eye(len(matrix))
    tiny = np.finfo(float).eps * max(np.abs(matrix).max(), abs(shift), np.finfo(float).tiny)
    growth = (1 + 17**0.5) / 8  # Bunch and Kaufman's choice between blocks of one and two
    positive = 0
    while len(a):
        n = len(a)
        below = np.abs(a[1:, 0])
        r = 1 + int(below.argmax()) if n > 1 else 0
        largest = below[r - 1] if n > 1 else 0.0
        block = 1
        if largest > tiny and abs(a[0, 0]) < growth * largest:
            row = np.abs(a[r])
            row[r] = 0
            if abs(a[0, 0]) * row.max() < growth * largest**2:
                if abs(a[r, r]) >= growth * row.max():
                    order = [r, *(i for i in range(n) if i != r)]
                else:
                    block = 2
                    order = [0, r, *(i for i in range(1, n) if i != r)]
                a = a[np.ix_(order, order)]
        if block == 1:
            pivot = a[0, 0]
            if abs(pivot) <= tiny:  # no eigenvalue is told from the shift; count it as below
                a = a[1:, 1:]
                continue
            positive += pivot > 0
            a = a[1:, 1:] - np.outer(a[1:, 0], a[0, 1:]) / pivot
        else:
            pivots = a[:2, :2]
            positive += int((np.linalg.eigvalsh(pivots) > 0).sum())
            a = a[2:, 2:] - a[2:, :2] @ np.linalg.solve(pivots, a[:2, 2:])
    return positive


def rounding(matrix):
    """A bound for the error of an eigenvalue or residual that rounding alone explains."""
    return 4 * len(matrix) * np.finfo(float).eps * np.abs(matrix).sum(axis=1).max()


def quotient_iteration(matrix, vector, found, low, high):
    """Rayleigh quotient iteration orthogonal to ``found``; None if it leaves [low, high].

    The first steps keep the interval's middle as shift, so that a start almost
    orthogonal to the wanted vector is turned towards it.
    """

    def cleaned(v):
        for _ in range(2):
            v = v - found @ (found.T @ v)
        return v / np.linalg.norm(v)

    vector = cleaned(vector)
    # What is orthogonal to vectors with errors of their own carries those errors too.
    eye, error = np.eye(len(matrix)), rounding(matrix) * (1 + found.shape[1] ** 0.5)
    shift, reached = (low + high) / 2, None
    for step in range(40):
        try:
            solved = np.linalg.solve(matrix - shift * eye, vector)
        except np.linalg.LinAlgError:  # the shift is an eigenvalue: move it by rounding
            solved = np.linalg.solve(matrix - (shift + error / 4) * eye, vector)
        vector = cleaned(solved)
        value = vector @ matrix @ vector
        inside = low - error <= value <= high + error
        if step > 3 and not inside:
            return None if reached is None else reached[1:]
        residual = np.linalg.norm(matrix @ vector - value * vector)
        if reached is not None and residual >= reached[0]:
            return reached[1:]
        if inside and residual <= error:
            if residual <= error / 64:
                return value, vector
            reached = residual, value, vector  # go on while that helps
        if step >= 3:
            shift = value
    return None if reached is None else reached[1:]


def leading_pairs(matrix, wanted):
    """The ``wanted`` largest eigenvalues, falling, with unit eigenvectors, certified by counts."""
    n = len(matrix)
    scale = np.abs(matrix).sum(axis=1).max()
    narrow = 4 * rounding(matrix) * (1 + wanted**0.5)
    values, vectors = [], np.zeros((n, 0))
    start = np.random.default_rng(0).standard_normal((n, wanted))
    for k in range(1, wanted + 1):
        # Invariant: count above low >= k, count above high < k.
        low, high = -scale - narrow, values[-1] + narrow if values else scale + narrow
        above_low, above_high = n, count_above(matrix, high)
        while True:
            while high - low > narrow and (above_low != k or above_high != k - 1):
                middle = (low + high) / 2
                count = count_above(matrix, middle)
                if count >= k:
                    low, above_low = middle, count
                else:
                    high, above_high = middle, count
            pair = quotient_iteration(matrix, start[:, k - 1], vectors, low, high)
            if pair is not None:
                value, vector = pair
                # A neighbour at the very end of the interval is not the k-th: the counts tell.
                if count_above(matrix, value + narrow) < k <= count_above(matrix, value - narrow):
                    break
            if high - low <= narrow:
                raise ArithmeticError(f"eigenvalue {k} was isolated but not reached")
            middle = (low + high) / 2
            count = count_above(matrix, middle)
            if count >= k:
                low, above_low = middle, count
            else:
                high, above_high = middle, count
        values.append(value)
        vectors = np.column_stack([vectors, vector])
    return np.array(values), vectors


# The operator ----------------------------------------------------------------

RESULT = (
    "vec_id {id}, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def whitened(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, n, deviation and the array ``z`` of whitened values of rows of vec_id and vector.

    Returns the rows, staged, and each component's share of the variance.
    """
    kind = rows.schema["vec_id"].dataType.simpleString()
    width = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    n, total, covariance = moments(rows, width)
    trace = sum(covariance.diagonal().tolist())
    if not trace:
        return None, []
    matrix = (covariance / (n * n)).astype(np.float64)  # each entry rounded once
    real = count_above(matrix, NOTHING * (trace / (n * n)))
    values, vectors = leading_pairs(matrix, min(components, width, real))
    shares = [float(Fraction(v) * n * n / trace) for v in values]
    projection = vectors / np.sqrt(values)
    # n * x - S without overflow: x and S are taken against the rounded mean first.
    centre = [round(Fraction(s, n)) for s in total]
    rest = [s - n * c for s, c in zip(total, centre)]
    shift, remainder = np.array(centre, np.float64), np.array([r / n for r in rest])

    def work(batches):
        for batch in batches:
            y = whole(batch.column("vector"), width) - shift
            z = (y - remainder) @ projection
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    pa.array(deviations(y), pa.int64()),
                    pa.FixedSizeListArray.from_arrays(pa.array(z.ravel()), z.shape[1]).cast(pa.list_(pa.float64())),
                ],
                ["vec_id", "deviation", "z"],
            )

    def deviations(y):
        """Sum of (n * y - rest)^2 of each row; null where it does not fit a long."""
        most = n * int(np.abs(y).max(initial=0)) + max(map(abs, rest))
        if width * most * most < 2**63:
            d = n * y.astype(np.int64) - np.array(rest, np.int64)
            return (d * d).sum(axis=1)
        d = n * y.astype(np.int64).astype(object) - np.array(rest, object)
        return [int(v) if v < 2**63 else None for v in (d * d).sum(axis=1)]

    out = rows.select("vec_id", "vector").mapInArrow(work, f"vec_id {kind}, deviation long, z array<double>")
    return staged(out.withColumn("n", F.lit(n).cast("long")), "whitened"), shares


def identity_error(rows: DataFrame, size: int) -> float:
    """Largest absolute entry of the covariance of ``z`` minus the identity, centred first."""
    at = [F.get("z", F.lit(i)) for i in range(size)]
    means = rows.agg(*[F.avg(z).alias(f"m{i}") for i, z in enumerate(at)]).first()
    apart = [z - F.lit(m) for z, m in zip(at, means)]
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    found = rows.agg(*[F.avg(apart[i] * apart[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(value - (i == j)) for value, (i, j) in zip(found, pairs))


def op13_whitened_embeddings(spark, sf_dir: str) -> DataFrame:
    """Every usable vector on the eight leading components of all usable vectors."""
    rows = read_table(spark, sf_dir, "embeddings").where(usable(F.col("embedding")))
    rows = rows.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    found, shares = whitened(rows)
    if found is None:
        return spark.createDataFrame([], RESULT.format(id=rows.schema["vec_id"].dataType.simpleString()))
    error = identity_error(found, len(shares))
    explained = F.array(*[F.lit(s) for s in shares])
    return found.select("vec_id", "n", "deviation", F.posexplode("z").alias("place", "whitened")).select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        "n",
        "deviation",
        "whitened",
        F.get(explained, "place").alias("explained"),
        F.lit(error).alias("identity_error"),
    )
