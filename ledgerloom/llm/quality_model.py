"""A quality classifier from positives and unlabelled text.

Risk: the non-negative positive-unlabelled estimate with squared loss,

    prior * E_P[(1 - g)^2 / 4] + max(0, E_U[(1 + g)^2 / 4] - prior * E_P[(1 + g)^2 / 4]),

for a score g that is linear in a fixed set of bounded features. All three
terms are quadratic in the weights, so first and second moments of the features
over all positives and over all unlabelled documents say everything: one pass
collects them (their number does not depend on the input), and the driver
minimises the risk exactly. If the unbiased minimum has a negative second term,
the minimum lies where that term is zero, found by bisection over its
multiplier. The class prior is the share of positives among the training labels.

Features are counts over the whole text only (character classes, words,
repeats), never label, language, source or id.

Defined cases: null and empty texts have all counts zero and are scored like
any other; a null doc_id counts as an empty one (so it is held out) and has no
label; several labels of an id count as positive if one is; labels that are
null are ignored; without any positive all scores are 0.5; repeated rows get
equal scores; an empty table gives an empty result. Input columns are carried
in one struct by :func:`drop_low_quality`, so their names do not matter.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import pieces, read_table, utf8, window_hashes, word_hashes, word_spans

FOLDS = 5
THRESHOLD = 0.3
RIDGE = 1e-3
# Logistic curve through score 0.3 where the risk's minimiser says 0.3 (g = 2 * 0.3 - 1).
STEEPNESS = np.log(0.7 / 0.3) / 0.4

CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "symbol": b"#$%&*+<=>@\\^_`{|}~",
    "bar": b"|",
    "shout": b"!?",
    "stop": b".",
    "comma": b",;:",
    "quote": b"\"'()[]-/",
    "break": b"\n",
    "foreign": bytes(range(128, 256)),
}
TABLE = np.array([np.isin(np.arange(256), list(c)) for c in CLASSES.values()])
STEPS = (0.01, 0.03, 0.1, 0.3)
LENGTHS = (3, 10, 30, 100, 300, 1000, 3000)


def ratios(column):
    """Base statistics of each text, all within 0 and 1: one row per text."""
    data, offsets = utf8(column)
    n = len(offsets) - 1
    starts, ends, before = word_spans(data, offsets)
    owner = np.repeat(np.arange(n), np.diff(before))
    text = np.repeat(np.arange(n), np.diff(offsets))
    chars = np.maximum(np.diff(offsets), 1)
    words = np.maximum(np.diff(before), 1)
    count = lambda where: np.bincount(where, minlength=n)
    hashes = word_hashes(data, starts, ends)
    columns = [count(text[mask[data]]) / chars for mask in TABLE]
    pairs = owner[1:] == owner[:-1]
    again = pairs & (hashes[1:] == hashes[:-1])
    columns.append(count(owner[1:][again]) / words)
    for width in (1, 3):
        grams = window_hashes(hashes, width)
        inside = np.flatnonzero(owner[: len(grams)] == owner[width - 1 :]) if len(grams) else []
        keys, own = (grams[inside], owner[inside]) if len(grams) else (grams, owner[:0])
        order = np.lexsort((keys, own))
        repeat = (np.diff(keys[order]) == 0) & (np.diff(own[order]) == 0)
        columns.append(count(own[order][1:][repeat]) / words)
    columns.append(np.minimum(np.bincount(owner, ends - starts, n) / words / 20, 1))
    columns.append(count(owner[(ends - starts) > 15]) / words)
    return np.column_stack(columns), np.diff(before)


def features(column):
    """The classifier's inputs: each statistic, its root and steps; steps of the length; 1."""
    base, words = ratios(column)
    steps = [base > s for s in STEPS] + [words[:, None] > np.array(LENGTHS)[None, :]]
    ones = np.ones((len(base), 1))
    return np.hstack([base, np.sqrt(base), *steps, ones]).astype(np.float64)


WIDTH = (len(CLASSES) + 5) * (2 + len(STEPS)) + len(LENGTHS) + 1


def held_out(doc_id="doc_id"):
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(key.cast("binary")) % FOLDS == 0


def moments(rows: DataFrame):
    """Number, first and second moments of the features, over the unlabelled and over the positives.

    ``rows`` holds x (features as bytes of doubles) and positive.
    """

    def work(batches):
        sums = np.zeros((2, WIDTH * WIDTH + WIDTH + 1))
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column("x").to_pylist()), np.float64).reshape(-1, WIDTH)
            positive = batch.column("positive").to_numpy(zero_copy_only=False).astype(bool)
            for k, part in enumerate((x, x[positive])):
                sums[k] += np.concatenate([[len(part)], part.sum(axis=0), (part.T @ part).ravel()])
        place = np.arange(sums.size, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(sums.ravel())], ["place", "value"])

    found = rows.mapInArrow(work, "place int, value double").groupBy("place").agg(F.sum("value"))
    sums = np.zeros(2 * (WIDTH * WIDTH + WIDTH + 1))
    for place, value in found.collect():  # a fixed number of rows
        sums[place] = value
    sums = sums.reshape(2, -1)
    return [(s[0], s[1 : WIDTH + 1], s[WIDTH + 1 :].reshape(WIDTH, WIDTH)) for s in sums]


@dataclass
class Model:
    weights: np.ndarray
    prior: float

    def score(self, column):
        g = features(column) @ self.weights
        return 1 / (1 + np.exp(-STEEPNESS * np.clip(g, -30, 30)))


def minimise(unlabelled, positive, prior) -> np.ndarray:
    """Weights with the least non-negative risk."""
    (n_u, m_u, s_u), (n_p, m_p, s_p) = unlabelled, positive
    m_u, s_u, m_p, s_p = m_u / n_u, s_u / n_u, m_p / n_p, s_p / n_p
    # In units of each feature's root mean square, so that the ridge treats all alike.
    scale = np.sqrt(np.maximum(np.diag(s_u), 1e-12))
    m_u, m_p = m_u / scale, m_p / scale
    s_u, s_p = s_u / np.outer(scale, scale), s_p / np.outer(scale, scale)
    ridge = RIDGE * np.eye(len(m_u))

    def solve(k):
        left = prior * (1 - k) * s_p + k * s_u + ridge
        return np.linalg.solve(left, prior * (1 + k) * m_p - k * m_u)

    def negative_part(w):
        square = lambda m, s: (1 + 2 * m @ w + w @ s @ w) / 4
        return square(m_u, s_u) - prior * square(m_p, s_p)

    low, high = 0.0, 1.0
    if negative_part(solve(1.0)) < 0:
        for _ in range(60):
            k = (low + high) / 2
            low, high = (k, high) if negative_part(solve(k)) > 0 else (low, k)
    return solve(high) / scale


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on the training folds of docs (doc_id, text), with labels (doc_id, quality)."""

    def work(batches):
        for piece in pieces(batches):
            x = features(piece.column("text"))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array([row.tobytes() for row in x], pa.binary())],
                ["doc_id", "x"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text").where(~held_out())
    rows = rows.mapInArrow(work, f"doc_id {kind}, x binary")
    known = labels.where(~held_out() & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg((F.max("quality") > 0).alias("positive"))
    prior = known.agg(F.avg(F.col("positive").cast("double"))).first()[0]
    if not prior:
        return Model(np.zeros(WIDTH), 0.5)
    positive = F.coalesce("positive", F.lit(False)).alias("positive")
    # A broadcast would put both passes over the rows into one stage, with two Python workers to a task.
    marked = rows.join(known.hint("shuffle_hash"), "doc_id", "left")
    unlabelled, trusted = moments(marked.select("x", positive))
    if not trusted[0]:
        return Model(np.zeros(WIDTH), prior)
    return Model(minimise(unlabelled, trusted, prior), prior)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """Rows of docs with ``score`` in place of their text."""
    others = [c for c in docs.columns if c != "text"]

    def work(batches):
        for piece in pieces(batches):
            scores = pa.array(model.score(piece.column("text")), pa.float64())
            arrays = [*(piece.column(c) for c in others), scores]
            yield pa.RecordBatch.from_arrays(arrays, [*others, "score"])

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in others)
    return docs.mapInArrow(work, f"{kinds}, score double")


def drop_low_quality(docs: DataFrame, labels: DataFrame, threshold=THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``."""
    model = train(docs, labels)

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([text], ["text"])
        return pa.array(np.concatenate([[], *[model.score(p.column(0)) for p in pieces([batch])]]), pa.float64())

    return docs.where(score(F.col("text")) >= threshold)


def op3_quality_scores(spark, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, read_table(spark, sf_dir, "labels"))
    predicted = (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    return scored(docs, model).select("doc_id", held_out().alias("held_out"), "score", predicted)
