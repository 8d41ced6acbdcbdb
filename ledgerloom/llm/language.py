"""Language identification in two steps: first the family, then the language within it.

Features are runs of one to three letters of the whole text, lower-cased, with
any run of other characters as a border; each run's hash picks one of ``WIDTH``
counters, and the vector of the roots of their shares has length 1. One linear
support vector machine per family tells it from all others. Within a family,
one machine per pair of its languages (closely related ones, which one machine
for all would confuse) votes, and the language with most votes wins; equal
votes are settled by the sum of margins, then by name. Machines have a squared
hinge loss and are fitted by dual coordinate descent, which converges to the one
optimum whatever the order of the rows.

They are fitted on at most ``SAMPLE`` distinct texts of each language, those
with the lowest hash of the text; all rows are counted to choose them. The
table of families below is fixed; a language that it does not have is a family
of its own.

The score is the logistic share of the family's margin among all families
times the mean logistic margin of the language's pairs.

Defined cases: a null text, or one without any letter, is ``und`` with score 0;
other texts, however short, get a learned language; a null doc_id counts as an
empty one when rows are held out; labels that are null are not learned; nothing
to learn from: every text is ``und`` with score 0; one language: it is given to
all texts with letters; repeated rows get equal results; an empty table gives an
empty result. Other columns are not read.
"""

import functools
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import mixed, pieces, read_table

FOLDS, HELD_OUT = 4, 2  # fixed by the contract
UNKNOWN = "und"
WIDTH = 4096
RUNS = (1, 2, 3)
SAMPLE = 400
COST = 10.0

# Families of languages, by their two-letter codes.
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr tt uz",
    "indic": "bn gu hi mr ne pa ur",
    "semitic": "am ar he mt",
    "dravidian": "kn ml ta te",
    "malayic": "id ms",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


# Features --------------------------------------------------------------------


@functools.lru_cache(maxsize=1)
def letters():
    """For each code point: its lower-cased letter, or 0 if it is none."""
    table = np.zeros(0x110000, np.uint32)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            lower = char.lower()
            table[point] = ord(lower) if len(lower) == 1 else point
    return table


def features(column):
    """One vector of length 1 per text (all zeros without a letter)."""
    texts = ["" if t is None else t for t in column.to_pylist()]
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = letters()[points].astype(np.uint64)
    ends = np.cumsum([len(t) for t in texts])
    owner = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=0))
    # A border before each text, and one for each run of other characters.
    starts = np.concatenate([[0], ends[:-1]])
    codes, owner = np.insert(codes, starts, 0), np.insert(owner, starts, np.arange(len(texts)))
    kept = np.ones(len(codes), bool)
    kept[1:] = (codes[1:] != 0) | (codes[:-1] != 0) | (owner[1:] != owner[:-1])
    codes, owner = codes[kept], owner[kept]
    places = []
    with np.errstate(over="ignore"):
        for run in RUNS:
            n = len(codes) - run + 1
            if n <= 0:
                continue
            key = np.full(n, run, np.uint64)
            for i in range(run):
                key = key * np.uint64(0x200003) + codes[i : i + n]
            inside = owner[:n] == owner[run - 1 :]
            if run == 1:
                inside &= codes != 0
            bucket = (mixed(key) % np.uint64(WIDTH)).astype(np.int64)
            places.append(owner[:n][inside] * WIDTH + bucket[inside])
    counts = np.bincount(np.concatenate(places), minlength=len(texts) * WIDTH) if places else np.zeros(0)
    counts = counts.reshape(len(texts), WIDTH)
    has_letter = np.bincount(owner[codes != 0], minlength=len(texts)) > 0
    total = np.where(has_letter, counts.sum(axis=1), 1)
    return np.where(has_letter[:, None], np.sqrt(counts / total[:, None]), 0).astype(np.float32), has_letter


# Machines --------------------------------------------------------------------


def fitted(x, y, cost=COST, rounds=60, tolerance=1e-3):
    """Weights (the last one is the bias) of a linear machine for labels y of -1 and 1.

    Both sides weigh the same in sum.
    """
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
    share = np.where(y > 0, (y > 0).sum(), (y < 0).sum())
    ridge = share / (cost * len(y))
    square = (x * x).sum(axis=1) + ridge
    weights, alpha = np.zeros(x.shape[1]), np.zeros(len(x))
    order = np.random.default_rng(0)
    for _ in range(rounds):
        worst = 0.0
        for i in order.permutation(len(x)):
            slope = y[i] * (x[i] @ weights) - 1 + ridge[i] * alpha[i]
            step = max(alpha[i] - slope / square[i], 0) - alpha[i]
            if step:
                worst = max(worst, abs(slope))
                alpha[i] += step
                weights += step * y[i] * x[i]
        if worst < tolerance:
            break
    return weights


@dataclass
class Model:
    """``families``: names; ``languages``: of each family; machines as columns of weights."""

    families: list = field(default_factory=list)
    languages: list = field(default_factory=list)
    of_family: np.ndarray | None = None
    of_pair: dict = field(default_factory=dict)

    def predict(self, column):
        """The language and score of each text."""
        x, known = features(column)
        names = np.full(len(x), UNKNOWN, object)
        scores = np.zeros(len(x))
        if not self.families:
            return names, scores
        x = np.hstack([x, np.ones((len(x), 1), np.float32)])
        margins = x @ self.of_family
        family = margins.argmax(axis=1)
        share = squashed(margins)
        share = share / share.sum(axis=1, keepdims=True)
        for f, codes in enumerate(self.languages):
            rows = np.flatnonzero(known & (family == f))
            votes, sums, sure = (np.zeros((len(rows), len(codes))) for _ in range(3))
            for (a, b), weights in self.of_pair.get(f, {}).items():
                margin = x[rows] @ weights
                for code, side in ((a, margin), (b, -margin)):
                    votes[:, code] += side >= 0
                    sums[:, code] += side
                    sure[:, code] += squashed(side)
            # Names are sorted, so the first of equal ones is the first by name.
            best = np.lexsort((-np.broadcast_to(np.arange(len(codes)), votes.shape), sums, votes), axis=1)[:, -1]
            names[rows] = np.array(codes, object)[best]
            pairs = len(codes) - 1
            within = sure[np.arange(len(rows)), best] / pairs if pairs else 1.0
            scores[rows] = share[rows, f] * within
        return names, scores


def squashed(margin):
    return 1 / (1 + np.exp(-3 * np.clip(margin, -10, 10)))


def sample(docs: DataFrame, size=SAMPLE) -> DataFrame:
    """About ``size`` distinct texts of each language (never more), as lang and text.

    Texts are told apart by a digest; those below a digest that leaves about
    twice as many as wanted are taken whole, and of them the lowest.
    """
    keyed = docs.select("lang", "text", F.xxhash64("text").alias("digest"))
    counts = keyed.groupBy("lang").agg(F.approx_count_distinct("digest", 0.02).alias("texts"))
    # One row per language, as the model has: their limits are literals, so no text is moved for a join.
    found = {row.lang: row.texts for row in counts.collect()}
    if not found:
        return docs.limit(0).withColumn("digest", F.lit(0).cast("long"))
    lowest = float(np.iinfo(np.int64).min)
    limits = {lang: lowest + min(1.0, (2.0 * size + 50) / n) * 2.0**64 for lang, n in found.items() if n}
    limit = F.try_element_at(F.create_map(*[F.lit(v) for pair in limits.items() for v in pair]), F.col("lang"))
    few = keyed.where(F.col("digest").cast("double") <= limit)
    few = few.groupBy("lang", "digest").agg(F.first("text").alias("text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("digest"))
    return few.withColumn("rank", rank).where(F.col("rank") <= size).select("lang", "text", "digest")


def train(docs: DataFrame, size=SAMPLE) -> Model:
    """Fit on docs (text, lang), in the driver, on the features of a bounded sample."""

    def work(batches):
        for batch in batches:
            for piece in pieces([batch]):
                x, known = features(piece.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("lang"),
                        piece.column("digest"),
                        pa.array([row.tobytes() if k else None for row, k in zip(x, known)], pa.binary()),
                    ],
                    ["lang", "digest", "x"],
                )

    docs = docs.select(F.col("lang").cast("string"), "text").where("lang IS NOT NULL AND text IS NOT NULL")
    found = sample(docs, size).mapInArrow(work, "lang string, digest long, x binary").where("x IS NOT NULL")
    found = found.toPandas().sort_values(["lang", "digest"])
    if not len(found):
        return Model()
    x = np.stack([np.frombuffer(v, np.float32) for v in found.x])
    lang = found.lang.to_numpy()
    group = np.array([FAMILY_OF.get(code, code) for code in lang], object)
    families = sorted(set(group))
    languages = [sorted(set(lang[group == f])) for f in families]
    sides = lambda where: np.where(where, 1.0, -1.0)
    if len(families) > 1:
        of_family = np.column_stack([fitted(x, sides(group == f)) for f in families])
    else:
        of_family = np.zeros((WIDTH + 1, 1))
    of_pair = {
        f: {
            (a, b): fitted(x[rows], sides(lang[rows] == codes[a])).astype(np.float32)
            for a in range(len(codes))
            for b in range(a + 1, len(codes))
            for rows in [np.isin(lang, [codes[a], codes[b]])]
        }
        for f, codes in enumerate(languages)
    }
    return Model(families, languages, of_family.astype(np.float32), of_pair)


# The operator ----------------------------------------------------------------


def held_out(doc_id="doc_id"):
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(key.cast("binary")) % FOLDS == HELD_OUT


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """Rows of docs (doc_id, held_out, text) with lang_pred and score in place of their text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        for piece in pieces(batches):
            names, scores = shared.value.predict(piece.column("text"))
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    piece.column("held_out"),
                    pa.array(names.tolist(), pa.string()),
                    pa.array(scores.astype(np.float64)),
                ],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(work, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def op12_languages(spark, sf_dir: str) -> DataFrame:
    """The language of every document, learned from three of four folds."""
    docs = read_table(spark, sf_dir, "documents")
    model = train(docs.where(~held_out()).select("text", "lang"))
    return identified(docs.select("doc_id", held_out().alias("held_out"), "text"), model)
