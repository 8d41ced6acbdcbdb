"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

Each leaf block is article (1) or not (0). Its features are its ancestors' tags
and the words in their class, id and role, and the length, links and
punctuation of its text; neighbouring labels depend on each other. Weights
maximise the regularised likelihood of labelled pages (``html_pages``, a fixed
number), on the driver; pages are decoded by Viterbi in the tasks, one at a
time.

Defined cases: null or empty html, and pages without text, give an empty text;
broken markup is read leniently (an unclosed script or comment reaches to the
end); repeated rows get equal texts; pages of any length are decoded whole; an
empty table gives an empty result; further columns are not read by the query.
"""

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerloom.llm.common import pieces, read_table
from ledgerloom.llm.html_blocks import blocks, path_features, text_features
from ledgerloom.llm.html_pages import labelled_page

TRAINING_PAGES = 600
ROUNDS = 150
RIDGE = 0.02
CACHED_PATHS = 20_000


def features(found):
    """Feature names of each block of a page."""
    last = len(found) - 1
    return [
        path_features(b.path) + text_features(b, i == 0, i == last) for i, b in enumerate(found)
    ]


def labelled(seed: int):
    """Feature names and labels of a training page's blocks."""
    page, texts = labelled_page(seed)
    found, rest = blocks(page), [" ".join(t.split()) for t in texts]
    labels = []
    for block in found:
        hit = bool(rest) and block.text == rest[0]
        labels.append(int(hit))
        if hit:
            rest.pop(0)
    if rest:
        raise ValueError(f"training page {seed} does not hold its own article")
    return features(found), labels


@dataclass
class Crf:
    """Weights: of each feature for label 1, of label pairs, of the first label."""

    names: dict[str, int]
    weights: np.ndarray
    pairs: np.ndarray
    start: np.ndarray

    def __post_init__(self):
        self.known = {n: float(self.weights[i]) for n, i in self.names.items()}
        self.paths = {}

    def path_score(self, path):
        if path not in self.paths:
            if len(self.paths) >= CACHED_PATHS:
                self.paths = {}
            self.paths[path] = sum(self.known.get(f, 0.0) for f in path_features(path))
        return self.paths[path]

    def scores(self, found):
        last, known = len(found) - 1, self.known
        return [
            self.path_score(b.path)
            + sum(known.get(f, 0.0) for f in text_features(b, i == 0, i == last))
            for i, b in enumerate(found)
        ]

    def decode(self, scores):
        """The likeliest labels (Viterbi); of equally likely ones, 0 first."""
        (p00, p01), (p10, p11) = self.pairs.tolist()
        zero, one = self.start.tolist()
        one += scores[0]
        back = []
        for s in scores[1:]:
            from0, from1 = (0, zero + p00), (1, one + p10)
            to0 = from0 if from0[1] >= from1[1] else from1
            from0, from1 = (0, zero + p01), (1, one + p11)
            to1 = from0 if from0[1] >= from1[1] else from1
            back.append((to0[0], to1[0]))
            zero, one = to0[1], to1[1] + s
        label = int(one > zero)
        labels = [label]
        for step in reversed(back):
            label = step[label]
            labels.append(label)
        return labels[::-1]

    def extract(self, page: str | None) -> str:
        found = blocks(page) if page else []
        if not found:
            return ""
        labels = self.decode(self.scores(found))
        return " ".join(b.text for b, kept in zip(found, labels) if kept)


def log_sum(x, axis):
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def train(pages=TRAINING_PAGES, rounds=ROUNDS) -> Crf:
    """Fit on the first ``pages`` labelled pages; deterministic."""
    data = [labelled(seed) for seed in range(pages)]
    names = {}
    for rows, _ in data:
        for row in rows:
            for f in row:
                names.setdefault(f, len(names))
    n, longest = len(data), max(len(labels) for _, labels in data)
    # Blocks of all pages in one list; page i's block t is at place[i, t].
    row, column, truth = [], [], []
    real = np.zeros((n, longest), bool)
    for i, (rows, labels) in enumerate(data):
        real[i, : len(labels)] = True
        for features_, label in zip(rows, labels):
            row += [len(truth)] * len(features_)
            column += [names[f] for f in features_]
            truth.append(label)
    row, column, truth = np.array(row), np.array(column), np.array(truth)
    gold = np.zeros((n, longest), np.int64)
    gold[real] = truth
    size = len(names)

    def gradient(theta):
        weights, pairs, start = theta[:size], theta[size : size + 4].reshape(2, 2), theta[size + 4 :]
        unary = np.zeros((n, longest, 2))
        unary[real, 1] = np.bincount(row, weights[column], len(truth))
        forward, backward = np.zeros_like(unary), np.zeros_like(unary)
        forward[:, 0] = start + unary[:, 0]
        for t in range(1, longest):
            step = log_sum(forward[:, t - 1, :, None] + pairs, 1) + unary[:, t]
            forward[:, t] = np.where(real[:, t, None], step, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            step = log_sum(pairs + (unary[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(real[:, t + 1, None], step, 0)
        total = log_sum(forward[:, -1], 1)
        likely = np.exp(forward + backward - total[:, None, None])
        over = np.where(real, gold - likely[..., 1], 0.0)
        out = np.zeros_like(theta)
        out[:size] = np.bincount(column, over[real][row], size)
        both = real[:, 1:]
        joint = np.exp(
            forward[:, :-1, :, None] + pairs + (unary + backward)[:, 1:, None, :] - total[:, None, None, None]
        )
        for a in range(2):
            for b in range(2):
                seen = ((gold[:, :-1] == a) & (gold[:, 1:] == b) & both).sum()
                out[size + 2 * a + b] = seen - joint[..., a, b][both].sum()
        for a in range(2):
            out[size + 4 + a] = (gold[:, 0] == a).sum() - likely[:, 0, a].sum()
        return out - RIDGE * n * theta / 10

    theta = np.zeros(size + 6)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for k in range(1, rounds + 1):
        g = gradient(theta)
        mean, square = 0.9 * mean + 0.1 * g, 0.99 * square + 0.01 * g * g
        theta += 0.15 * (mean / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.99**k)) + 1e-8)
    return Crf(names, theta[:size], theta[size : size + 4].reshape(2, 2), theta[size + 4 :])


@functools.lru_cache(maxsize=1)
def trained() -> Crf:
    return train()


def extract_texts(pages: DataFrame, model: Crf | None = None) -> DataFrame:
    """Rows of pages with ``text``, the main text, in place of html."""
    sent = pages.sparkSession.sparkContext.broadcast(model or trained())
    others = [c for c in pages.columns if c != "html"]

    def work(batches):
        crf = sent.value
        for piece in pieces(batches, "html"):
            texts = [crf.extract(x) for x in piece.column("html").to_pylist()]
            arrays = [*(piece.column(c) for c in others), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, [*others, "text"])

    kinds = [f"{c} {pages.schema[c].dataType.simpleString()}" for c in others]
    return pages.mapInArrow(work, ", ".join([*kinds, "text string"]))


def op7_main_text(spark, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_texts(pages).selectExpr("page_id", "url", "text", "cast(length(text) AS long) AS n_chars")
